"""Approximate nearest neighbours by learned partitions (cosine).

Fit, on a bounded sample of distinct directions: the neighbour graph of the
sample is cut into balanced parts (a start by median splits along principal
directions, then moves towards the part that holds most neighbours, within a
size limit), and a small network learns to tell a vector's part.  The number
of parts a query visits is the smallest that reaches the asked share of its
neighbours on sample rows that were held out of the network's training.

Search: every distinct vector is filed under its most probable part.  A query
visits its most probable parts; parts are cut into blocks of bounded size on
both sides, a cell ranks a block of queries against a block of vectors, and
the best of all cells are scored anew on the original vectors.

Equal vectors are one entry with its smallest ids, as many as can be returned:
a vector that a third of all rows share is one row of the index.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.llm.common import col
from sessionlab.sources.store import stage

SAMPLE = 16_384          # rows that the graph and the network are fitted on
PART_ROWS = 256          # sample rows of a part, at the least
NEIGHBOURS = 10
TARGET = 0.95            # share of a held-out row's neighbours in the parts it visits
HIDDEN = 128
EPOCHS = 12
HELD = 8                 # every so many sample rows are held out
BLOCK = 32_768           # vectors, and queries, of one cell at about the most
NEAR = 1e-9              # scores closer than this are scored anew before they are ordered


# --------------------------------------------------------------- the graph

def neighbour_graph(x: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """The k nearest rows of each unit row, itself left out."""
    n = len(x)
    k = min(k, n - 1)
    out = np.empty((n, k), np.int64)
    x = x.astype(np.float32)
    for i in range(0, n if k else 0, 256):
        far = -(x[i:i + 256] @ x.T)
        far[np.arange(len(far)), np.arange(i, i + len(far))] = np.inf
        out[i:i + 256] = np.argpartition(far, k - 1, axis=1)[:, :k]
    return out


def halved(x: np.ndarray, parts: int) -> np.ndarray:
    """A balanced start: medians along the main direction, again and again."""
    part = np.zeros(len(x), np.int64)
    for _ in range(parts.bit_length() - 1):
        new = np.empty_like(part)
        for p in np.unique(part):
            rows = np.flatnonzero(part == p)
            centred = x[rows] - x[rows].mean(axis=0)
            main = np.linalg.eigh(centred.T @ centred)[1][:, -1]
            rank = np.argsort(np.argsort(centred @ main, kind="stable"), kind="stable")
            new[rows] = 2 * p + (rank >= len(rows) // 2)
        part = new
    return part


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 0.1, rounds: int = 30) -> np.ndarray:
    """A part for each vertex, none above (1 + slack) of the mean size, with
    few edges between parts: vertices move to the part that holds most of
    their neighbours (edges taken both ways), greatest gain first, where the
    limit leaves room."""
    n, k = graph.shape
    part = halved(x, parts)
    limit = int(np.ceil((1 + slack) * n / parts))
    source, target = np.repeat(np.arange(n), k), graph.ravel()
    ends, others = np.concatenate((source, target)), np.concatenate((target, source))
    for turn in range(rounds):
        votes = np.bincount(ends * parts + part[others], minlength=n * parts).reshape(n, parts)
        goal = votes.argmax(axis=1)
        gain = votes[np.arange(n), goal] - votes[np.arange(n), part]
        movers = np.flatnonzero((gain > 0) & (np.arange(n) % 2 == turn % 2))     # half at a time: neighbours do not swap
        if not len(movers) and turn % 2:
            break
        movers = movers[np.lexsort((-gain[movers], goal[movers]))]
        first = np.searchsorted(goal[movers], np.arange(parts))
        place = np.arange(len(movers)) - first[goal[movers]]
        room = limit - np.bincount(part, minlength=parts)
        movers = movers[place < room[goal[movers]]]
        part[movers] = goal[movers]
    return part


# ------------------------------------------------------------- the network

@dataclass
class Router:
    """One hidden layer; ``probes`` parts are visited per query."""
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    @property
    def parts(self) -> int:
        return len(self.b2)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def ranked(self, x: np.ndarray, many: int) -> np.ndarray:
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, :many]


def train(x: np.ndarray, goal: np.ndarray, seed: int = 7) -> Router:
    """Cross-entropy against ``goal`` (rows of shares), Adam, fixed seed."""
    rng = np.random.default_rng(seed)
    dim, parts = x.shape[1], goal.shape[1]
    p = [rng.normal(0, np.sqrt(2), (dim, HIDDEN)), np.zeros(HIDDEN),        # unit rows: entries of about 1 / sqrt(dim)
         rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    first, second = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p]
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 256):
            rows = order[i:i + 256]
            inner = x[rows] @ p[0] + p[1]
            hidden = np.maximum(inner, 0)
            logit = hidden @ p[2] + p[3]
            soft = np.exp(logit - logit.max(axis=1, keepdims=True))
            error = (soft / soft.sum(axis=1, keepdims=True) - goal[rows]) / len(rows)
            back = (error @ p[2].T) * (inner > 0)
            step += 1
            for j, g in enumerate((x[rows].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0))):
                first[j] = 0.9 * first[j] + 0.1 * g
                second[j] = 0.999 * second[j] + 0.001 * g * g
                rate = 0.01 * (1 - epoch / EPOCHS)
                p[j] -= rate * (first[j] / (1 - 0.9 ** step)) / (np.sqrt(second[j] / (1 - 0.999 ** step)) + 1e-8)
    return Router(*p, probes=parts)


def fit_router(x: np.ndarray, parts: int | None = None, target: float = TARGET) -> Router:
    """Router of the unit rows ``x``; a single part where they are few."""
    if parts is None:
        parts = 1 << max(0, (len(x) // PART_ROWS).bit_length() - 1)
    dim = x.shape[1]
    if parts == 1 or len(x) < 2 * parts:
        return Router(np.zeros((dim, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    graph = neighbour_graph(x)
    part = balanced_parts(x, graph, parts)
    # a row's goal: the parts of its neighbours and its own
    around = np.concatenate((part[graph], part[:, None]), axis=1)
    goal = np.bincount((np.arange(len(x))[:, None] * parts + around).ravel(), minlength=len(x) * parts).reshape(len(x), parts)
    held = np.arange(len(x)) % HELD == 0
    router = train(x[~held], goal[~held] / around.shape[1])
    filed = router.ranked(x, 1)[:, 0]
    visits = np.argsort(np.argsort(-router.scores(x[held]), axis=1, kind="stable"), axis=1, kind="stable")
    depth = np.take_along_axis(visits, filed[graph[held]], axis=1).ravel()
    reached = np.cumsum(np.bincount(depth, minlength=parts)) / len(depth)
    router.probes = min(parts, int(np.searchsorted(reached, target)) + 1)
    return router


# ----------------------------------------------------------------- the job

def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)          # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vectors: DataFrame, id_col="vec_id", vector_col="embedding") -> DataFrame:
    """(vec_id, v, dim) of the rows that take part, repeated rows once."""
    rows = vectors.select(col(vectors, id_col).cast("long").alias("vec_id"), col(vectors, vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0.0))
            .withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))         # one zero
            .dropDuplicates(["vec_id", "v"]).withColumn("dim", F.size("v")))


def entries(rows: DataFrame, k: int) -> DataFrame:
    """(v, dim, ids): each distinct vector with its k + 1 smallest ids, enough
    for any query's k after its own id is left out.  The limit per vector is
    applied before the exchange too."""
    few = rows.withColumn("_n", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("_n") <= k + 1)
    return few.groupBy("v", "dim").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def fit(distinct: DataFrame, sample: int = SAMPLE, parts: int | None = None, target: float = TARGET) -> dict[int, Router]:
    """A router per dimension of a sample of at most ``sample`` vectors, those
    of the smallest hashes (the same on every run)."""
    taken = distinct.select("v", "dim").orderBy(F.xxhash64("v"), "v").limit(sample).toArrow()
    dims = taken.column("dim").to_numpy()
    return {int(d): fit_router(_unit(_matrix(taken.column("v").take(np.flatnonzero(dims == d)))), parts, target) for d in np.unique(dims)}


def routed(rows: DataFrame, routers: dict[int, Router], every: bool) -> DataFrame:
    """Rows with ``part``: the most probable one, or one row for each part that
    a query visits.  Vectors of a dimension that the sample lacks share part 0."""
    def route(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            parts = [[0]] * len(dims)
            for d in np.unique(dims):
                if int(d) in routers:
                    router, at = routers[int(d)], np.flatnonzero(dims == d)
                    found = router.ranked(_unit(_matrix(batch.column("v").take(pa.array(at)))), router.probes if every else 1)
                    for i, p in zip(at, found.tolist()):
                        parts[i] = p
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts, pa.list_(pa.int32()))],
                                             names=[*batch.schema.names, "parts"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return (rows.mapInArrow(route, f"{kinds}, parts array<int>").withColumn("part", F.explode("parts")).drop("parts"))


def _blocked(rows: DataFrame, key: str, block: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows dealt into blocks of about ``block`` rows by a hash, and the number
    of blocks of each part."""
    sizes = rows.groupBy("dim", "part").agg((F.floor((F.count(F.lit(1)) - 1) / block) + 1).alias(name))
    return rows.join(sizes, ["dim", "part"]).withColumn(f"{name}_at", F.pmod(F.xxhash64(key), F.col(name))).drop(name), sizes


def rank_cell(q_ids, q, c_ids, c, k: int):
    """(query id, vector id, cosine) of each query's k nearest in one cell;
    ``c_ids`` holds the ids of each row of ``c``."""
    qu, cu = _unit(q), _unit(c)
    out = []
    keep = min(len(c), k + 1)                # one entry may hold the query alone
    for i in range(0, len(q), 128):
        rough = qu[i:i + 128] @ cu.T
        floor = np.partition(rough, len(c) - keep, axis=1)[:, len(c) - keep] - NEAR
        for j, row in enumerate(rough):
            near = np.flatnonzero(row >= floor[j])
            # products and sums of each row alone: equal vectors score alike in every cell
            score = (cu[near] * qu[i + j]).sum(axis=1)
            order = np.argsort(-score, kind="stable")
            best = []
            for s, e in zip(score[order].tolist(), near[order].tolist()):
                if len(best) >= k and -s > best[k - 1][0]:
                    break
                best = sorted(best + [(-s, v) for v in c_ids[e] if v != q_ids[i + j]])[:k]
            out += [(q_ids[i + j], v, -s) for s, v in best]
    return out


def search(vectors: DataFrame, id_col="vec_id", vector_col="embedding", query=None, k: int = 5, sample: int = SAMPLE,
           parts: int | None = None, target: float = TARGET, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest found by
    cosine among the rows with another id, ties to the smaller id.

    ``query`` is a condition on the id that marks queries.  Vectors that are
    null or zero or hold a null or non-finite component, and rows without an
    id, take no part; vectors are compared with those of equal length; a
    repeated row counts once; an empty table gives no rows; other columns are
    not read.  A query has fewer than ``k`` rows only where there are fewer
    candidates in the parts it visits.
    """
    rows = stage(usable(vectors, id_col, vector_col), "ann_rows")
    distinct = stage(entries(rows, k), "ann_entries")
    routers = fit(distinct, sample, parts, target)
    asked = rows.where(query(F.col("vec_id"))) if query else rows
    filed, c_blocks = _blocked(stage(routed(distinct, routers, False), "ann_filed"), "v", block, "cb")
    visits, q_blocks = _blocked(stage(routed(asked, routers, True), "ann_visits"), "vec_id", block, "qb")
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    filed = filed.join(q_blocks, ["dim", "part"]).withColumn("qb_at", spread("qb"))
    visits = visits.join(c_blocks, ["dim", "part"]).withColumn("cb_at", spread("cb"))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if len(left) and len(right):
            found = rank_cell(right.column("vec_id").to_pylist(), _matrix(right.column("v")),
                              left.column("ids").to_pylist(), _matrix(left.column("v")), k)
        cols = list(zip(*found)) or [[], [], []]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()),
                         "score": pa.array(cols[2], pa.float64())})

    keys = ["dim", "part", "cb_at", "qb_at"]
    found = (filed.select(*keys, "ids", "v").groupBy(*keys).cogroup(visits.select(*keys, "vec_id", "v").groupBy(*keys))
             .applyInArrow(cell, "query_id long, vec_id long, score double"))
    # an id of several vectors may be found by each of them
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
