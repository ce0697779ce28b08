"""Exact top-k by inner product: columnar branch and bound.

Vectors become integers floor(scale * x) and are packed into tiles in
vertical layout (one row per dimension).  A cell is a candidate tile against
a query tile; tiles are keyed on both sides, so cells are an equi-join.
Inside a cell scores are accumulated a block of dimensions at a time.  The
mass that is left (product of the remaining norms) bounds what a candidate
may still gain or lose; a candidate whose upper bound is below the k-th best
lower bound is dropped and the survivors are compacted.  All bounds are kept
with a margin for rounding, all scores are exact integers.

Work is queries times candidates by nature; the tiles spread it evenly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.llm.common import col
from sessionlab.sources.store import stage

TILE = 2048
DIMENSIONS = 16


def _pack(table: pa.Table, scale: int) -> pa.Table:
    """One tile: ids and the vertical integer matrix of equal-length rows
    (the smallest integer type that holds it), repeated rows once."""
    ids = table.column("vec_id").to_numpy()
    flat = table.column("v").combine_chunks()
    x = np.asarray(flat.values.slice(flat.offset * 0), dtype=np.float64)
    x = x[flat.offsets[0].as_py(): flat.offsets[-1].as_py()].reshape(len(ids), -1)
    x = np.floor(scale * x)
    order = np.lexsort((*x.T[::-1], ids)) if x.shape[1] else np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    new = np.ones(len(ids), dtype=bool)
    new[1:] = (ids[1:] != ids[:-1]) | (x[1:] != x[:-1]).any(axis=1)
    ids, x = ids[new], x[new]
    top = np.abs(x).max(initial=0)
    kind = next((t for t in ("<i2", "<i4") if top <= np.iinfo(t).max), "<f8")
    return pa.table({"dim": pa.array([x.shape[1]], pa.int32()), "tile": table.column("tile").slice(0, 1),
                     "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()), "kind": pa.array([kind]),
                     "data": pa.array([np.ascontiguousarray(x.T).astype(kind).tobytes()], pa.binary())})


_TILE_SCHEMA = "dim int, tile long, ids binary, kind string, data binary"


def distinct_integers(rows: DataFrame, scale: int) -> DataFrame:
    """Rows with the vector as whole doubles floor(scale * x), repeated rows
    once; beyond 2**52 a double has no fraction."""
    def whole(x):
        y = x * F.lit(float(scale))
        return F.when(F.abs(y) < float(2 ** 52), F.floor(y).cast("double")).otherwise(y)

    return rows.withColumn("v", F.transform("v", whole)).dropDuplicates(["vec_id", "dim", "v"])


def tiles(vectors: DataFrame, size: int, scale: int, name: str) -> tuple[DataFrame, int]:
    """Packed tiles of about ``size`` rows, by a hash of the id and vector (an
    id of many rows is in many tiles), and their number; staged, as both
    sides of the search read them."""
    n = max(1, -(-vectors.count() // size))
    packed = (vectors.withColumn("tile", F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)))
              .groupBy("dim", "tile").applyInArrow(lambda t: _pack(t.select(["tile", "vec_id", "v"]), scale), _TILE_SCHEMA))
    return stage(packed, name), n


def _unpack(row) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], "<i8")
    x = np.frombuffer(row["data"], row["kind"]).reshape(row["dim"], len(ids))
    return ids, x


def best(q_ids, q, c_ids, c, k: int, step: int = DIMENSIONS):
    """(query id, candidate id, score) of each query's k best in one cell;
    q and c are vertical.  Scores are exact: in doubles while every sum stays
    below 2**53, else in Python integers."""
    dim = q.shape[0]
    qf, cf = q.astype(np.float64), c.astype(np.float64)
    exact = np.abs(qf).max(initial=0) * np.abs(cf).max(initial=0) * max(1, dim) < 2.0 ** 53
    cuts = list(range(0, dim, step)) + [dim]
    tail = lambda x: np.stack([np.sqrt((x[a:] ** 2).sum(axis=0)) for a in cuts])
    q_left, c_left = tail(qf), tail(cf)
    out = []
    first = qf[:cuts[1]].T @ cf[:cuts[1]] if dim else np.zeros((q.shape[1], c.shape[1]))
    for i, qid in enumerate(q_ids):
        alive = np.flatnonzero(c_ids != qid)
        score = first[i, alive]
        for b in range(1, len(cuts)):
            if b > 1:
                a, z = cuts[b - 1], cuts[b]
                score = score + qf[a:z, i] @ cf[a:z, alive]
            if b < len(cuts) - 1 and len(alive) > k:
                gain = q_left[b, i] * c_left[b, alive]
                slack = 1e-6 * (1 + gain + np.abs(score))
                floor = np.partition(score - gain - slack, len(alive) - k)[len(alive) - k]
                stay = score + gain + slack >= floor
                alive, score = alive[stay], score[stay]
        if not exact:
            whole = [int(x) for x in qf[:, i]]
            score = np.array([sum(a * int(b) for a, b in zip(whole, cf[:, j])) for j in alive], dtype=object)
        order = sorted(range(len(alive)), key=lambda j: (-score[j], c_ids[alive[j]]))[:k] if len(alive) <= 4 * k or not exact \
            else np.lexsort((c_ids[alive], -score))[:k]
        top = 2 ** 63 - 1
        out += [(int(qid), int(c_ids[alive[j]]), max(-top - 1, min(top, int(score[j])))) for j in order]
    return out


def search(vectors: DataFrame, id_col="vec_id", vector_col="embedding", query=None, k: int = 5, scale: int = 256,
           tile: int = TILE) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest inner
    products among all rows with another id, ties to the smaller id.

    ``query`` is a condition on the id that marks queries.  Vectors that are
    null or hold a null or non-finite component, and rows without an id, take
    no part; vectors are compared with those of equal length; a repeated row
    counts once; scores beyond a long are held at its ends; an empty table
    gives no rows; other columns are not read.
    """
    rows = vectors.select(col(vectors, id_col).cast("long").alias("vec_id"),
                          col(vectors, vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite).withColumn("dim", F.size("v"))
    rows = distinct_integers(rows, scale)
    cond = query(F.col("vec_id")) if query else F.lit(True)
    c, nc = tiles(rows, tile, 1, "topk_candidates")
    q, nq = tiles(rows.where(cond), max(1, tile // 2), 1, "topk_queries")
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    c = c.withColumnRenamed("tile", "ct").withColumn("qt", spread(nq))
    q = q.withColumnRenamed("tile", "qt").withColumn("ct", spread(nc))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        for cr in left.to_pylist():
            for qr in right.to_pylist():
                q_ids, qx = _unpack(qr)
                c_ids, cx = _unpack(cr)
                found += best(q_ids, qx, c_ids, cx, k)
        cols = list(zip(*found)) or [[], [], []]
        return pa.table({n: pa.array(v, pa.int64()) for n, v in zip(("query_id", "vec_id", "score"), cols)})

    keys = ["dim", "ct", "qt"]
    found = c.groupBy(*keys).cogroup(q.groupBy(*keys)).applyInArrow(cell, "query_id long, vec_id long, score long")
    # each cell gives at most k a query; the limit per query is applied before
    # the exchange too, so no list of a query's cells is ever held
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
