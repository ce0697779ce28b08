"""Exact, distributed percentiles (linear interpolation, as numpy / pandas).

``percentile()`` keeps every value of a group in one aggregation buffer and
``percentile_approx`` is not exact.  Selection by cells is both exact and
bounded, with two scans of the data whatever its size:

1. doubles are cut into cells by their leading bits (sign, exponent and eight
   bits of the fraction), which keep their order; the tasks count the rows of
   every cell, and running sums give the cell that holds a wanted rank;
2. the tasks count the distinct values inside those cells; nothing else is
   shuffled, and a value held by a third of all rows is one row a task;
3. the values inside are narrowed by sketches until each cell holds a bounded
   number, which one window then ranks.

A task counts a batch of all columns at a time and hands out sums, so no row
a value is made.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.session import checkpoint_dir
from sessionlab.sources.store import stage

ACCURACY = 10_000          # of the sketches
MAX_INSIDE = 100_000       # distinct values of one bracket that a window ranks
GRID = 256                 # cells a bracket above that size is cut into
CELL_SHIFT = 44            # low bits of a double that its cell leaves out
HELD = 1_000_000           # distinct entries a task holds before it hands them out


def _ranks(n: int, p: float) -> tuple[int, int, float]:
    pos = p * (n - 1)
    lo = int(math.floor(pos))
    hi = min(lo + 1, n - 1)
    return lo, hi, pos - lo


def _value(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _merged(brackets: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Disjoint closed intervals that cover ``brackets``."""
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(brackets):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _cell(x: Column, brackets: list[tuple[float, float]]) -> Column:
    """2 j below bracket j, 2 j + 1 inside it; null above the last one."""
    e = None
    for j, (lo, hi) in enumerate(brackets):
        e = F.when(x < lo, 2 * j) if e is None else e.when(x < lo, 2 * j)
        e = e.when(x <= hi, 2 * j + 1)
    return e


def _ordered_bits(x: np.ndarray) -> np.ndarray:
    """Integers in the order of the doubles; both zeros are one."""
    bits = (x + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(2 ** 63 - 1))


def _from_bits(k: np.ndarray) -> np.ndarray:
    return (k ^ ((k >> 63) & np.int64(2 ** 63 - 1))).view(np.float64)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    out = np.zeros(len(keys), dtype=np.int64)
    np.add.at(out, place, np.concatenate([n for _, n in parts]))
    return keys, out


def _count_values(batches: Iterator[pa.RecordBatch], cells: dict[int, np.ndarray] | None):
    """Rows (c, b, x, cnt) of column number, cell and count; with ``cells``
    (sorted, by column) only values inside these, by value, b their place."""
    held: dict[int, list] = {}
    size = 0

    def handed_out():
        for i, parts in held.items():
            k, n = _summed(parts)
            x = _from_bits(k) if cells else np.zeros(len(k))
            b = np.searchsorted(cells[i], k >> CELL_SHIFT) if cells else k
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), i, dtype=np.int32)), pa.array(b.astype(np.int32)),
                                              pa.array(x), pa.array(n)], names=["c", "b", "x", "cnt"])

    for batch in batches:
        for name, column in zip(batch.schema.names, batch.columns):
            i = int(name[1:])
            x = column.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
            k = _ordered_bits(x[~np.isnan(x)])
            if cells:
                at = k >> CELL_SHIFT
                mine = cells[i]
                k = k[mine[np.minimum(np.searchsorted(mine, at), len(mine) - 1)] == at]
            else:
                k = k >> CELL_SHIFT
            if len(k):
                held.setdefault(i, []).append(np.unique(k, return_counts=True))
                size += len(held[i][-1][0])
        if size > HELD:
            held = {i: [_summed(parts)] for i, parts in held.items()}
            size = sum(len(parts[0][0]) for parts in held.values())
            if size > HELD // 2:
                yield from handed_out()
                held, size = {}, 0
    yield from handed_out()


def _counted(rows: DataFrame, cells: dict[int, np.ndarray] | None = None) -> DataFrame:
    counted = rows.mapInArrow(lambda it: _count_values(it, cells), "c int, b int, x double, cnt long")
    return stage(counted.groupBy("c", "b", "x").agg(F.sum("cnt").alias("cnt")), "quantiles")


def _narrowed(inside: DataFrame, wanted: dict[tuple[int, int], list[int]], accuracy: int) -> tuple[DataFrame, dict]:
    """Keep, of every bracket, the grid cells that hold a wanted rank."""
    sketch = F.percentile_approx("x", [i / GRID for i in range(1, GRID)], accuracy)
    cuts = {(r["c"], r["b"]): sorted(set(r["cuts"])) for r in inside.groupBy("c", "b").agg(sketch.alias("cuts")).collect()}
    spark = inside.sparkSession
    table = spark.createDataFrame([(c, b, v) for (c, b), v in cuts.items()], "c int, b int, cuts array<double>")
    # one row per wanted bracket; the odd cells are the cuts themselves, so that
    # a value of many rows is a cell of its own
    under = F.size(F.filter("cuts", lambda v: v < F.col("x")))
    celled = inside.join(F.broadcast(table), ["c", "b"]).withColumn(
        "g", 2 * under + F.when(F.array_contains("cuts", F.col("x")), 1).otherwise(0))
    counts: dict[tuple[int, int], list] = {}
    for r in celled.groupBy("c", "b", "g").agg(F.sum("cnt").alias("t")).collect():
        counts.setdefault((r["c"], r["b"]), []).append((r["g"], r["t"]))
    keep, left = [], {}
    for (c, b), ranks in wanted.items():
        cells = sorted(counts[c, b])
        ends, acc = [], 0
        for _, t in cells:
            acc += t
            ends.append(acc)
        for rank in ranks:
            i = bisect_right(ends, rank)
            new = b * (2 * GRID + 2) + cells[i][0]
            if (c, new) not in left:
                keep.append((c, b, cells[i][0], new))
            left.setdefault((c, new), []).append((rank, rank - (ends[i] - cells[i][1])))
    chosen = spark.createDataFrame(keep, "c int, b int, g int, nb int")
    out = celled.join(F.broadcast(chosen), ["c", "b", "g"]).select("c", F.col("nb").alias("b"), "x", "cnt")
    return stage(out, "quantiles"), left


def select_ranks(df: DataFrame, columns: dict[str, Column], ranks, shares: list[float], accuracy: int = ACCURACY,
                 max_inside: int = MAX_INSIDE) -> tuple[dict[str, int], dict[str, dict[int, float]]]:
    """Count of non-null values of every column, and the values at the
    0-based ranks ``ranks(n)`` of its ascending order.  ``shares``: about where
    the ranks lie (rank / n); the cells find them without it."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    names = list(columns)
    rows = df.select(*[columns[c].alias(f"x{i}") for i, c in enumerate(names)])
    result: dict[str, dict[int, float]] = {c: {} for c in names}

    # scan 1: rows of every cell, and the cells that hold the wanted ranks
    cells = _counted(rows)
    total = {r["c"]: r["n"] for r in cells.groupBy("c").agg(F.sum("cnt").alias("n")).collect()}
    count = {c: total.get(i, 0) for i, c in enumerate(names)}
    asked = [(i, r) for i in total for r in sorted(set(ranks(total[i])))]
    if not asked:
        return count, result
    upto = Window.partitionBy("c").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    hits = cells.withColumn("upto", F.sum("cnt").over(upto)) \
        .join(F.broadcast(spark.createDataFrame(asked, "c int, r long")), "c") \
        .where("r < upto and r >= upto - cnt").select("c", "b", "r", (F.col("upto") - F.col("cnt")).alias("below")).collect()
    inside: dict[int, np.ndarray] = {i: np.array(sorted({h["b"] for h in hits if h["c"] == i}), dtype=np.int64)
                                     for i in {h["c"] for h in hits}}

    # scan 2: the values inside these cells
    values = _counted(rows.select(*[f"x{i}" for i in sorted(inside)]), inside)
    distinct = {(r["c"], r["b"]): r["count"] for r in values.groupBy("c", "b").count().collect()}
    wanted: dict[tuple[int, int], list] = {}
    for h in hits:
        key = h["c"], int(np.searchsorted(inside[h["c"]], h["b"]))
        wanted.setdefault(key, []).append((h["r"], h["r"] - h["below"], distinct[key]))
    _rank_inside(values, wanted, names, result, accuracy, max_inside)
    return count, result


def _rank_inside(cells: DataFrame, wanted: dict, names: list[str], result: dict, accuracy: int, max_inside: int) -> None:
    if not wanted:
        return
    spark = cells.sparkSession
    places = spark.createDataFrame(list(wanted), "c int, b int")
    inside = cells.join(F.broadcast(places), ["c", "b"])
    # (bracket) -> [(wanted rank, rank inside the bracket)]
    todo = {k: [(r, rel) for r, rel, _ in v] for k, v in wanted.items()}
    size = max(d for v in wanted.values() for _, _, d in v)
    while size > max_inside:
        asked = {k: [rel for _, rel in v] for k, v in todo.items()}
        inside, left = _narrowed(inside, asked, accuracy)
        names_of = {(k, rel): r for k, v in todo.items() for r, rel in v}
        todo = {}
        for (c, nb), pairs in left.items():
            old = (c, nb // (2 * GRID + 2))
            todo[c, nb] = [(names_of[old, rel], new) for rel, new in pairs]
        smaller = inside.groupBy("c", "b").count().agg(F.max("count")).first()[0]
        # brackets get new numbers, so that they stay small
        numbers = {k: j for j, k in enumerate(todo)}
        renamed = spark.createDataFrame([(c, b, j) for (c, b), j in numbers.items()], "c int, b int, j int")
        inside = inside.join(F.broadcast(renamed), ["c", "b"]).select("c", F.col("j").alias("b"), "x", "cnt")
        todo = {(c, numbers[c, b]): v for (c, b), v in todo.items()}
        size = smaller
    rows = [(c, b, r, rel) for (c, b), v in todo.items() for r, rel in v]
    asked = spark.createDataFrame(rows, "c int, b int, r long, rel long")
    upto = Window.partitionBy("c", "b").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = inside.withColumn("upto", F.sum("cnt").over(upto))
    hit = ranked.join(F.broadcast(asked), ["c", "b"]).where("rel < upto and rel >= upto - cnt").select("c", "r", "x")
    for r in hit.collect():
        result[names[r["c"]]][r["r"]] = r["x"]


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], accuracy: int = ACCURACY,
                    max_inside: int = MAX_INSIDE) -> dict[str, list[float | None]]:
    """{column: [quantile(p) for p in probs]} over non-null, non-NaN values;
    None for a column without any."""
    if not cols:
        return {}

    def ranks(n: int) -> list[int]:
        return [r for p in probs for r in _ranks(n, p)[:2]]

    count, at = select_ranks(df, {c: _value(c) for c in cols}, ranks, probs, accuracy, max_inside)
    out: dict[str, list[float | None]] = {}
    for c in cols:
        out[c] = []
        for p in probs:
            if not count[c]:
                out[c].append(None)
                continue
            lo, hi, frac = _ranks(count[c], p)
            a, b = at[c][lo], at[c][hi]
            out[c].append(a + (b - a) * frac if frac else a)
    return out


def approx_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                     accuracy: int = 10_000) -> dict[str, list[float | None]]:
    """Opt-in approximate percentiles: one ``percentile_approx`` pass with
    bounded sketches (rank error at most n / accuracy).  Not numpy's linear
    interpolation; use where exactness is not required."""
    aggs = [F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(f"q{i}")
            for i, c in enumerate(cols)]
    row = df.agg(*aggs).first()
    return {c: (list(row[f"q{i}"]) if row[f"q{i}"] is not None else [None] * len(probs))
            for i, c in enumerate(cols)}


def quantiles(df: DataFrame, cols: list[str], probs: list[float], exact: bool = True):
    return exact_quantiles(df, cols, probs) if exact else approx_quantiles(df, cols, probs)


def exact_quantile(df: DataFrame, col: str, p: float) -> float | None:
    return exact_quantiles(df, [col], [p])[col][0]
