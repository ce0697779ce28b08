"""Ordered-group operators that survive a hot group.

A window ``partitionBy(key).orderBy(time)`` sorts a whole group in one task;
if one key holds a third of all rows that task holds a third of the data.
Here every group is split into monotone time buckets: windows run on
``(key, bucket)``, and the few values that cross a bucket edge (last values,
counts, sums per bucket) come from a per-bucket summary table whose size is
bounded by the number of non-empty buckets, not by the number of rows.

A per-group result needs no row again: ``operators.sessions.main_stats`` merges
the summaries themselves.  Where rows must carry the values (``split_lag``,
``split_running_sum``), the summary goes through a small window on ``key`` and
is joined back by plain equality on ``(key, bucket)``: the rows keep the
partitioning that their window already has.  Rows without a time share one
last bucket, and a key is compared inside a struct, so neither a null time nor
a null key needs a null-safe join, which would shuffle the rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.functions.exprs import epoch_micros, is_ntz, time_bucket

BUCKET = "_bucket"
LRN = "_lrn"
KEY = "_key"

# Default split width: one hour of event time per window partition.
DEFAULT_BUCKET_SECONDS = 3600.0

# Bucket of the rows without a time: after every other.
NO_TIME_BUCKET = 2 ** 63 - 1


def add_bucket(df: DataFrame, time_col: str, bucket_seconds: float = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    if BUCKET in df.columns:
        return df
    bucket = time_bucket(time_col, bucket_seconds, is_ntz(df, time_col))
    return df.withColumn(BUCKET, F.coalesce(bucket, F.lit(NO_TIME_BUCKET)))


def local_window(key: str, order: list):
    """Window on (key, bucket); string order columns sort nulls last, like
    the buckets (a row without a time comes after every timed row)."""
    cols = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    return Window.partitionBy(key, BUCKET).orderBy(*cols)


def split_lag(df: DataFrame, key: str, order: list[str], lags: dict[str, tuple[str, int]],
              rn_col: str | None = None, time_col: str | None = None,
              bucket_seconds: float = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Add ``lag(col, k) over (partition by key order by order)`` columns.

    ``lags`` maps output name -> (source column, k) with k in {1, 2}.  With
    ``rn_col`` also adds the 1-based ``row_number()`` over the same order.
    Result equals the plain window; the work of one key is spread over its
    time buckets.  ``order`` holds column names.
    """
    time_col = time_col or order[0]
    keyed = add_bucket(df, time_col, bucket_seconds).withColumn(KEY, F.struct(key))
    wl = local_window(KEY, order)
    srcs = sorted({src for src, _ in lags.values()})

    def numbered(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn(LRN, F.row_number().over(wl))
        for s in srcs:
            rows = rows.withColumn(f"_l1_{s}", F.lag(s, 1).over(wl)).withColumn(f"_l2_{s}", F.lag(s, 2).over(wl))
        return rows

    # One row per (key, bucket): its row count and the sources' last two values.
    narrow = keyed.select(KEY, BUCKET, *dict.fromkeys([*order, *srcs]))
    tails = numbered(narrow).groupBy(KEY, BUCKET).agg(
        F.max(LRN).alias("_cnt"),
        F.max_by(F.struct(*[F.struct(F.col(s).alias("a"), F.col(f"_l1_{s}").alias("b")).alias(s) for s in srcs])
                 if srcs else F.lit(0), F.col(LRN)).alias("_last"))

    wb = Window.partitionBy(KEY).orderBy(BUCKET)
    prior = wb.rowsBetween(Window.unboundedPreceding, -1)
    bcols = [F.col(KEY), F.col(BUCKET), F.coalesce(F.sum("_cnt").over(prior), F.lit(0)).alias("_offset")]
    for s in srcs:
        last, before = F.col("_last")[s]["a"], F.col("_last")[s]["b"]
        bcols.append(F.lag(last, 1).over(wb).alias(f"_p1_{s}"))
        bcols.append(F.when(F.lag("_cnt", 1).over(wb) >= 2, F.lag(before, 1).over(wb))
                     .otherwise(F.lag(last, 2).over(wb)).alias(f"_p2_{s}"))
    j = numbered(keyed).join(tails.select(*bcols), [KEY, BUCKET])

    out = [F.col(c) for c in df.columns]
    for name, (s, k) in lags.items():
        if k == 1:
            e = F.when(F.col(LRN) == 1, F.col(f"_p1_{s}")).otherwise(F.col(f"_l1_{s}"))
        elif k == 2:
            e = (F.when(F.col(LRN) == 1, F.col(f"_p2_{s}"))
                 .when(F.col(LRN) == 2, F.col(f"_p1_{s}"))
                 .otherwise(F.col(f"_l2_{s}")))
        else:
            raise ValueError("split_lag supports offsets 1 and 2")
        out.append(e.alias(name))
    if rn_col:
        out.append((F.col("_offset") + F.col(LRN)).alias(rn_col))
    return j.select(*out)


def split_running_sum(df: DataFrame, key: str, order: list[str], value_col: str, out_col: str,
                      time_col: str | None = None,
                      bucket_seconds: float = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """``sum(value) over (partition by key order by order rows unbounded
    preceding)`` computed per bucket plus a prefix over bucket totals."""
    time_col = time_col or order[0]
    keyed = add_bucket(df, time_col, bucket_seconds).withColumn(KEY, F.struct(key))
    wl = local_window(KEY, order).rowsBetween(Window.unboundedPreceding, 0)
    totals = keyed.groupBy(KEY, BUCKET).agg(F.sum(value_col).alias("_btot"))
    wb = Window.partitionBy(KEY).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    prefix = totals.select(KEY, BUCKET, F.coalesce(F.sum("_btot").over(wb), F.lit(0)).alias("_bpre"))
    j = keyed.withColumn("_lsum", F.sum(value_col).over(wl)).join(prefix, [KEY, BUCKET])
    return j.select(*[F.col(c) for c in df.columns], (F.col("_bpre") + F.col("_lsum")).alias(out_col))


def gap_sessions(df: DataFrame, key: str, time_col: str, gap_seconds: float, sid_col: str = "_sid",
                 sum_col: str | None = None, sum_out: str | None = None,
                 bucket_seconds: float = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Number each key's runs of events whose consecutive gaps are at most
    ``gap_seconds`` (1, 2, ... in time order) and optionally add each run's
    total of ``sum_col``.  Rows without a time are dropped.

    With buckets no wider than the gap, two events of one (key, bucket) are
    less than the gap apart, so a run can only start at a bucket's first
    event: the numbering needs only per-bucket first / last times (an
    aggregate with map-side partial aggregation), a window over the bucket
    table, and one join back on (key, bucket).  No window sorts the events.
    """
    df = df.filter(F.col(time_col).isNotNull())
    if bucket_seconds > gap_seconds:
        raise ValueError("gap_sessions needs bucket_seconds <= gap_seconds")
    df = add_bucket(df, time_col, bucket_seconds)
    us = epoch_micros(time_col, is_ntz(df, time_col))
    aggs = [F.min(us).alias("_first_us"), F.max(us).alias("_last_us")]
    if sum_col:
        aggs.append(F.sum(sum_col).alias("_bsum"))
    per_bucket = df.groupBy(key, BUCKET).agg(*aggs)
    wb = Window.partitionBy(key).orderBy(BUCKET)
    gap_us = int(gap_seconds * 1_000_000)
    start = F.when(F.col("_first_us") - F.lag("_last_us", 1).over(wb) <= F.lit(gap_us), F.lit(0)).otherwise(F.lit(1))
    runs = per_bucket.withColumn("_start", start).withColumn(
        sid_col, F.sum("_start").over(wb.rowsBetween(Window.unboundedPreceding, 0)))
    keep = [key, BUCKET, sid_col]
    if sum_col:
        totals = runs.groupBy(key, sid_col).agg(F.sum("_bsum").alias(sum_out or f"{sum_col}_total"))
        runs = runs.join(totals, [key, sid_col], "inner")
        keep.append(sum_out or f"{sum_col}_total")
    r = runs.select(*keep).withColumnRenamed(key, "_rk").withColumnRenamed(BUCKET, "_rb")
    # events are shuffled by this join alone; a null key is a key of its own
    return df.join(r, df[key].eqNullSafe(r["_rk"]) & (df[BUCKET] == r["_rb"]), "left").drop("_rk", "_rb")
