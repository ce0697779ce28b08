"""Split windows, exact quantiles and the global row index against plain
(single-task) formulations, with a hot key holding a third of the rows."""
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sessionlab.functions.quantiles import exact_quantiles
from sessionlab.functions.ranking import global_row_index
from sessionlab.operators.ordered import split_lag, split_running_sum


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rnd.randint(0, 200)}"
        t = base + dt.timedelta(seconds=rnd.randint(0, 5 * 86400) // 7 * 7)  # many ties
        t = None if i % 97 == 0 else t                                        # rows without a time
        rows.append((i, key, t, rnd.choice(["A", "B", "C", None]), rnd.randint(0, 1)))
    return spark.createDataFrame(rows, "id long, key string, t timestamp_ntz, v string, b int")


@pytest.mark.parametrize("bucket", [60.0, 3600.0, 1e9])
def test_split_lag_equals_window(skewed, bucket):
    w = Window.partitionBy("key").orderBy(F.col("t").asc_nulls_last(), F.col("id").asc_nulls_last())
    plain = skewed.select("id", F.lag("v", 1).over(w).alias("l1"), F.lag("v", 2).over(w).alias("l2"),
                          F.lag("t", 1).over(w).alias("lt"), F.row_number().over(w).alias("rn"))
    split = split_lag(skewed, "key", ["t", "id"], {"l1": ("v", 1), "l2": ("v", 2), "lt": ("t", 1)},
                      rn_col="rn", time_col="t", bucket_seconds=bucket).select("id", "l1", "l2", "lt", "rn")
    assert sorted(plain.collect()) == sorted(split.collect())


def test_split_running_sum_equals_window(skewed):
    w = Window.partitionBy("key").orderBy(F.col("t").asc_nulls_last(), "id") \
        .rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.select("id", F.sum("b").over(w).alias("s"))
    split = split_running_sum(skewed, "key", ["t", "id"], "b", "s", time_col="t",
                              bucket_seconds=600).select("id", "s")
    assert sorted(plain.collect()) == sorted(split.collect())


def test_exact_quantiles_match_numpy(spark):
    rnd = np.random.default_rng(3)
    a = np.concatenate([np.zeros(700), rnd.normal(size=1300)])          # hot value: a third
    b = rnd.integers(0, 5, size=2000).astype(float)
    c = np.full(2000, 4.25)                                               # constant column
    df = spark.createDataFrame([(float(x), float(y), float(z)) for x, y, z in zip(a, b, c)], "a double, b double, c double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0]
    got = exact_quantiles(df, ["a", "b", "c"], probs)
    for name, arr in (("a", a), ("b", b), ("c", c)):
        assert got[name] == pytest.approx(list(np.percentile(arr, [p * 100 for p in probs])), abs=1e-12)


def test_quantiles_ignore_nulls_and_empty(spark):
    df = spark.createDataFrame([(None,), (1.0,), (3.0,), (float("nan"),)], "x double")
    assert exact_quantiles(df, ["x"], [0.5])["x"] == [2.0]
    assert exact_quantiles(df.filter("x > 10"), ["x"], [0.5])["x"] == [None]


def test_global_row_index(spark):
    rnd = random.Random(1)
    rows = [(rnd.randint(0, 50), f"s{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "start int, s string")
    got = {r["s"]: r["row_index"] for r in global_row_index(df, ["start", "s"], partitions=5).collect()}
    want = {s: i for i, (_, s) in enumerate(sorted(rows))}
    assert got == want


def test_split_lag_under_dst_session_zone(spark):
    base = dt.datetime(2024, 3, 10, 1, 0)           # US spring-forward at 02:00 wall time
    rows = [(i, "k", base + dt.timedelta(minutes=7 * i), "A" if i % 2 else "B") for i in range(40)]
    df = spark.createDataFrame(rows, "id long, key string, t timestamp_ntz, v string")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        w = Window.partitionBy("key").orderBy("t", "id")
        plain = df.select("id", F.lag("v", 1).over(w).alias("l1"), F.row_number().over(w).alias("rn"))
        split = split_lag(df, "key", ["t", "id"], {"l1": ("v", 1)}, rn_col="rn", time_col="t",
                          bucket_seconds=600).select("id", "l1", "rn")
        assert sorted(plain.collect()) == sorted(split.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("accuracy,max_inside", [(10_000, 100_000), (10, 100_000), (20, 40), (100, 3)])
def test_selection_narrows_and_opens_brackets(spark, accuracy, max_inside):
    rnd = np.random.default_rng(5)
    a = np.concatenate([rnd.normal(size=2500), np.zeros(1500), np.full(900, 1.5), [np.inf, -np.inf]])
    b = rnd.integers(-5, 2000, size=len(a)).astype(float)
    rows = [(float(x), float(y), None) for x, y in zip(a, b)] + [(None, float("nan"), None)] * 7
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    probs = [0.01, 0.25, 0.5, 0.501, 0.75, 0.9]
    got = exact_quantiles(df, ["a", "b", "c"], probs, accuracy, max_inside)
    for name, arr in (("a", a), ("b", b)):
        assert got[name] == pytest.approx(list(np.percentile(arr, [p * 100 for p in probs])), abs=1e-12)
    assert got["c"] == [None] * len(probs)


def test_selection_shuffles_only_brackets(spark):
    """Two scans; outside the brackets one row per cell and task is shuffled."""
    from sessionlab.functions.quantiles import _cell, _merged
    assert _merged([(3, 5), (1, 2), (4, 9), (2, 2)]) == [(1, 2), (3, 9)]
    df = spark.range(200_000).select(F.col("id").cast("double").alias("x"))
    cell = _cell(F.col("x"), [(99_000.0, 101_000.0)])
    inside = df.select(cell.alias("b"), F.when(cell % 2 == 1, F.col("x")).alias("x")).where("b is not null")
    assert inside.groupBy("b", "x").count().count() == 2001 + 1
    assert exact_quantiles(df, ["x"], [0.5])["x"] == [99_999.5]


@pytest.mark.parametrize("bucket", [60.0, 3600.0, 43200.0, 86400.0 * 3])
def test_adapter_sessions_equal_plain_windows(spark, bucket):
    from sessionlab.sources.adapter import clicks_from_events
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    rows, t = [], {}
    for i in range(2500):
        u = 0 if i % 3 == 0 else rnd.randint(1, 40)          # user 0 holds a third of the events
        step = rnd.choice([0, 60, 3600, 11 * 3600, 12 * 3600, 12 * 3600 + 1, 20 * 3600])
        t[u] = t.get(u, base) + dt.timedelta(seconds=step)
        rows.append((i, t[u], u, rnd.choice(["view", "click", "purchase"]), round(rnd.random() * 50, 2),
                     f'{{"k": {rnd.randint(0, 99)}}}'))
    ev = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, "
                                     "value double, props string")
    got = clicks_from_events(ev, bucket_seconds=bucket).select("event_id", "user_session", "session_value")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    brk = F.when(F.col("ts") <= F.lag("ts").over(w) + F.expr("INTERVAL 12 HOURS"), 0).otherwise(1)
    s = ev.withColumn("brk", brk).withColumn("sid", F.sum("brk").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    s = s.withColumn("user_session", F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("-S"),
                                              F.col("sid").cast("string")))
    tot = s.groupBy("user_session").agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("session_value"))
    want = s.join(tot, "user_session").select("event_id", "user_session", "session_value")
    assert sorted(got.collect()) == sorted(want.collect())


from hypothesis import HealthCheck, given, settings, strategies as st  # noqa: E402


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", "hot"]),
                               st.one_of(st.none(), st.integers(0, 20_000)),
                               st.sampled_from(["V", "A", "B", None])), min_size=1, max_size=60),
       bucket=st.sampled_from([1.0, 30.0, 600.0, 1e9]))
def test_split_lag_property(spark, rows, bucket):
    base = dt.datetime(2024, 1, 1)
    data = [(i, k, None if s is None else base + dt.timedelta(seconds=s), v) for i, (k, s, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, key string, t timestamp_ntz, v string")
    w = Window.partitionBy("key").orderBy(F.col("t").asc_nulls_last(), F.col("id").asc_nulls_last())
    plain = df.select("id", F.lag("v", 1).over(w).alias("l1"), F.lag("v", 2).over(w).alias("l2"),
                      F.row_number().over(w).alias("rn"))
    split = split_lag(df, "key", ["t", "id"], {"l1": ("v", 1), "l2": ("v", 2)}, rn_col="rn", time_col="t",
                      bucket_seconds=bucket).select("id", "l1", "l2", "rn")
    assert sorted(plain.collect()) == sorted(split.collect())


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(steps=st.lists(st.tuples(st.integers(0, 3), st.sampled_from([0, 1, 3599, 3600, 43199, 43200, 43201, 90000])),
                      min_size=1, max_size=50),
       bucket=st.sampled_from([1.0, 600.0, 3600.0, 43200.0]))
def test_gap_sessions_property(spark, steps, bucket):
    from sessionlab.operators.ordered import gap_sessions
    base, clock, rows = dt.datetime(2024, 1, 1), {}, []
    for i, (u, step) in enumerate(steps):
        clock[u] = clock.get(u, base) + dt.timedelta(seconds=step)
        rows.append((i, u, clock[u], float(i % 7)))
    df = spark.createDataFrame(rows, "id long, u long, t timestamp_ntz, x double")
    got = gap_sessions(df, "u", "t", 43200, "sid", sum_col="x", sum_out="tot", bucket_seconds=bucket) \
        .select("id", "sid", "tot")
    w = Window.partitionBy("u").orderBy("t", "id")
    brk = F.when(F.col("t") <= F.lag("t").over(w) + F.expr("INTERVAL 12 HOURS"), 0).otherwise(1)
    s = df.withColumn("sid", F.sum(brk).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    want = s.join(s.groupBy("u", "sid").agg(F.sum("x").alias("tot")), ["u", "sid"]).select("id", "sid", "tot")
    assert sorted(got.collect()) == sorted(want.collect())


def test_approximate_quantiles_within_rank_error(spark):
    from sessionlab.functions.quantiles import approx_quantiles
    vals = np.random.default_rng(9).normal(size=5000)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = approx_quantiles(df, ["x"], [0.25, 0.5, 0.75], accuracy=1000)["x"]
    srt = np.sort(vals)
    for p, g in zip([0.25, 0.5, 0.75], got):
        rank = np.searchsorted(srt, g)
        assert abs(rank - p * len(vals)) <= len(vals) / 1000 + 1


@pytest.mark.parametrize("n", [0, 1, 7, 40, 200, 5000])
def test_first_sessions_cut_through_ties(spark, n):
    """A third of the sessions start at one moment; some have no time."""
    from sessionlab.operators.prepare import first_session_starts, sample_sessions
    rnd = random.Random(6)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for s in range(300):
        t = base + dt.timedelta(minutes=rnd.randrange(50))
        t = base + dt.timedelta(minutes=9) if s % 3 == 0 else (None if s % 29 == 1 else t)
        for _ in range(rnd.randrange(1, 4)):
            rows.append((len(rows), t, f"s{s}"))
            t = t and t + dt.timedelta(seconds=5)
    df = spark.createDataFrame(rows, "event_id long, event_time timestamp_ntz, user_session string")
    start = {}
    for i, t, s in rows:
        start[s] = min(start.get(s, (True, dt.datetime.max, 0)), (t is not None, t or base, i))
    want = sorted(start, key=lambda s: (start[s], s))[:n]
    assert sorted(r["user_session"] for r in first_session_starts(df, n).collect()) == sorted(want)
    assert sample_sessions(df, n).count() == sum(s in set(want) for _, _, s in rows)


@pytest.mark.parametrize("limit", [10 ** 6, 0])
def test_lookup_with_hot_and_missing_keys(spark, limit):
    """A key and the missing key hold a third of all rows each."""
    from sessionlab.operators.lookup import lookup_join, salted
    rows = [(i, None if i % 3 == 0 else ("hot" if i % 3 == 1 else f"k{i % 200}")) for i in range(9000)]
    df = spark.createDataFrame(rows, "i long, key string")
    table = spark.createDataFrame([(f"k{j}", float(j)) for j in range(150)] + [("hot", -1.0), (None, 5.0)], "key string, v double")
    got = lookup_join(df, table, "key", max_broadcast_rows=limit, rows_per_salt=100, salt_by="i")
    want = {f"k{j}": float(j) for j in range(150)} | {"hot": -1.0}
    assert sorted(got.collect(), key=lambda r: r["i"]) == [(k, i, want.get(k)) for i, k in rows]
    left, right = salted(df, table.where("key is not null"), "key", 100, "i")
    held = [r["count"] for r in left.repartition(8, "key", "_salt").groupBy(F.spark_partition_id()).count().collect()]
    assert max(held) <= 2 * sorted(held)[len(held) // 2]
    assert left.groupBy("key", "_salt").count().agg(F.max("count")).first()[0] <= 200
    assert right.count() == 150 + 30


def test_selection_counts_in_the_tasks(spark):
    """no row per value is made; a task hands out sums by cell, then by value, also in pieces."""
    import pyarrow as pa
    from sessionlab.functions import quantiles as Q
    x = np.array([-np.inf, -2.5, -0.0, 0.0, 1.0, 1.0000001, 1e-300, np.inf])
    bits = Q._ordered_bits(x)
    assert list(np.argsort(bits, kind="stable")) == [0, 1, 2, 3, 6, 4, 5, 7] and bits[2] == bits[3]
    assert list(Q._from_bits(bits)) == list(x)
    batches = lambda: (pa.RecordBatch.from_arrays([pa.array([1.0, None, 2.0] * 100), pa.array([float(i)] * 300)],
                                                  names=["x0", "x3"]) for i in range(5))
    out = [r for b in Q._count_values(batches(), None) for r in b.to_pylist()]
    assert sorted((r["c"], r["cnt"]) for r in out) == [(0, 500), (0, 500)] + [(3, 300)] * 5
    cells = {0: Q._ordered_bits(np.array([2.0])) >> Q.CELL_SHIFT, 3: Q._ordered_bits(np.array([0.0, 3.0])) >> Q.CELL_SHIFT}
    held, Q.HELD = Q.HELD, 1
    try:
        out = [r for b in Q._count_values(batches(), cells) for r in b.to_pylist()]
    finally:
        Q.HELD = held
    sums = {}
    for r in out:
        sums[r["c"], r["b"], r["x"]] = sums.get((r["c"], r["b"], r["x"]), 0) + r["cnt"]
    assert sums == {(0, 0, 2.0): 500, (3, 0, 0.0): 300, (3, 1, 3.0): 300}
