"""Sinks, feature store, cleaning edge cases and the driver contract."""
import datetime as dt
import importlib.util
import os

import pytest
from pyspark.sql import functions as F

from sessionlab.operators import prepare as P
from sessionlab.operators import validate as V
from sessionlab.schema import CLICK_SCHEMA
from sessionlab.sources import sinks
from sessionlab.sources.clicklog import read_clicks
from conftest import ROOT, SF001


def test_feature_store_reuses_and_rebuilds(spark, tmp_out):
    src = spark.read.parquet(f"{SF001}/events.parquet")
    calls = []

    def build():
        calls.append(1)
        return src.groupBy("user_id").count()

    path = f"{tmp_out}/store"
    sinks.cached_feature_tables(spark, path, {"train": build}, {"v": 1}, [src])
    sinks.cached_feature_tables(spark, path, {"train": build}, {"v": 1}, [src])
    assert len(calls) == 1
    sinks.cached_feature_tables(spark, path, {"train": build}, {"v": 2}, [src])
    out = sinks.cached_feature_tables(spark, path, {"train": build}, {"v": 2}, [src], force=True)
    assert len(calls) == 3 and out["train"].count() == src.select("user_id").distinct().count()


def test_processed_splits_and_lists(spark, tmp_out):
    df = spark.createDataFrame([("a", 1.0), ("b", -2.0)], "user_session string, prediction double")
    sinks.save_processed(df, df, df, f"{tmp_out}/proc")
    assert sinks.read_processed(spark, f"{tmp_out}/proc", "validation").count() == 2
    sinks.write_feature_list(spark, ["z", "a", "m"], f"{tmp_out}/list")
    assert sinks.read_feature_list(spark, f"{tmp_out}/list") == ["z", "a", "m"]
    sub = sinks.create_submission(df, f"{tmp_out}/sub")
    assert sorted(r["session_value"] for r in sub.collect()) == [0.0, 1.0]


def test_csv_click_log_and_cleaning(spark, tmp_out):
    path = f"{tmp_out}/train.csv"
    with open(path, "w") as f:
        f.write("event_time,event_type,product_id,category_id,user_id,user_session,session_value\n")
        f.write("2024-01-02 10:00:00,VIEW,P1,,U1,S1,10.0\n")
        f.write("2024-01-02 10:00:00,VIEW,P1,,U1,S1,10.0\n")
        f.write("2024-01-02 10:01:00,BUY,,C1,U1,S1,\n")
        f.write("2024-01-03 10:01:00,BUY,P2,C1,U2,S2,30.0\n")
    df = read_clicks(spark, path)
    assert dict(df.dtypes)["event_time"] == "timestamp_ntz"
    clean = P.clean_clicks(df)
    assert clean.count() == 3
    assert clean.filter(F.col("product_id").isNull() | F.col("category_id").isNull()).count() == 0
    assert sorted(r["session_value"] for r in clean.collect()) == [10.0, 20.0, 30.0]  # median of 10, 30
    with pytest.raises(ValueError):
        P.remove_outliers(clean, method="zscore")


def test_split_date_boundary_goes_to_validation(spark):
    rows = [(dt.datetime(2024, 1, 23, 23, 59, 59), "VIEW", "P", "C", "U", "S", 1.0),
            (dt.datetime(2024, 1, 24, 0, 0, 0), "VIEW", "P", "C", "U", "S", 1.0)]
    tr, va = P.temporal_split(spark.createDataFrame(rows, CLICK_SCHEMA), "2024-01-24")
    assert tr.count() == 1 and va.count() == 1


def test_validate_features_reports_issues(spark):
    tr = spark.createDataFrame([(1, 1.0)], "a int, b double")
    te = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, c double")
    rows = {r["feature"]: r for r in V.validate_features(tr, te, ["a", "b"]).collect()}
    assert not rows["a"]["dtype_match"] and not rows["b"]["in_test"]
    with pytest.raises(ValueError):
        V.require_features(te, ["a", "b"])


def test_entry_contract(spark):
    spec = importlib.util.spec_from_file_location("entry_mod", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.count() > 0 and len(df.columns) == 88
    assert set(mod.oracle_sql()) <= set(mod.queries())


def test_shuffle_partition_sizing(spark):
    from sessionlab.session import input_bytes, size_shuffle_partitions
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    assert input_bytes(ev) > 0
    assert size_shuffle_partitions(spark, ev) == 8          # tests set 8 explicitly: left alone


def test_workspace_projection_keeps_standalone_order(spark):
    from sessionlab.operators.features import build_features
    from sessionlab.plans.workspace import workspace
    ws = workspace(spark, SF001)
    ws.features("train")
    for fams in (["research"], ["temporal"], ["base", "temporal"]):
        proj = ws.features("train", fams)
        rates = ws.rates() if "research" in fams else None
        assert proj.columns == build_features(ws.split("train"), fams, rates).columns


def test_staged_tables_are_released(spark):
    from sessionlab.plans import workspace as W
    from sessionlab.sources import store
    df = store.stage(spark.range(10), "release_check")
    assert df.count() == 10
    assert W.release(spark) >= 1
    assert store.release(spark) == 0
    ws = W.workspace(spark, SF001)                  # rebuilt from the raw tables after a release
    assert ws.features("train", ["base"]).count() > 0


def _cache(spark, path, src, calls, version=1, force=False):
    def build():
        calls.append(1)
        return src.groupBy("event_type").count()
    return sinks.cached_feature_tables(spark, path, {"train": build, "val": build}, {"v": version}, [src], force)


def test_cache_of_a_cached_input(spark, tmp_out):
    src = spark.read.parquet(f"{SF001}/events.parquet").where("value > 1")
    stamp = sinks.input_fingerprint(src)
    src.cache().count()
    try:
        assert sinks.input_fingerprint(src) == stamp
        calls = []
        for _ in range(2):
            _cache(spark, f"{tmp_out}/c", src, calls)
        assert len(calls) == 2                                   # two tables, built once
    finally:
        src.unpersist()


def test_fingerprint_sees_the_whole_plan(spark):
    src = spark.read.parquet(f"{SF001}/events.parquet")
    wide = lambda last: src.select(*[F.lit(i).alias(f"c{i}") for i in range(44)], F.lit(last).alias("z"))
    assert sinks.input_fingerprint(wide(1)) == sinks.input_fingerprint(wide(1))
    assert sinks.input_fingerprint(wide(1)) != sinks.input_fingerprint(wide(2))
    kind = lambda v: src.where(F.col("event_type") == v)
    assert sinks.input_fingerprint(kind("a#1")) != sinks.input_fingerprint(kind("a#2"))


def test_fingerprint_sees_changed_files(spark, tmp_out):
    src = spark.read.parquet(f"{SF001}/events.parquet")
    src.limit(5).write.parquet(f"{tmp_out}/in")
    a = sinks.input_fingerprint(spark.read.parquet(f"{tmp_out}/in"))
    src.limit(6).write.mode("append").parquet(f"{tmp_out}/in")
    assert sinks.input_fingerprint(spark.read.parquet(f"{tmp_out}/in")) != a


def test_build_that_dies_and_two_writers(spark, tmp_out):
    src, path, calls = spark.read.parquet(f"{SF001}/events.parquet"), f"{tmp_out}/c", []

    def dies():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        sinks.cached_feature_tables(spark, path, {"train": lambda: src.limit(3), "val": dies}, {"v": 1}, [src])
    inner = []

    def build_while_another_writes():
        if not inner:
            inner.append(_cache(spark, path, src, calls))         # a second writer finishes in between
        return src.groupBy("event_type").count()

    mine = sinks.cached_feature_tables(spark, path, {"train": build_while_another_writes, "val": build_while_another_writes},
                                       {"v": 1}, [src])
    assert len(calls) == 2                                        # the died build was no hit for the second writer
    want = sorted(src.groupBy("event_type").count().collect())
    for tables in (mine, inner[0], _cache(spark, path, src, calls)):
        assert sorted(tables["train"].collect()) == sorted(tables["val"].collect()) == want
    assert len(calls) == 2                                        # and either build is a hit now
    other = _cache(spark, path, src, calls, version=2)
    assert sinks.prune_versions(spark, path) == 2                 # the died one and the older of two equal ones
    assert sorted(_cache(spark, path, src, calls)["val"].collect()) == want
    assert sorted(other["train"].collect()) == want and len(calls) == 4


def test_csv_contract(spark, tmp_out):
    from sessionlab.sources.clicklog import write_clicks
    t = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    rows = [(t, "VIEW", "", None, 'say "hi", \\ twice', "S1", 1.5), (None, None, "a,b", " pad ", "U", None, None),
            (t, "BUY", '"', "''", "\u00e9\u6f22", "S2", -0.1)]
    df = spark.createDataFrame(rows, CLICK_SCHEMA)
    write_clicks(df, f"{tmp_out}/log")
    df = df.withColumn("product_id", F.nullif("product_id", F.lit("")))          # empty is missing
    assert sorted(read_clicks(spark, f"{tmp_out}/log").collect(), key=str) == sorted(df.collect(), key=str)
    lines = df.withColumn("user_id", F.lit("two\nlines"))
    write_clicks(lines, f"{tmp_out}/lines")
    assert sorted(read_clicks(spark, f"{tmp_out}/lines", multiline=True).collect(), key=str) == sorted(lines.collect(), key=str)


def test_csv_bad_records(spark, tmp_out):
    with open(f"{tmp_out}/bad.csv", "w") as f:
        f.write("event_time,event_type,product_id,category_id,user_id,user_session,session_value\n"
                "2024-01-02 10:00:00,VIEW,P1,C1,U1,S1,10.0\n2024-01-02 10:00:00,VIEW,P1,C1,U1,S1,ten\n"
                "yesterday,VIEW,P1,C1,U1,S1,1.0\n2024-01-02 10:00:00,VIEW\n")
    with pytest.raises(Exception):
        read_clicks(spark, f"{tmp_out}/bad.csv").collect()
    got = read_clicks(spark, f"{tmp_out}/bad.csv", bad_column="bad").cache().collect()
    assert [r["bad"] is None for r in got] == [True, False, False, False]
    assert got[1]["session_value"] is None and got[2]["event_time"] is None and got[2]["bad"] == "yesterday"


def test_text_files_and_processed_csv(spark, tmp_out):
    lines = ["b", "", "a, c", "\u00e9"]
    sinks.write_text(spark, lines, f"{tmp_out}/t")
    assert sinks.read_text(spark, f"{tmp_out}/t") == lines
    part = [f for f in os.listdir(f"{tmp_out}/t") if f.startswith("part-")]
    assert len(part) == 1 and open(f"{tmp_out}/t/{part[0]}").read() == "b\n\na, c\n\u00e9\n"
    df = spark.createDataFrame([(1, "x", None), (2, " y", 0.5)], "i long, s string, session_value double")
    sinks.save_processed(df, df.limit(0), df.drop("session_value"), f"{tmp_out}/p", "csv")
    back = lambda split: sorted(sinks.read_processed(spark, f"{tmp_out}/p", split, "csv", df.schema).collect())
    assert back("train") == sorted(df.collect()) and back("validation") == []
    assert back("test") == [(1, "x", None), (2, " y", None)]
