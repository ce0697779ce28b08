"""Regressions: feature cache, ensemble persistence and fits, empty inputs."""
import pytest
from pyspark.sql import functions as F

from sessionlab.operators import models as M
from sessionlab.operators import prepare as P
from sessionlab.sources import sinks
from conftest import SF001


def test_cache_tells_filters_of_one_file_apart(spark, tmp_out):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    for kind in ("click", "view", "click"):
        src = events.where(F.col("event_type") == kind)
        out = sinks.cached_feature_tables(spark, f"{tmp_out}/c", {"train": lambda s=src: s.select("event_type").distinct()},
                                          {"v": 1}, [src])
        assert [r[0] for r in out["train"].collect()] == [kind]


def test_cache_refuses_inputs_without_files(spark, tmp_out):
    df = spark.range(3)
    with pytest.raises(ValueError):
        sinks.cached_feature_tables(spark, f"{tmp_out}/c", {"train": lambda: df}, {}, [df])


def test_failed_rebuild_is_no_hit(spark, tmp_out):
    src = spark.read.parquet(f"{SF001}/events.parquet")
    sinks.cached_feature_tables(spark, f"{tmp_out}/c", {"train": lambda: src.limit(1)}, {"v": 1}, [src])

    def fails():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        sinks.cached_feature_tables(spark, f"{tmp_out}/c", {"train": fails}, {"v": 1}, [src], force=True)
    calls = []
    sinks.cached_feature_tables(spark, f"{tmp_out}/c", {"train": lambda: calls.append(1) or src.limit(1)}, {"v": 1}, [src])
    assert calls == [1]


def test_best_iteration_waits_for_patience():
    assert M.best_iteration([]) == 0
    assert M.best_iteration([3, 2, 2.5, 2.4, 1.9, 2]) == 5
    assert M.best_iteration([3, 2] + [2.5] * 99 + [1.0]) == 102
    assert M.best_iteration([3, 2] + [2.5] * 100 + [1.0]) == 2


def test_final_fits_see_every_row_and_any_members_load(spark, tmp_out, monkeypatch):
    df = spark.range(400).select(F.concat(F.lit("s"), "id").alias("user_session"), (F.col("id") % 7).cast("double").alias("a"),
                                 (F.col("id") % 5).cast("double").alias("b"),
                                 ((F.col("id") % 7) * 3 + F.rand(1)).alias("session_value"))
    seen = []
    fit = M.fit_model

    def spy(data, features, spec, name="model", *a, **kw):
        if kw.get("pred") == name:
            seen.append((name, data.count(), bool(spec.get("early_stopping"))))
        return fit(data, features, spec, name, *a, **kw)

    monkeypatch.setattr(M, "fit_model", spy)
    config = {"catboost": dict(M.CONFIG["catboost"], maxIter=4, maxDepth=2)}
    ens = M.fit_ensemble(df, ["a", "b"], config, k=2)
    assert seen == [("catboost", 400, False)]
    ens.write(f"{tmp_out}/e")
    again = M.EnsembleModel.load(spark, f"{tmp_out}/e")
    assert list(again.members) == ["catboost"]
    diff = ens.transform(df).select("user_session", F.col("prediction").alias("p")).join(
        again.transform(df).select("user_session", F.col("prediction").alias("q")), "user_session")
    assert diff.where("p <> q").count() == 0
    prefix = ens.members["catboost"].pipeline.stages[-1].trees
    shorter = M.fit_model(df, ["a", "b"], dict(M.CONFIG["catboost"], maxIter=2, maxDepth=2, early_stopping=False), "x")
    assert [t.toDebugString.split("\n", 1)[1] for t in shorter.pipeline.stages[-1].trees] == \
        [t.toDebugString.split("\n", 1)[1] for t in prefix[:2]]


def test_outliers_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "user_session string, session_value double")
    assert P.remove_outliers(df).count() == 0
    assert P.remove_outliers(spark.createDataFrame([("a", None)], df.schema)).count() == 0


def test_correlation_matrix_is_pairwise_complete(spark):
    from sessionlab.operators.select import correlation_matrix
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 4.0, 0.0), (3.0, 6.0, 1.0), (None, 50.0, 1.0), (9.0, None, 0.0)],
                               "a double, b double, c double")
    m = correlation_matrix(df, ["a", "b", "c"])
    assert m[0][1] == m[1][0] == pytest.approx(1.0)
    assert m[0][2] == pytest.approx(df.toPandas()[["a", "c"]].corr().iloc[0, 1])
    assert correlation_matrix(df, []) == []
