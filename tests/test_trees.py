"""Trees grown in one task: Spark ML's own trees, by a few jobs a fit."""
import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from sessionlab.operators import models as M
from sessionlab.operators import trees as G

COLS = ["a", "b", "c", "d", "e", "f"]


def rows(spark, n, parts=3):
    """Sessions with few-valued, many-valued, constant and mostly zero columns."""
    u = lambda i: F.rand(i)
    df = spark.range(0, n, 1, parts).select(
        F.concat(F.lit("s"), "id").alias("user_session"), F.floor(u(1) * 3).cast("double").alias("a"),
        (u(2) * 100).alias("b"), F.lit(4.0).alias("c"), F.when(u(3) < 0.2, u(4)).otherwise(0.0).alias("d"),
        F.floor(u(5) * 40 - 20).cast("double").alias("e"), F.floor(u(6) * 2).cast("double").alias("f"))
    value = F.col("a") * 9 + F.sin(F.col("b") / 9) * 20 + F.col("d") * F.col("e") + F.round(u(7) * 30, 2)
    return df.withColumn("session_value", value).checkpoint()


def strings(model):
    return [t.toDebugString.split("\n", 1)[1] for t in model.trees]


def both(data, spec):
    est = M._regressor(spec, "_v", "session_value", "p")
    grown = G.grow(est, data, COLS, "session_value")
    assembled = VectorAssembler(inputCols=COLS, outputCol="_v").transform(data)
    return grown, est.fit(assembled), assembled


@pytest.mark.parametrize("name, change", [
    ("lightgbm", {"maxIter": 4}), ("xgboost", {"maxIter": 4}), ("catboost", {"maxIter": 4}),
    ("random_forest", {"numTrees": 12}), ("random_forest", {"numTrees": 7, "maxMemoryInMB": 1}),
    ("small", {"numTrees": 3}), ("conservative", {"numTrees": 5})])
def test_grown_trees_are_those_of_spark_ml(spark, name, change):
    named = {"small": M.SMALL_FOREST, "conservative": M.CONSERVATIVE_FOREST}
    spec = {k: v for k, v in (named.get(name) or M.CONFIG[name]).items() if k != "early_stopping"} | change
    grown, own, assembled = both(rows(spark, 1500), spec)
    assert strings(grown.spark_model()) == strings(own)
    assert grown.importances() == pytest.approx(own.featureImportances.toArray(), abs=1e-12)
    scored = G.add_scores(assembled.drop("_v"), COLS, [("q", grown)])
    pair = own.transform(assembled).select("user_session", "p").join(scored.select("user_session", "q"), "user_session")
    assert pair.where(F.abs(F.col("p") - F.col("q")) > 1e-9).count() == 0 and pair.count() == 1500


def test_thresholds_of_a_sample(spark):
    """Above 65,536 rows Spark takes its thresholds from a sample of rows."""
    data = rows(spark, 70_000, 2)
    grown, own, _ = both(data, {"kind": "gbt", "maxIter": 2, "maxDepth": 4, "subsamplingRate": 0.8, "maxBins": 256})
    assert strings(grown.spark_model()) == strings(own)


def test_a_fit_is_a_few_jobs(spark):
    """Rounds and levels are no jobs of their own (30 rounds were over 60 jobs)."""
    data, sc = rows(spark, 600), spark.sparkContext
    for spec in (dict(M.CONFIG["xgboost"], maxIter=30), dict(M.CONFIG["catboost"], maxIter=30),
                 dict(M.SMALL_FOREST, numTrees=5)):
        sc.setJobGroup("one fit", "")
        before = len(sc.statusTracker().getJobIdsForGroup("one fit"))
        model = M.fit_model(data, COLS, spec, prepared=True)
        jobs = len(sc.statusTracker().getJobIdsForGroup("one fit")) - before
        sc.setLocalProperty("spark.jobGroup.id", None)
        assert jobs <= 6 and model.pred_col == "prediction"


def test_errors_per_round_of_held_rows(spark):
    data = rows(spark, 900)
    held = F.col("e") > 10
    est = M._regressor({"kind": "gbt", "maxIter": 5, "maxDepth": 3}, "_v", "session_value", "p")
    grown = G.grow(est, data, COLS, "session_value", held)
    va = VectorAssembler(inputCols=COLS, outputCol="_v")
    own = est.fit(va.transform(data.where(~held)))
    assert grown.errors == pytest.approx(own.evaluateEachIteration(va.transform(data.where(held)), "squared"))
    short = grown.prefix(2)
    assert strings(short.spark_model()) == strings(own)[:2] and short.shipped().value["starts"].shape == (3,)


def test_other_fits_stay_with_spark_ml(spark, monkeypatch):
    data = rows(spark, 300)
    est = M._regressor({"kind": "gbt", "maxIter": 2, "maxDepth": 2}, "_v", "session_value", "p")
    odd = data.withColumn("b", F.when(F.col("b") < 1, float("nan")).otherwise(F.col("b"))).checkpoint()
    assert G.grow(est, odd, COLS, "session_value") is None
    assert G.grow(est, data.where("a > 5"), COLS, "session_value") is None
    assert G.spec_of(est.copy().setWeightCol("b"), 6) is None
    monkeypatch.setattr(G, "MAX_TASK_ROWS", 299)
    assert G.grow(est, data, COLS, "session_value") is None
    forest = dict(M.SMALL_FOREST, numTrees=2, maxDepth=3)
    assert not isinstance(M.fit_model(data, COLS, forest, prepared=True), M.GrownModel)
    monkeypatch.setattr(G, "MAX_TASK_ROWS", 300)
    assert isinstance(M.fit_model(data, COLS, forest, prepared=True), M.GrownModel)


def test_scores_of_folds_with_repeated_and_missing_keys(spark):
    """Each row is scored once by the model of its fold, whatever its key."""
    data = rows(spark, 400).withColumn("user_session", F.when(F.col("a") > 0, F.col("user_session"))) \
        .withColumn("_fold", F.col("f").cast("int")).checkpoint()
    spec = {"kind": "rf", "numTrees": 4, "maxDepth": 4}
    models = [(f, "m", M.fit_model(data.where(F.col("_fold") != f), COLS, spec, "m", pred="_p", prepared=True))
              for f in (0, 1)]
    out = M._out_of_fold(data, models, ["m"])
    assert out.columns == ["user_session", "model", "fold", "prediction"] and out.count() == 400
    own = [m.pipeline.transform(data.where(F.col("_fold") == f)).select(F.col("_p")) for f, _, m in models]
    want = sorted(r[0] for d in own for r in d.collect())
    assert np.allclose(sorted(r["prediction"] for r in out.collect()), want)
