"""Models: ridge against the closed form, ensemble contract, persistence,
cross-validation, beating the median baseline."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionlab.operators import evaluate as E
from sessionlab.operators import folds as CV
from sessionlab.operators import models as M
from sessionlab.operators import select as S
from sessionlab.operators.features import build_features
from sessionlab.operators.rates import RateModel
from sessionlab.plans.workspace import workspace
from conftest import SF01, reduced


@pytest.fixture(scope="module")
def tables(spark):
    ws = workspace(spark, SF01)
    return ws.features("train"), ws.features("val"), ws.split("train")


def test_ridge_matches_closed_form(tables):
    tr, _, _ = tables
    cols = ["buy_count", "total_events", "view_count", "unique_products"]
    m = M.fit_ridge(tr, cols, alpha=10.0)
    pdf = tr.select(*cols, "session_value").toPandas()
    X = pdf[cols].to_numpy(float)
    y = pdf["session_value"].to_numpy(float)
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + 10.0 * np.eye(len(cols)), Xc.T @ yc)
    b = y.mean() - X.mean(0) @ w
    lr = m.pipeline.stages[-1]
    assert np.allclose(lr.coefficients.toArray(), w, rtol=1e-6, atol=1e-8)
    assert lr.intercept == pytest.approx(b, rel=1e-6)


def test_ensemble_contract_and_persistence(spark, tables, tmp_out):
    tr, va, _ = tables
    feats = S.top_k_by_correlation(tr, 6)
    cfg = reduced(M.CONFIG)
    for spec in cfg.values():
        spec.update({"maxIter": 3} if spec["kind"] == "gbt" else {"numTrees": 5})
    ens = M.fit_ensemble(tr, feats, cfg, k=3)
    out = ens.transform(va)
    assert out.count() == va.count()
    assert ens.oof.count() == tr.count() * 4
    assert ens.oof.select("fold").distinct().count() == 3
    # one-pass OOF equals the fold model scoring its own held-out rows
    f, name, fm = ens.fold_models[-1]
    held = tr.join(ens.oof.filter((F.col("model") == name) & (F.col("fold") == f)), "user_session")
    direct = fm.transform(held).select("user_session", F.col("_p").alias("direct"), "prediction")
    assert direct.count() > 0
    assert direct.filter(F.abs(F.col("direct") - F.col("prediction")) > 1e-9).count() == 0
    assert sum(v for _, v in ens.importance) == pytest.approx(1.0, abs=1e-6)
    # blend = weighted sum of member columns
    diff = out.select(F.max(F.abs(F.col("prediction") - (0.4 * F.col("lightgbm") + 0.3 * F.col("xgboost")
                                                        + 0.2 * F.col("catboost") + 0.1 * F.col("random_forest")))))
    assert diff.first()[0] < 1e-9
    ens.write(f"{tmp_out}/ens")
    back = M.EnsembleModel.load(spark, f"{tmp_out}/ens")
    a = out.select("user_session", "prediction").orderBy("user_session").collect()
    b = back.transform(va).select("user_session", "prediction").orderBy("user_session").collect()
    assert [r[1] for r in a] == pytest.approx([r[1] for r in b])
    # beats the median baseline on validation
    fitted = E.regression_metrics(out.select(F.col("session_value").alias("actual"),
                                             F.col("prediction").alias("predicted"))).first()["rmse"]
    med = M.median_baseline(tr, va).withColumnRenamed("session_value", "predicted").join(
        va.select("user_session", F.col("session_value").alias("actual")), "user_session")
    assert fitted < E.regression_metrics(med).first()["rmse"]


def test_blend_skips_missing_without_renormalising(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    out = M.blend_predictions(df, {"a": 0.4, "b": 0.3, "c": 0.3}).first()["session_value"]
    assert out == pytest.approx(0.4 + 0.6)


def test_temporal_cross_validation(tables):
    tr, _, train_clicks = tables
    feats = ["buy_count", "total_events"]
    ix = CV.temporal_folds(CV.ordered_sessions(tr, train_clicks))
    data = ix.select("user_session", "row_index", "test_fold", "session_value", *feats)
    res = M.cross_validate(data, feats, lambda d, f: M.fit_ridge(d, f, 1.0), "test_fold", 5, temporal=True).first()
    assert res["rmse_mean"] > 0 and res["rmse_std"] >= 0


def test_fold_bounds_like_expanding_window():
    assert CV.temporal_fold_bounds(12, 5) == [(2, 4), (4, 6), (6, 8), (8, 10), (10, 12)]


def test_train_score_and_validation_flows(spark, tmp_out):
    from sessionlab.plans import flows
    from sessionlab.sources.adapter import load_clicks
    from conftest import SF001
    clicks = load_clicks(spark, SF001)
    cfg = reduced(M.CONFIG)
    for spec in cfg.values():
        spec.update({"maxIter": 2} if spec["kind"] == "gbt" else {"numTrees": 3})
    test_clicks = clicks.where("event_id % 2 = 0").drop("session_value")
    res = flows.train_flow(clicks, f"{tmp_out}/run", config=cfg, run_cv=False, test_clicks=test_clicks)
    assert res.history.select("model_name").distinct().count() == 2
    # one fitted engine for all three: the test features use the rates of train
    rates = RateModel.read(spark, f"{tmp_out}/run/rates")
    again = build_features(test_clicks, rates=rates).select("user_session", "avg_engagement", "max_product_score")
    assert sorted(again.collect()) == sorted(res.tables["test"].select(*again.columns).collect())
    sub = spark.read.option("header", True).csv(f"{tmp_out}/run/submission")
    assert sub.count() == test_clicks.select("user_session").distinct().count()
    from sessionlab.sources import sinks
    assert sinks.read_text(spark, f"{tmp_out}/run/evaluation_report_text")[0] == "=== MODEL EVALUATION REPORT ==="
    small = {"random_forest": {"kind": "rf", "numTrees": 3, "maxDepth": 3}}
    cv = flows.train_flow(clicks, f"{tmp_out}/run_cv", config=small, cv_folds=2, ensemble_folds=2).cv.first()
    assert cv["rmse_mean"] > 0
    ft_path = f"{tmp_out}/validation_features"
    res.tables["validation"].write.parquet(ft_path)
    scored = flows.score_feature_table(spark, ft_path, f"{tmp_out}/run", f"{tmp_out}/sub2").first()
    assert scored["min"] >= 0
    from sessionlab.operators.evaluate import report_text
    rep = spark.read.parquet(f"{tmp_out}/run/evaluation_report")
    text = report_text(rep, "Ensemble")
    assert "RMSE:" in text and "Overall:" in text
    full = flows.full_data_flow(clicks, f"{tmp_out}/full", f"{tmp_out}/run/selected_features",
                                config=small, ensemble_folds=2)
    assert full.features == res.features
    tr, va = res.tables["train"], res.tables["validation"]
    table = flows.full_training_table(clicks)[0]
    assert table.count() == tr.count() + va.count()
    assert sorted(table.select("user_session", "total_category_score").collect()) == sorted(
        tr.unionByName(va).select("user_session", "total_category_score").collect())
    fixed = flows.conservative_flow(clicks, test_clicks, f"{tmp_out}/cons", M.CONSERVATIVE_FEATURES).first()
    assert fixed["mse"] > 0 and sinks.read_feature_list(spark, f"{tmp_out}/cons/selected_features") == M.CONSERVATIVE_FEATURES
    flows.conservative_flow(clicks, test_clicks, f"{tmp_out}/cons8")
    picked = sinks.read_feature_list(spark, f"{tmp_out}/cons8/selected_features")
    from sessionlab.operators.features import feature_names
    assert len(picked) == 8 and set(picked) <= set(feature_names(["research"]))
    values = [float(r[1]) for r in spark.read.option("header", True).csv(f"{tmp_out}/cons8/submission").collect()]
    assert 5 <= min(values) and max(values) <= 300
    summary = flows.score_flow(clicks, f"{tmp_out}/run", f"{tmp_out}/sub").first()
    assert summary["min"] >= 0
    for sizes in ({"n_train": 100, "n_val": 50}, {}):
        gate = flows.temporal_validation_flow(clicks, **sizes).first()
        assert gate["train_rmse"] > 0 and gate["val_rmse"] > 0


def test_stream_scoring(spark, tables, tmp_out):
    from sessionlab.streaming.scoring import score_stream
    tr, va, _ = tables
    feats = ["buy_count", "total_events"]
    cfg = {"random_forest": {"kind": "rf", "numTrees": 3, "maxDepth": 3}}
    ens = M.fit_ensemble(tr, feats, cfg, weights={"random_forest": 1.0}, k=2)
    ens.write(f"{tmp_out}/m/model")
    va.write.parquet(f"{tmp_out}/in")
    q = score_stream(spark, f"{tmp_out}/in", f"{tmp_out}/m", f"{tmp_out}/out", f"{tmp_out}/ck", va.schema)
    q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_out}/out").count() == va.count()


def test_prefix_of_a_long_fit_is_the_shorter_fit(spark, tables, tmp_out):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler
    tr, _, _ = tables
    cols = ["buy_count", "total_events", "duration_minutes"]
    va = VectorAssembler(inputCols=cols, outputCol="_v")
    data = va.transform(tr.select("user_session", "session_value", *cols))
    spec = dict(M.CONFIG["lightgbm"], maxDepth=3)
    fit = lambda n: M._regressor(dict(spec, maxIter=n), "_v", "session_value", "p").fit(data)
    long, short = fit(9), fit(4)
    prefix = M.prefix_model(long, 4)
    values = lambda m: [r["p"] for r in m.transform(data).orderBy("user_session").collect()]
    assert prefix.getNumTrees == 4 and values(prefix) == values(short)
    assert prefix.featureImportances.toArray() == pytest.approx(short.featureImportances.toArray())
    PipelineModel([va, prefix]).write().save(f"{tmp_out}/p")
    assert values(PipelineModel.load(f"{tmp_out}/p").stages[-1]) == values(short)


def test_early_stopping_fits_once(spark, tables, monkeypatch):
    tr, _, _ = tables
    fits, real = [], M._regressor
    monkeypatch.setattr(M, "_regressor", lambda *a, **k: fits.append(1) or real(*a, **k))
    spec = dict(M.CONFIG["catboost"], maxIter=6, maxDepth=2)
    m = M.fit_model(tr, ["buy_count", "total_events"], spec)
    assert len(fits) == 1 and 1 <= m.pipeline.stages[-1].getNumTrees <= 6
    # patience ends within the first rounds: no further fit; else all rounds, and the same model as at once
    monkeypatch.setattr(M, "EARLY_STOP_PATIENCE", 2)
    monkeypatch.setattr(M, "best_iteration", lambda errors, patience=2: min(3, len(errors)))
    for first, many in ((5, 1), (4, 2)):
        fits.clear()
        monkeypatch.setattr(M, "FIRST_ROUNDS", first)
        assert M.fit_model(tr, ["buy_count"], spec).pipeline.stages[-1].getNumTrees == 3 and len(fits) == many


def test_any_estimator_as_a_member(spark, tables, tmp_out):
    """M1: a linear and an isotonic regressor in one ensemble, saved and loaded."""
    from pyspark.ml.regression import IsotonicRegression, LinearRegression
    tr, va, _ = tables
    cols = ["buy_count", "total_events"]
    cfg = {"linear": {"kind": "estimator", "estimator": LinearRegression(), "regParam": 0.5, "elasticNetParam": 0.0},
           "isotonic": {"kind": "estimator", "estimator": IsotonicRegression(featureIndex=1)}}
    ens = M.fit_ensemble(tr, cols, cfg, weights={"linear": 0.3, "isotonic": 0.7}, k=2)
    assert ens.members["linear"].pipeline.stages[-1].getRegParam() == 0.5
    out = ens.transform(va)
    gap = F.abs(F.col("prediction") - 0.3 * F.col("linear") - 0.7 * F.col("isotonic"))
    assert out.agg(F.max(gap)).first()[0] < 1e-9 and ens.oof.count() == 2 * tr.count()
    ens.write(f"{tmp_out}/any")
    meta = spark.read.parquet(f"{tmp_out}/any/isotonic/meta").first()
    assert meta["model_class"].endswith("IsotonicRegressionModel")
    again = M.EnsembleModel.load(spark, f"{tmp_out}/any").transform(va)
    pick = lambda d: [r[0] for r in d.orderBy("user_session").select("prediction").collect()]
    assert pick(again) == pytest.approx(pick(out))
    with pytest.raises(ValueError):
        M.fit_model(tr, cols, {"kind": "other"})


def test_rounds_cache_no_node_ids(spark):
    """The single shallow tree of a round is grown without cached node ids, deep forests with them."""
    boosted = M._regressor(M.CONFIG["xgboost"], "_v", "y", "p")
    assert not boosted.getCacheNodeIds() and boosted.getMaxIter() == 500
    assert M._regressor(M.SMALL_FOREST, "_v", "y", "p").getCacheNodeIds()
    assert M._regressor(dict(M.CONFIG["xgboost"], cacheNodeIds=True), "_v", "y", "p").getCacheNodeIds()
