"""End-to-end flows: train (3.1), score (3.2), temporal validation (3.3),
full-data training (M15).  Each is a short composition of the operators;
every heavy step is a Spark job, artifacts go to ``out_dir`` (any Hadoop
path), and reports are keyed by name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlab.operators import evaluate as E
from sessionlab.operators import folds as CV
from sessionlab.operators import models as M
from sessionlab.operators import select as S
from sessionlab.operators.features import FAMILIES, build_features
from sessionlab.operators.linear import RidgeModel, fit_ridge_moments
from sessionlab.operators.prepare import DEFAULT_SPLIT_DATE, clip, sample_sessions, temporal_split
from sessionlab.operators.rates import RateModel, fit_rates
from sessionlab.operators.validate import require_features
from sessionlab.schema import SESSION, TARGET
from sessionlab.sources import sinks
from sessionlab.sources.store import stage

# Selection of the temporal validation.
VALIDATION_SELECTION = {"correlation_threshold": 0.03, "max_features": 20}


@dataclass
class TrainResult:
    model: M.EnsembleModel
    features: list[str]
    rates: RateModel
    history: DataFrame
    cv: DataFrame | None
    tables: dict[str, DataFrame]


def _scored(model, df: DataFrame) -> DataFrame:
    return model.transform(df).select(SESSION, F.col(TARGET).alias("actual"), F.col("prediction").alias("predicted"))


def _report(scored: DataFrame, out_dir: str, name: str) -> None:
    """E4 beside the model: as a table and as the reference's text."""
    report = E.evaluation_report(E.regression_metrics(scored.select("actual", "predicted"), model_name=name))
    sinks.write_table(report, f"{out_dir}/evaluation_report")
    saved = scored.sparkSession.read.parquet(f"{out_dir}/evaluation_report")
    sinks.write_text(saved.sparkSession, E.report_text(saved, name).splitlines(), f"{out_dir}/evaluation_report_text")


def train_flow(clicks: DataFrame, out_dir: str, split_date: str = DEFAULT_SPLIT_DATE,
               families=FAMILIES, config: dict | None = None, selection: dict | None = None,
               cv_folds: int = CV.DEFAULT_FOLDS, run_cv: bool = True, force: bool = False,
               ensemble_folds: int = CV.DEFAULT_FOLDS, test_clicks: DataFrame | None = None) -> TrainResult:
    """3.1: split, fit lookups on train, build (or reuse) the feature tables of
    train, validation and, if given, test with that one fit, select, fit the
    ensemble, evaluate train/validation, temporal CV with a fresh model per
    fold, persist model, feature list, predictions, report; score the test
    split to ``submission``."""
    spark = clicks.sparkSession
    train_c, val_c = temporal_split(clicks, split_date)
    rates = fit_rates(train_c)
    rates.write(f"{out_dir}/rates")
    cfg = {"families": list(families), "split_date": split_date}
    builders = {"train": lambda: build_features(train_c, families, rates),
                "validation": lambda: build_features(val_c, families, rates)}
    inputs = [clicks]
    if test_clicks is not None:
        builders["test"] = lambda: build_features(test_clicks, families, rates)
        inputs.append(test_clicks)
    tables = sinks.cached_feature_tables(spark, f"{out_dir}/features", builders, cfg, inputs, force)
    tr, va = tables["train"], tables["validation"]
    sel = S.feature_selection(tr, **(selection or {}))
    model = M.fit_ensemble(tr, sel.features, config, k=ensemble_folds)
    hist = E.EvaluationHistory()
    hist.evaluate(_scored(model, tr), "train")
    val_scored = _scored(model, va)
    hist.evaluate(val_scored, "validation")
    cv = None
    if run_cv:
        ix = CV.temporal_folds(CV.ordered_sessions(tr, train_c), cv_folds)
        data = ix.select(SESSION, "row_index", "test_fold", TARGET, *sel.features)
        cv = M.cross_validate(data, sel.features,
                              lambda d, f: M.fit_ensemble(d, f, config, k=ensemble_folds),
                              "test_fold", cv_folds, temporal=True)
    model.write(f"{out_dir}/model")
    sinks.write_feature_list(spark, sel.features, f"{out_dir}/selected_features")
    sinks.write_predictions(val_scored.withColumnRenamed("predicted", "prediction"), f"{out_dir}/validation_predictions",
                            label="actual")
    _report(val_scored, out_dir, "validation")
    sinks.write_table(hist.table(), f"{out_dir}/evaluation_history")
    if test_clicks is not None:
        require_features(tables["test"], sel.features)
        sinks.create_submission(model.transform(tables["test"]), f"{out_dir}/submission")
    return TrainResult(model, sel.features, rates, hist.table(), cv, tables)


def score_flow(clicks: DataFrame, model_dir: str, out_path: str, families=FAMILIES) -> DataFrame:
    """3.2: load model, feature list and lookups, build the scoring
    features, guard missing columns, predict, floor at 0, write, summarise."""
    spark = clicks.sparkSession
    model = M.EnsembleModel.load(spark, f"{model_dir}/model")
    feats = sinks.read_feature_list(spark, f"{model_dir}/selected_features")
    rates = RateModel.read(spark, f"{model_dir}/rates")
    ft = build_features(clicks, families, rates)
    require_features(ft, feats)
    sub = sinks.create_submission(model.transform(ft), out_path)
    return E.prediction_summary(sub)


def temporal_validation_flow(clicks: DataFrame, split_date: str = DEFAULT_SPLIT_DATE,
                             n_train: int | None = None, n_val: int | None = None, selection: dict | None = None
                             ) -> DataFrame:
    """3.3: lookups fitted on train, research features, selection, shallow
    forest, and the validation / train RMSE gate (E7).  With ``n_train`` /
    ``n_val`` on the first sessions of each split only (K3 + J3)."""
    train_c, val_c = temporal_split(clicks, split_date)
    train_s = train_c if n_train is None else sample_sessions(train_c, n_train)
    val_s = val_c if n_val is None else sample_sessions(val_c, n_val)
    rates = fit_rates(train_s)
    tr = stage(build_features(train_s, ["research"], rates), "tv_train")
    va = stage(build_features(val_s, ["research"], rates), "tv_val")
    sel = S.feature_selection(tr, **(selection or VALIDATION_SELECTION))
    m = M.fit_model(tr, sel.features, M.VALIDATION_FOREST, "forest")
    pick = [F.col(TARGET).alias("actual"), F.col("prediction").alias("predicted")]
    return E.overfit_check(m.transform(tr).select(*pick), m.transform(va).select(*pick))


def full_training_table(clicks: DataFrame, families=FAMILIES, split_date: str = DEFAULT_SPLIT_DATE
                        ) -> tuple[DataFrame, RateModel]:
    """The feature tables of train and validation under one another.
    Lookups are fitted on train and applied to both, and a session that crosses
    the split date stays two rows, as in the tables the models were chosen on."""
    train_c, val_c = temporal_split(clicks, split_date)
    rates = fit_rates(train_c, with_page_values="page_value" in families)
    return build_features(train_c, families, rates).unionByName(build_features(val_c, families, rates)), rates


def full_data_flow(clicks: DataFrame, out_dir: str, feature_list_path: str | None = None,
                   families=FAMILIES, config: dict | None = None,
                   ensemble_folds: int = CV.DEFAULT_FOLDS, split_date: str = DEFAULT_SPLIT_DATE) -> M.EnsembleModel:
    """Train + validation together (U1); reuse a saved feature list
    or reselect (never selecting ``user_id``); fit and persist."""
    spark = clicks.sparkSession
    table, rates = full_training_table(clicks, families, split_date)
    ft = stage(table, "full_features")
    if feature_list_path:
        feats = sinks.read_feature_list(spark, feature_list_path)
        require_features(ft, feats)
    else:
        feats = S.feature_selection(ft).features
    model = M.fit_ensemble(ft, feats, config, k=ensemble_folds)
    model.write(f"{out_dir}/model")
    rates.write(f"{out_dir}/rates")
    sinks.write_feature_list(spark, feats, f"{out_dir}/selected_features")
    return model


@dataclass
class ConservativeModel:
    """Forest and ridge on a few features, blended and clipped."""
    features: list[str]
    forest: M.FittedModel
    ridge: RidgeModel

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        scored = self.forest.transform(df)
        wf, wr = M.CONSERVATIVE_WEIGHTS
        blend = F.lit(wf) * F.col(self.forest.pred_col) + F.lit(wr) * self.ridge.expression()
        return scored.withColumn(out, clip(blend, *M.CONSERVATIVE_CLIP)).drop(self.forest.pred_col)


def fit_conservative(features: DataFrame, feature_list: list[str] | None = None, top: int = 8) -> ConservativeModel:
    """M12 on a feature table: the given list, or the ``top`` features (K1)."""
    feats = feature_list or S.top_k_by_correlation(features, top)
    require_features(features, feats)
    return ConservativeModel(feats, M.fit_model(features, feats, M.CONSERVATIVE_FOREST, "forest", pred="_forest"),
                             fit_ridge_moments(features, feats, M.CONSERVATIVE_RIDGE_ALPHA))


def conservative_flow(clicks: DataFrame, test_clicks: DataFrame, out_dir: str, feature_list: list[str] | None = None,
                      split_date: str = DEFAULT_SPLIT_DATE) -> DataFrame:
    """M12 on the research family.  With a feature list (the reference's fixed
    eight: ``models.CONSERVATIVE_FEATURES``) the model is fitted on train and
    evaluated on validation; without one it takes the eight best features of
    train + validation (U1) and is fitted on both.  Either way the test
    sessions are scored to ``submission``; returns the validation metrics,
    which for the second form are of rows the model has seen."""
    spark = clicks.sparkSession
    train_c, val_c = temporal_split(clicks, split_date)
    rates = fit_rates(train_c)
    tr = stage(build_features(train_c, ["research"], rates), "conservative_train")
    va = stage(build_features(val_c, ["research"], rates), "conservative_val")
    model = fit_conservative(tr, feature_list) if feature_list else fit_conservative(stage(tr.unionByName(va), "conservative_full"))
    sinks.write_feature_list(spark, model.features, f"{out_dir}/selected_features")
    sinks.create_submission(model.transform(build_features(test_clicks, ["research"], rates)), f"{out_dir}/submission")
    scored = _scored(model, va)
    _report(scored, out_dir, "conservative")
    return E.regression_metrics(scored)


def score_feature_table(spark, features_path: str, model_dir: str, out_path: str,
                        fmt: str = "parquet") -> DataFrame:
    """S6 + S9: score an already built feature table (parquet, or CSV with a
    header and inferred-free numeric columns), guard missing features, floor
    predictions at 0, write the submission and return its summary."""
    model = M.EnsembleModel.load(spark, f"{model_dir}/model")
    feats = sinks.read_feature_list(spark, f"{model_dir}/selected_features")
    if fmt == "csv":
        ft = spark.read.option("header", True).csv(features_path)
        ft = ft.select(*[F.col(c).cast("double").alias(c) if c in feats else F.col(c) for c in ft.columns])
    else:
        ft = spark.read.parquet(features_path)
    require_features(ft, feats)
    sub = sinks.create_submission(model.transform(ft), out_path)
    return E.prediction_summary(sub)
