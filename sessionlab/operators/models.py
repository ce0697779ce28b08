"""Regressors for session value on Spark ML.

M1 contract: ``fit(df) -> model``, ``model.transform(df)`` adds a prediction
column, metrics via ``operators.evaluate``, importances, ``write`` / ``load``.
M2-M4 are ``GBTRegressor`` configurations, M5/M13 ``RandomForestRegressor``,
M12 a forest + ridge blend, M14 the median baseline, M6-M11 the weighted
ensemble with hash k-fold out-of-fold predictions.  Every fit runs on the
executors; the training frame is checkpointed first (long lineage, iterative
algorithms).  Trees over few rows are grown by one task per fit
(``operators.trees``), over more by Spark ML's jobs per level, which checkpoint
to ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from itertools import groupby

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlab.functions.quantiles import exact_quantiles
from sessionlab.operators import evaluate as E
from sessionlab.operators import trees as G
from sessionlab.operators.folds import DEFAULT_FOLDS, hash_fold
from sessionlab.operators.prepare import feature_matrix
from sessionlab.schema import SESSION, TARGET
from sessionlab.session import checkpoint_dir

SEED = 42

# The reference's model configuration, mapped to Spark ML.
CONFIG = {
    "lightgbm": {"kind": "gbt", "maxIter": 500, "stepSize": 0.05, "maxDepth": 6, "minInstancesPerNode": 50,
                 "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "early_stopping": True},
    "xgboost": {"kind": "gbt", "maxIter": 500, "stepSize": 0.05, "maxDepth": 8, "minInstancesPerNode": 3,
                "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"},
    "catboost": {"kind": "gbt", "maxIter": 500, "stepSize": 0.05, "maxDepth": 8, "early_stopping": True},
    "random_forest": {"kind": "rf", "numTrees": 300, "maxDepth": 12, "minInstancesPerNode": 8,
                      "featureSubsetStrategy": "sqrt"},
}
ENSEMBLE_WEIGHTS = {"lightgbm": 0.4, "xgboost": 0.3, "catboost": 0.2, "random_forest": 0.1}
CONSERVATIVE_FOREST = {"kind": "rf", "numTrees": 50, "maxDepth": 6, "minInstancesPerNode": 25,
                       "featureSubsetStrategy": "0.5"}
CONSERVATIVE_RIDGE_ALPHA = 10.0
# The eight features of the conservative model with a fixed list.
CONSERVATIVE_FEATURES = ["monetary_proxy", "buy_count", "decisiveness_score", "unique_products", "unique_categories",
                         "total_category_score", "total_events", "has_comparison_pattern"]
CONSERVATIVE_WEIGHTS = (0.6, 0.4)
CONSERVATIVE_CLIP = (5.0, 300.0)
VALIDATION_FOREST = {"kind": "rf", "numTrees": 100, "maxDepth": 8, "minInstancesPerNode": 10,
                     "featureSubsetStrategy": "0.7"}
SMALL_FOREST = {"kind": "rf", "numTrees": 50, "maxDepth": 30, "featureSubsetStrategy": "all"}
EARLY_STOP_SHARE = 0.1       # share of a fold's training rows that choose the iteration
EARLY_STOP_PATIENCE = 100    # rounds without a better one before training ends
FIRST_ROUNDS = 200           # rounds of the fit that is tried first


# Tree training: node ids cached between levels, a larger histogram budget per
# pass (fewer passes over the data for deep or many trees).
TREE_DEFAULTS = {"cacheNodeIds": True, "maxMemoryInMB": 512, "maxBins": 256}
# A boosted round is one shallow tree: its cached node ids put every level's
# splits into the tasks of the next ones; the trees are the same without.
ROUND_DEFAULTS = {"cacheNodeIds": False}


def _regressor(spec: dict, features_col: str, label: str, pred: str) -> Estimator:
    """M1: the estimator of a member.  ``kind`` is "gbt", "rf" or "estimator":
    any regressor of ``pyspark.ml`` under "estimator", with further parameters
    by name beside it; columns and seed are set where it has them."""
    own = {k: v for k, v in spec.items() if k not in ("kind", "early_stopping", "estimator")}
    if spec["kind"] in ("gbt", "rf"):
        kind = GBTRegressor if spec["kind"] == "gbt" else RandomForestRegressor
        return kind(featuresCol=features_col, labelCol=label, predictionCol=pred, seed=SEED, checkpointInterval=10,
                    **(TREE_DEFAULTS | (ROUND_DEFAULTS if spec["kind"] == "gbt" else {}) | own))
    if spec["kind"] != "estimator":
        raise ValueError(f"unknown model kind {spec['kind']!r}")
    est = spec["estimator"].copy()
    columns = {"featuresCol": features_col, "labelCol": label, "predictionCol": pred}
    if est.hasParam("seed") and not est.isSet("seed"):
        columns["seed"] = SEED
    for name, value in (columns | own).items():
        est.set(est.getParam(name), value)
    return est


def ridge(alpha: float, label_std: float, n: int, features_col: str, label: str, pred: str) -> LinearRegression:
    """sklearn ``Ridge(alpha)`` as Spark's normal-equation solver: the
    objective matches with regParam = alpha * stddev_pop(y) / n."""
    return LinearRegression(featuresCol=features_col, labelCol=label, predictionCol=pred,
                            elasticNetParam=0.0, standardization=False, solver="normal",
                            regParam=alpha * label_std / max(n, 1))


def _prepared(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """P10 feature matrix, checkpointed: iterative fits re-read it."""
    checkpoint_dir(df.sparkSession)
    return feature_matrix(df, cols, keep=(SESSION, label)).checkpoint(eager=True)


@dataclass
class FittedModel:
    """A fitted single regressor over named feature columns."""
    name: str
    features: list[str]
    pipeline: PipelineModel
    pred_col: str = "prediction"

    def transform(self, df: DataFrame) -> DataFrame:
        fm = feature_matrix(df, self.features, keep=[c for c in df.columns if c not in self.features])
        return _scored(fm, [(self.pred_col, self)])

    def importances(self) -> list[tuple[str, float]]:
        m = self.pipeline.stages[-1]
        if not hasattr(m, "featureImportances"):
            return []
        v = m.featureImportances.toArray().tolist()
        return list(zip(self.features, v))

    def write(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        spark = self._spark()
        last = self.pipeline.stages[-1]
        spark.createDataFrame([(self.name, json.dumps(self.features), self.pred_col, f"{type(last).__module__}.{type(last).__name__}")],
                              "name string, features string, pred_col string, model_class string") \
            .write.mode("overwrite").parquet(f"{path}/meta")

    def _spark(self):
        from pyspark.sql import SparkSession
        return SparkSession.getActiveSession()

    @classmethod
    def load(cls, spark, path: str) -> "FittedModel":
        meta = spark.read.parquet(f"{path}/meta").first()
        return cls(meta["name"], json.loads(meta["features"]), PipelineModel.load(f"{path}/pipeline"),
                   meta["pred_col"])


class GrownModel(FittedModel):
    """A model whose trees were grown in a task: they score rows and rank
    features as they are, and become a Spark ML pipeline when one is asked for."""

    def __init__(self, name: str, features: list[str], assembler: VectorAssembler, grown: G.Grown, pred_col: str):
        self.name, self.features, self.pred_col = name, features, pred_col
        self.assembler, self.grown, self._pipeline = assembler, grown, None

    @property
    def pipeline(self) -> PipelineModel:
        if self._pipeline is None:
            self._pipeline = PipelineModel([self.assembler, self.grown.spark_model()])
        return self._pipeline

    def importances(self) -> list[tuple[str, float]]:
        return list(zip(self.features, self.grown.importances().tolist()))


def _scored(fm: DataFrame, models: list[tuple[str, FittedModel]]) -> DataFrame:
    """A feature matrix with a prediction column per model, under the names
    given; grown models that follow one another score in one pass."""
    for grown, some in groupby(models, lambda x: isinstance(x[1], GrownModel)):
        some = list(some)
        if grown:
            fm = G.add_scores(fm, some[0][1].features, [(name, m.grown) for name, m in some])
            continue
        for name, m in some:
            fm = m.pipeline.transform(fm).withColumnRenamed(m.pred_col, name).drop("_v")
    return fm


def fit_model(df: DataFrame, features: list[str], spec: dict, name: str = "model", label: str = TARGET,
              pred: str = "prediction", prepared: bool = False) -> FittedModel:
    """Fit one tree model (M2-M5, M13) on ``features`` -> ``label``.  With early
    stopping (M7) a hashed share of the rows chooses the number of rounds, and
    the boosted model keeps its first trees up to the best one."""
    data = df if prepared else _prepared(df, features, label)
    va = VectorAssembler(inputCols=features, outputCol="_v", handleInvalid="keep")
    stop_early = spec.get("early_stopping") and spec["kind"] == "gbt"
    held = hash_fold(SESSION, 1000) < int(EARLY_STOP_SHARE * 1000)
    kept = data.filter(~held) if stop_early else data
    if stop_early and (kept.isEmpty() or data.filter(held).isEmpty()):
        stop_early, kept = False, data
    if not stop_early:
        est = _regressor(spec, "_v", label, pred)
        if grown := G.grow(est, data, features, label):
            return GrownModel(name, features, va, grown, pred)
        return FittedModel(name, features, PipelineModel([va, est.fit(va.transform(kept))]), pred)
    train, test = va.transform(kept), va.transform(data.filter(held))
    # boosting cannot be stopped from outside: a first fit of some rounds shows
    # in most cases that patience ends within them, else all rounds are run
    for rounds in sorted({min(spec["maxIter"], FIRST_ROUNDS), spec["maxIter"]}):
        est = _regressor(dict(spec, maxIter=rounds), "_v", label, pred)
        grown = G.grow(est, data.filter(held.isNotNull()), features, label, held)
        model = None if grown else est.fit(train)
        errors = grown.errors if grown else model.evaluateEachIteration(test, "squared")
        best = best_iteration(errors)
        if len(errors) - best >= EARLY_STOP_PATIENCE:
            break
    if grown:
        return GrownModel(name, features, va, grown.prefix(best), pred)
    return FittedModel(name, features, PipelineModel([va, prefix_model(model, best)]), pred)


def prefix_model(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The boosted model after its first ``rounds`` rounds: boosting only adds
    trees, so the first trees of a long fit are those of a shorter one.  Built
    with the model's public constructor (trees, weights, number of features)."""
    java = model._java_obj
    weights = model.treeWeights[:rounds]
    jvm_trees = java.trees()
    sc = SparkSession.active().sparkContext
    trees = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    numbers = sc._gateway.new_array(sc._gateway.jvm.double, rounds)
    for i in range(rounds):
        trees[i], numbers[i] = jvm_trees[i], weights[i]
    short = sc._jvm.org.apache.spark.ml.regression.GBTRegressionModel(java.uid(), trees, numbers, model.numFeatures)
    out = GBTRegressionModel(java.copyValues(short, java.extractParamMap()))
    out._resetUid(model.uid)
    out._transfer_params_from_java()
    return out


def best_iteration(errors: list[float], patience: int = EARLY_STOP_PATIENCE) -> int:
    """M7: number of rounds up to the best one, where ``patience`` rounds
    without a better one end the search; 0 if there are no errors."""
    best = 0
    for i, e in enumerate(errors):
        if not best or e < errors[best - 1]:
            best = i + 1
        elif i + 1 - best >= patience:
            break
    return best


def fit_ridge(df: DataFrame, features: list[str], alpha: float, name: str = "ridge", label: str = TARGET,
              pred: str = "prediction", prepared: bool = False) -> FittedModel:
    data = df if prepared else _prepared(df, features, label)
    st = data.agg(F.stddev_pop(label).alias("s"), F.count(F.lit(1)).alias("n")).first()
    va = VectorAssembler(inputCols=features, outputCol="_v", handleInvalid="keep")
    lr = ridge(alpha, st["s"] or 0.0, st["n"], "_v", label, pred)
    return FittedModel(name, features, Pipeline(stages=[va, lr]).fit(data), pred)


def blend_predictions(df: DataFrame, weights: dict[str, float], out: str = TARGET) -> DataFrame:
    """M8: ``sum(w * pred_name)`` over names present in ``df``; absent names
    are skipped without renormalising the rest."""
    terms = [F.lit(float(w)) * F.col(n).cast("double") for n, w in weights.items() if n in df.columns]
    return df.withColumn(out, reduce(lambda a, b: a + b, terms) if terms else F.lit(0.0))


def median_baseline(train: DataFrame, score: DataFrame, target: str = TARGET) -> DataFrame:
    """Every scored session gets the exact median training target."""
    med = exact_quantiles(train, [target], [0.5])[target][0]
    return score.select(SESSION, F.lit(med).cast("double").alias(target))


@dataclass
class EnsembleModel:
    """Fitted members, weights, out-of-fold predictions, importance."""
    members: dict[str, FittedModel]
    weights: dict[str, float]
    features: list[str]
    oof: DataFrame | None = None
    importance: list[tuple[str, float]] = field(default_factory=list)
    pred_col: str = "prediction"
    fold_models: list = field(default_factory=list)     # (fold, member, FittedModel); not persisted

    def individual_predictions(self, df: DataFrame) -> DataFrame:
        """One prediction column per member."""
        out = feature_matrix(df, self.features, keep=[c for c in df.columns if c not in self.features])
        return _scored(out, [(m.pred_col, m) for m in self.members.values()])

    def transform(self, df: DataFrame, out: str | None = None) -> DataFrame:
        return blend_predictions(self.individual_predictions(df), self.weights, out or self.pred_col)

    def importance_table(self, spark) -> DataFrame:
        """K4: (feature, importance) ranked."""
        return spark.createDataFrame(self.importance, "feature string, importance double") \
            .orderBy(F.desc("importance"), "feature")

    def write(self, path: str) -> None:
        for name, m in self.members.items():
            m.write(f"{path}/{name}")
        spark = next(iter(self.members.values()))._spark()
        spark.createDataFrame([(json.dumps(self.weights), json.dumps(self.features), json.dumps(self.importance),
                                json.dumps(list(self.members)))],
                              "weights string, features string, imp string, members string") \
            .write.mode("overwrite").parquet(f"{path}/meta")

    @classmethod
    def load(cls, spark, path: str) -> "EnsembleModel":
        meta = spark.read.parquet(f"{path}/meta").first()
        weights = json.loads(meta["weights"])
        members = {n: FittedModel.load(spark, f"{path}/{n}") for n in json.loads(meta["members"])}
        return cls(members, weights, json.loads(meta["features"]),
                   importance=[tuple(x) for x in json.loads(meta["imp"])])


def _out_of_fold(data: DataFrame, fold_models: list, names: list[str]) -> DataFrame:
    """Each fold's rows are scored by the models that did not see the
    fold, one per member, and unpivoted to (user_session, model, fold,
    prediction).  ``data`` is a checkpointed frame: a fold reads a filter of it."""
    grown = [(f, n, m.grown) for f, n, m in fold_models if isinstance(m, GrownModel) and n in names]
    parts = [G.held_out_scores(data, "_fold", SESSION, fold_models[0][2].features, grown)] if grown else []
    fold_models = [x for x in fold_models if not isinstance(x[2], GrownModel)]
    for f in sorted({f for f, _, _ in fold_models}):
        scored = data.filter(F.col("_fold") == f)
        mine = [(n, m) for g, n, m in fold_models if g == f]
        scored = _scored(scored, [(f"_p_{n}", m) for n, m in mine])
        picks = [F.struct(F.lit(n).alias("model"), F.col(f"_p_{n}").alias("prediction")) for n, _ in mine if n in names]
        parts.append(scored.select(SESSION, F.col("_fold").alias("fold"), F.explode(F.array(*picks)).alias("o"))
                     .select(SESSION, "o.model", "fold", "o.prediction"))
    return reduce(DataFrame.unionByName, parts)


def fit_ensemble(df: DataFrame, features: list[str], config: dict | None = None,
                 weights: dict[str, float] | None = None, k: int = DEFAULT_FOLDS,
                 label: str = TARGET, parallelism: int = 16) -> EnsembleModel:
    """M6: k hash folds -> out-of-fold predictions per member, then every
    member refit on all rows; M9 weighted mean importance.  Early stopping in
    the fold fits uses a separate hashed share of the fold's training rows,
    never the fold being predicted; the final fits hold nothing out.

    Independent fits are submitted from ``parallelism`` driver threads, as
    Spark ML's ``CrossValidator(parallelism=...)`` does, so small fits share
    the cluster instead of running one after another."""
    config = config or CONFIG
    weights = weights or ENSEMBLE_WEIGHTS
    data = _prepared(df, features, label).withColumn("_fold", hash_fold(SESSION, k))

    def fold_fit(task):
        f, name, spec = task
        tr = data.filter(F.col("_fold") != f)
        return f, name, fit_model(tr, features, spec, name, label, pred="_p", prepared=True)

    def full_fit(task):
        name, spec = task                     # every row, all rounds: nothing is held out
        spec = {x: v for x, v in spec.items() if x != "early_stopping"}
        return name, fit_model(data, features, spec, name, label, pred=name, prepared=True)

    tasks = [(f, name, spec) for f in range(k) for name, spec in config.items()]
    # the longest first: fits on all rows, then those that run all rounds
    order = sorted(range(len(tasks)), key=lambda i: bool(tasks[i][2].get("early_stopping")))
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        full_fits = pool.map(full_fit, list(config.items()))
        fold_fits = dict(zip(order, pool.map(fold_fit, [tasks[i] for i in order])))
        fold_models, members = [fold_fits[i] for i in range(len(tasks))], dict(full_fits)
    oof = _out_of_fold(data, fold_models, list(config)) if fold_models else None
    imp = {c: 0.0 for c in features}
    total = 0.0
    for name, m in members.items():
        w = weights.get(name)
        if w is None:
            continue
        total += w
        for c, v in m.importances():
            imp[c] += w * v
    importance = [(c, v / total) for c, v in imp.items()] if total > 0 else []
    return EnsembleModel({n: members[n] for n in config}, weights, features, oof, importance,
                         fold_models=fold_models)


def holdout_evaluate(data: DataFrame, fit_fn, label: str = TARGET, flag: str = "is_holdout",
                     pred: str = "prediction") -> DataFrame:
    """CV4: fit on the rows before the hold-out (``folds.holdout_split``) and
    evaluate on the hold-out: n_test and the metrics of E1 and E2."""
    model = fit_fn(data.filter(~F.col(flag)))
    held = model.transform(data.filter(F.col(flag)))
    scored = held.select(F.col(label).alias("actual"), F.col(pred).alias("predicted"))
    return E.regression_metrics(scored, with_count=True)


def cross_validate(data: DataFrame, features: list[str], fit_fn, fold_col: str, k: int,
                   label: str = TARGET, temporal: bool = False, parallelism: int = 2) -> DataFrame:
    """CV3: per fold fit a fresh model (``fit_fn(train_df, features)``),
    score the fold, then mean and population std of mse / rmse / mae / r2.

    ``fold_col`` is a hash fold, or the ``test_fold`` of temporal folds; with
    ``temporal=True`` a fold trains on every row before its first row
    (``row_index``), as an expanding window."""
    data = data.checkpoint(eager=True)

    def one_fold(f: int) -> DataFrame:
        te = data.filter(F.col(fold_col) == f)
        if temporal:
            lo = te.agg(F.min("row_index")).first()[0]
            tr = data.filter(F.col("row_index") < F.lit(lo))
        else:
            tr = data.filter(F.col(fold_col) != f)
        m = fit_fn(tr, features)
        scored = m.transform(te).select(F.col(label).alias("actual"), F.col(m.pred_col).alias("predicted"))
        return E.basic_metrics(scored).withColumn("fold", F.lit(f))

    # folds are independent fits: submitted from a few driver threads
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        per_fold = list(pool.map(one_fold, range(k)))
    res = reduce(DataFrame.unionByName, per_fold)
    aggs = []
    for mname in ("mse", "rmse", "mae", "r2"):
        aggs += [F.avg(mname).alias(f"{mname}_mean"), F.stddev_pop(mname).alias(f"{mname}_std")]
    return res.agg(*aggs)
