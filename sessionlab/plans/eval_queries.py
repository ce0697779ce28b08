"""Queries over profiles, correlation / selection, metrics, blends, folds.

Metric queries score a fixed, fit-free prediction expression so the SQL
oracle can reproduce them exactly; the model queries (model_queries.py)
use the same operators on fitted predictions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionlab.functions.exprs import round_doubles
from sessionlab.operators import evaluate as E
from sessionlab.operators import folds as CV
from sessionlab.operators import prepare as P
from sessionlab.operators import select as S
from sessionlab.operators import validate as V
from sessionlab.operators.features import FAMILIES
from sessionlab.plans import oracle as O
from sessionlab.plans.catalog import _splits, _ws, both_splits, register

ALL_COLS = [n for n, _ in O.feature_exprs(FAMILIES)]
BASE_COLS = [n for n, _ in O.feature_exprs(["base"])]
TOP_K = 8

# Fixed prediction expressions used to check metrics, blends and sinks.
PREDICTIONS = {
    "fixed_a": "12.5 + 3 * buy_count + 0.5 * total_events",
    "fixed_b": "20.0 + 2 * unique_products",
    "fixed_c": "5.0 + 1.5 * total_events",
    "fixed_d": "30.0 - 2 * view_count + 4 * addcart_count",
    "signed": "12.5 + 3 * buy_count + 0.5 * total_events - 4 * view_count",
}
BLEND_WEIGHTS = {"fixed_a": 0.4, "fixed_b": 0.3, "fixed_c": 0.2, "fixed_d": 0.1}


def _pred(name: str):
    return F.expr(PREDICTIONS[name]).cast("double")


def _sql_pred(name: str) -> str:
    return f"cast({PREDICTIONS[name]} as double)"


# ------------------------------------------------------------ shared tables

def _full_train(spark, sf_dir):
    """Training feature table, staged: selection reads it in several passes."""
    return _ws(spark, sf_dir).features("train")


def _full_sql_ctes():
    return O.head_ctes(True) + O.feature_ctes("ft", FAMILIES, O.TRAIN_COND, rounded=False)


def _base(spark, sf_dir, split):
    return _ws(spark, sf_dir).features(split, ["base"])


def _base_ctes():
    return (O.head_ctes(False)
            + O.feature_ctes("tr_", ["base"], O.TRAIN_COND, with_rates=False, px="a", rounded=False)
            + O.feature_ctes("va_", ["base"], O.VAL_COND, with_rates=False, px="b", rounded=False))


def _unpivot(src: str, cols: list[str], keep: str) -> str:
    casts = ", ".join(f"cast({c} as double) as {c}" for c in cols)
    return (f"(unpivot (select {keep}, {casts} from {src}) on {', '.join(cols)} "
            f"into name feature value v)")


def _positions(cols: list[str]) -> str:
    vals = ", ".join(f"('{c}', {i})" for i, c in enumerate(cols))
    return f"pos_(feature, position) as (values {vals})"


def _tc_ctes() -> list[str]:
    return _full_sql_ctes() + [
        _positions(ALL_COLS),
        f"long_ as (select * from {_unpivot('ft', ALL_COLS, 'user_session, session_value as y')})",
        """tc_ as (
  select l.feature, p.position,
         case when stddev_pop(v) * stddev_pop(y) > 0
              then covar_pop(v, y) / (stddev_pop(v) * stddev_pop(y)) end as corr
  from long_ l join pos_ p using (feature) group by l.feature, p.position)"""]


# ------------------------------------------------------------ A8 / E9

_PROFILED = ["user_session", "user_id", *ALL_COLS, "session_value"]
# Fixed rule of the two queries: where a value is missing.
_HOLES = {"user_id": "total_events = 2", "max_time_gap": "total_events = 1", "events_per_minute": "total_events <= 3",
          "hour": "day_of_week = 6", "buy_ratio": "buy_count > 1"}


def _holes_sql(src: str, cols: list[str]) -> str:
    return "(select " + ", ".join(f"case when not ({_HOLES[c]}) then {c} end as {c}" if c in _HOLES else c for c in cols) + f" from {src})"


def _with_holes(df):
    return df.withColumns({c: F.when(~F.expr(cond), F.col(c)) for c, cond in _HOLES.items() if c in df.columns})


@register("null_profile", O.compose(
    O.head_ctes(True) + O.feature_ctes("tr_", FAMILIES, O.TRAIN_COND, px="a") + O.feature_ctes("va_", FAMILIES, O.VAL_COND, px="b") + [
        *[f"n{t} as (select " + ", ".join(f"count(*) filter (where {c} is null) as {c}" for c in _PROFILED)
          + f" from {_holes_sql(t, _PROFILED)} x)" for t in ("tr_", "va_")],
        _positions(_PROFILED).replace("feature", "col")], " union all ".join(
        f"select '{name}' as split, col as \"column\", position, null_count from "
        f"(unpivot (select * from n{t}) on columns(*) into name col value null_count) u join pos_ using (col)"
        for name, t in (("train", "tr_"), ("validation", "va_")))))
def q_null_profile(spark, sf_dir):
    """A8 on both feature tables, with values missing by rule."""
    ws = _ws(spark, sf_dir)
    return both_splits(lambda s: V.null_profile(_with_holes(ws.features(s)), _PROFILED)).withColumn(
        "position", F.col("position").cast("int"))


# How the test side of the query differs from the train side.
_LOST, _RETYPED = "view_count", "buy_count"


@register("validate_features", O.compose(_base_ctes() + [
    "nr_ as (select " + ", ".join(f"avg(case when {c} is null then 1.0 else 0.0 end) as {c}"
                                  for c in BASE_COLS if c != _LOST) + f" from {_holes_sql('va_', BASE_COLS)} x)"],
    f"""select feature, true as in_test, feature <> '{_RETYPED}' as dtype_match, {O.rnd('rate')} as test_null_rate,
       rate <= 0.5 and feature <> '{_RETYPED}' as ok
from (unpivot (select * from nr_) on columns(*) into name feature value rate) u
union all select '{_LOST}', false, false, null, false"""))
def q_validate(spark, sf_dir):
    """E9 with a feature that the test side lacks, one of another type, one
    that is mostly missing and one that is missing at times."""
    tr, va = _base(spark, sf_dir, "train"), _with_holes(_base(spark, sf_dir, "val"))
    va = va.drop(_LOST).withColumn(_RETYPED, F.col(_RETYPED).cast("double"))
    return round_doubles(V.validate_features(tr, va, BASE_COLS))


# ------------------------------------------------------------ A11 / A12 / FS / K1

@register("target_correlation", O.compose(_tc_ctes(), f"""
select feature, position, {O.rnd('corr')} as corr, {O.rnd('abs(corr)')} as abs_corr from tc_"""))
def q_target_corr(spark, sf_dir):
    return round_doubles(S.correlation_table(_full_train(spark, sf_dir)))


def _strong_pairs_ctes() -> list[str]:
    return _tc_ctes() + [
        f"strong_ as (select feature, position, round(abs(corr) * 1e{S.TIE_DECIMALS}) / 1e{S.TIE_DECIMALS} as ac "
        f"from tc_ "
        f"where abs(corr) >= {S.CORRELATION_THRESHOLD})",
        """pairs_ as (
  select a.feature as feature_a, b.feature as feature_b, corr(a.v, b.v) as corr
  from long_ a join long_ b on a.user_session = b.user_session
  join strong_ sa on sa.feature = a.feature join strong_ sb on sb.feature = b.feature
  where sa.position < sb.position group by a.feature, b.feature)""",
        f"hi_ as (select * from pairs_ where abs(corr) > {S.REMOVE_CORRELATED_THRESHOLD})"]


@register("correlated_pairs", O.compose(_strong_pairs_ctes(), f"""
select feature_a, feature_b, {O.rnd('corr')} as corr from hi_"""))
def q_pairs(spark, sf_dir):
    ft = _full_train(spark, sf_dir)
    corrs = S.target_correlations(ft)
    strong = [c for c, v in corrs if v is not None and abs(v) >= S.CORRELATION_THRESHOLD]
    rows = S.correlated_pairs(ft, strong)
    return round_doubles(ft.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, corr double"))


@register("selected_features", O.compose(_strong_pairs_ctes() + [
    """removed_ as (
  select case when sa.ac < sb.ac then h.feature_a else h.feature_b end as feature
  from hi_ h join strong_ sa on sa.feature = h.feature_a join strong_ sb on sb.feature = h.feature_b)""",
    f"""kept_ as (
  select * from strong_
  where (select count(*) from strong_) <= {S.MAX_FEATURES}
     or feature not in (select feature from removed_))""",
    f"""ranked_ as (
  select feature, position,
         case when (select count(*) from kept_) > {S.MAX_FEATURES}
              then row_number() over (order by ac desc, position)
              else row_number() over (order by position) end as selection_rank
  from kept_)"""], f"""
select feature, cast(selection_rank as integer) as selection_rank from ranked_
where selection_rank <= {S.MAX_FEATURES}"""))
def q_selected(spark, sf_dir):
    sel = S.feature_selection(_full_train(spark, sf_dir))
    rows = [(f, i + 1) for i, f in enumerate(sel.features)]
    return spark.createDataFrame(rows, "feature string, selection_rank int")


@register("top_correlated_features", O.compose(_tc_ctes(), f"""
select feature, cast(row_number() over (order by round(abs(corr) * 1e{S.TIE_DECIMALS}) desc, position)
       as integer) as rank
from tc_ where corr is not null qualify rank <= {TOP_K}"""))
def q_topk(spark, sf_dir):
    top = S.top_k_by_correlation(_full_train(spark, sf_dir), TOP_K)
    return spark.createDataFrame([(f, i + 1) for i, f in enumerate(top)], "feature string, rank int")


# ------------------------------------------------------------ E1-E7 / A10

def _metrics_sql(src: str, pred: str, name: str | None = None) -> str:
    e = f"(session_value - {pred})"
    nm = f"'{name}' as model_name, " if name else ""
    return f"""select {nm}{O.rnd(f'avg({e} * {e})')} as mse, {O.rnd(f'sqrt(avg({e} * {e}))')} as rmse,
       {O.rnd(f'avg(abs({e}))')} as mae,
       {O.rnd(f'case when var_pop(session_value) > 0 then 1.0 - avg({e} * {e}) / var_pop(session_value) when avg({e} * {e}) = 0 then 1.0 else 0.0 end')} as r2,
       {O.rnd(f'avg(abs({e}) / greatest(session_value, 1e-8)) * 100.0')} as mape,
       {O.rnd(f'max(abs({e}))')} as max_error, {O.rnd(f'avg({e})')} as mean_residual,
       {O.rnd(f'stddev_pop({e})')} as std_residual from {src}"""


def _scored(spark, sf_dir, split="val", name="fixed_a"):
    return _base(spark, sf_dir, split).select(
        "user_session", F.col("session_value").alias("actual"), _pred(name).alias("predicted"))


@register("regression_metrics", O.compose(_base_ctes(), _metrics_sql("va_", _sql_pred("fixed_a"), "fixed_a")))
def q_metrics(spark, sf_dir):
    return round_doubles(E.regression_metrics(_scored(spark, sf_dir), model_name="fixed_a"))


@register("evaluation_report", O.compose(_base_ctes() + [
    f"m_ as ({_metrics_sql('va_', _sql_pred('fixed_a'), 'fixed_a')})"], f"""
select *, case when abs(mean_residual) < 1.0 then 'Low' else 'High' end as bias,
       case when std_residual < 20.0 then 'Low' else 'High' end as variance,
       case when rmse < 25.0 then 'Good' else 'Needs Improvement' end as overall,
       rmse > 30.0 as advise_features, abs(mean_residual) > 2.0 as advise_bias,
       r2 < 0.5 as advise_underfit from m_"""))
def q_report(spark, sf_dir):
    m = round_doubles(E.regression_metrics(_scored(spark, sf_dir), model_name="fixed_a"))
    return E.evaluation_report(m)


@register("compare_models", O.compose(_base_ctes(), "select * from (" + " union all ".join(
    f"({_metrics_sql('va_', _sql_pred(n), n)})" for n in BLEND_WEIGHTS) + ") order by rmse, model_name"))
def q_compare(spark, sf_dir):
    res = {n: round_doubles(E.regression_metrics(_scored(spark, sf_dir, "val", n))) for n in BLEND_WEIGHTS}
    return E.compare_models(res)


@register("error_analysis", O.compose(_base_ctes() + [
    f"s_ as (select session_value as y, {_sql_pred('fixed_a')} as p from va_)"], f"""
select {O.rnd('avg(y - p)')} as mean_error, {O.rnd('stddev_pop(y - p)')} as std_error,
       {O.rnd('max(abs(y - p))')} as max_error, {O.rnd('quantile_cont(abs(y - p), 0.95)')} as q95_error,
       {O.rnd('avg(case when p > y then 1.0 else 0.0 end)')} as overestimate_rate,
       {O.rnd('avg(case when abs(y - p) > 50 then 1.0 else 0.0 end)')} as large_error_rate,
       {O.rnd('max(p) - min(p)')} as prediction_range, {O.rnd('max(y) - min(y)')} as target_range
from s_"""))
def q_errors(spark, sf_dir):
    return round_doubles(E.error_analysis(_scored(spark, sf_dir)))


@register("overfit_check", O.compose(_base_ctes() + [
    f"r_ as (select (select sqrt(avg(pow(session_value - {_sql_pred('fixed_a')}, 2))) from tr_) as train_rmse, "
    f"(select sqrt(avg(pow(session_value - {_sql_pred('fixed_a')}, 2))) from va_) as val_rmse)"], f"""
select {O.rnd('train_rmse')} as train_rmse, {O.rnd('val_rmse')} as val_rmse,
       {O.rnd('val_rmse / train_rmse')} as ratio, val_rmse / train_rmse < 2.0 as passed from r_"""))
def q_overfit(spark, sf_dir):
    return round_doubles(E.overfit_check(_scored(spark, sf_dir, "train"), _scored(spark, sf_dir, "val")))


# ------------------------------------------------------------ S9 / P11 / P12 / M8 / M14 / A7 / A10

@register("prediction_summary", O.compose(_base_ctes() + [
    f"p_ as (select greatest({_sql_pred('signed')}, 0.0) as p from va_)"], f"""
select {O.rnd('avg(p)')} as mean, {O.rnd('quantile_cont(p, 0.5)')} as median, {O.rnd('min(p)')} as min,
       {O.rnd('max(p)')} as max, {O.rnd('stddev_pop(p)')} as std from p_"""))
def q_pred_summary(spark, sf_dir):
    va = _base(spark, sf_dir, "val")
    sub = va.select(P.clip(_pred("signed"), lo=0.0).alias("session_value"))
    return round_doubles(E.prediction_summary(sub))


@register("clipped_blend", O.compose(_base_ctes(), f"""
select user_session,
       {O.rnd(f'least(greatest(0.6 * {_sql_pred("fixed_a")} + 0.4 * {_sql_pred("fixed_b")}, 5.0), 300.0)')}
         as session_value from va_"""))
def q_clipped(spark, sf_dir):
    va = _base(spark, sf_dir, "val")
    blend = F.lit(0.6) * _pred("fixed_a") + F.lit(0.4) * _pred("fixed_b")
    return round_doubles(va.select("user_session", P.clip(blend, 5.0, 300.0).alias("session_value")))


@register("weighted_blend", O.compose(_base_ctes(), "select user_session, " + O.rnd(" + ".join(
    f"{w} * {_sql_pred(n)}" for n, w in BLEND_WEIGHTS.items())) + " as session_value from va_"))
def q_weighted(spark, sf_dir):
    from sessionlab.operators.models import blend_predictions
    va = _base(spark, sf_dir, "val")
    preds = va.select("user_session", *[_pred(n).alias(n) for n in BLEND_WEIGHTS])
    return round_doubles(blend_predictions(preds, BLEND_WEIGHTS).select("user_session", "session_value"))


@register("median_baseline", O.compose(_base_ctes() + [
    "m_ as (select quantile_cont(session_value, 0.5) as m from (select session_value from tr_ "
    "union all select session_value from va_) u)"],
    f"select user_session, {O.rnd('m')} as session_value from va_, m_"))
def q_median(spark, sf_dir):
    from sessionlab.operators.models import median_baseline
    tr, va = _base(spark, sf_dir, "train"), _base(spark, sf_dir, "val")
    return round_doubles(median_baseline(tr.unionByName(va), va))


# ------------------------------------------------------------ CV1 / CV2 / CV4

@register("kfold_assignment", O.compose(_base_ctes(), " union all ".join(f"""
select '{name}' as split, user_session, cast(cast(concat('0x', substr(md5(user_session), 1, 8)) as bigint) % {CV.DEFAULT_FOLDS}
       as integer) as fold from {t}""" for name, t in (("train", "tr_"), ("validation", "va_")))))
def q_kfold(spark, sf_dir):
    return both_splits(lambda s: CV.kfold_assign(_base(spark, sf_dir, s)).select("user_session", "fold"))


def _indexed_sql() -> list[str]:
    return _base_ctes() + [
        """starts_ as (select user_session, min(struct_pack(t := event_time, i := event_id)) as start
  from train_clicks where user_session is not null group by user_session)""",
        """ix_ as (select tr_.user_session, row_number() over (order by s.start, tr_.user_session) - 1 as row_index
  from tr_ join starts_ s using (user_session))""",
        "n_ as (select count(*) as n, count(*) // 6 as sz from ix_)"]


@register("temporal_folds", O.compose(_indexed_sql(), f"""
select user_session, row_index,
       cast(case when row_index >= n - {CV.DEFAULT_FOLDS} * sz and row_index < n - {CV.DEFAULT_FOLDS} * sz
                      + {CV.DEFAULT_FOLDS} * sz
                 then (row_index - (n - {CV.DEFAULT_FOLDS} * sz)) // sz else -1 end as integer) as test_fold
from ix_, n_"""))
def q_temporal_folds(spark, sf_dir):
    clicks, train, _ = _splits(spark, sf_dir)
    ix = CV.ordered_sessions(_base(spark, sf_dir, "train").select("user_session"), train)
    return CV.temporal_folds(ix).select("user_session", "row_index", "test_fold")


@register("holdout_split", O.compose(_indexed_sql(), """
select user_session, row_index, row_index >= cast(floor(n * 0.8) as bigint) as is_holdout from ix_, n_"""))
def q_holdout(spark, sf_dir):
    _, train, _ = _splits(spark, sf_dir)
    ix = CV.ordered_sessions(_base(spark, sf_dir, "train").select("user_session"), train)
    return CV.holdout_split(ix).select("user_session", "row_index", "is_holdout")


@register("evaluation_history", O.compose(_base_ctes() + [
    f"h_ as ({_metrics_sql('tr_', _sql_pred('fixed_a'), 'train')} union all "
    f"{_metrics_sql('va_', _sql_pred('fixed_a'), 'validation')})"],
    "select model_name, metric, value from (unpivot h_ on " + ", ".join(E.METRICS)
    + " into name metric value value)"))
def q_history(spark, sf_dir):
    hist = E.EvaluationHistory()
    hist.evaluate(_scored(spark, sf_dir, "train"), "train")
    hist.evaluate(_scored(spark, sf_dir, "val"), "validation")
    t = hist.table()
    return t.select("model_name", "metric",
                    (F.round(F.col("value") * F.lit(1e6), 0) / F.lit(1e6)).alias("value"))
