"""Queries over splitting, cleaning, rates, sampling, scaling and outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionlab.functions.exprs import round_doubles
from sessionlab.functions.ranking import global_row_index
from sessionlab.operators import prepare as P
from sessionlab.operators import rates as R
from sessionlab.operators.features import FAMILIES
from sessionlab.plans import oracle as O
from sessionlab.plans.catalog import _splits, _ws, both_splits, register
from sessionlab.sources.adapter import load_clicks

SAMPLE_SESSIONS = 1000
BASE = ["base"]
BASE_COLS = [n for n, _ in O.feature_exprs(BASE)]
ALL_COLS = [n for n, _ in O.feature_exprs(FAMILIES)]


# ------------------------------------------------------------ P1 / P2 / A9 / A14

@register("temporal_split_counts", O.compose(O.head_ctes(False), """
select split, count(*) as events, count(distinct user_session) as sessions,
       min(event_time) as first_time, max(event_time) as last_time
from (select *, case when cast(event_time as date) < date '""" + O.SPLIT_DATE + """'
                     then 'train' else 'validation' end as split
      from clicks where event_time is not null) s
group by split"""))
def q_split_counts(spark, sf_dir):
    _, train, val = _splits(spark, sf_dir)
    u = train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("validation")))
    return u.groupBy("split").agg(F.count(F.lit(1)).alias("events"),
                                  F.count_distinct("user_session").alias("sessions"),
                                  F.min("event_time").alias("first_time"),
                                  F.max("event_time").alias("last_time"))


# ------------------------------------------------------------ P3 / P4

# Fixed rule of the query: every tenth event twice, and some values missing.
_MISSING = {"product_id": 7, "category_id": 9, "user_id": 13, "session_value": 11}

@register("clean_clicks", O.compose(O.head_ctes(False) + [
    "raw_ as (select event_id, event_time, user_session, event_type, " + ", ".join(
        f"case when event_id % {m} <> 0 then {c} end as {c}" for c, m in _MISSING.items()) + " from clicks)",
    "dup_ as (select * from raw_ union all select * from raw_ where event_id % 10 = 0)",
    "dd_ as (select distinct * from dup_)",
    "med_ as (select quantile_cont(session_value, 0.5) as m from dd_)"], """
select event_id, event_time, coalesce(user_id, 'UNKNOWN') as user_id, user_session, event_type,
       coalesce(product_id, 'UNKNOWN') as product_id, coalesce(category_id, 'UNKNOWN') as category_id,
       coalesce(session_value, (select m from med_)) as session_value
from dd_"""))
def q_clean(spark, sf_dir):
    """P3 + P4 on a log with repeated rows and missing values."""
    clicks = load_clicks(spark, sf_dir)
    raw = clicks.withColumns({c: F.when(F.col("event_id") % m != 0, F.col(c)) for c, m in _MISSING.items()})
    return P.clean_clicks(raw.unionByName(raw.where("event_id % 10 = 0")))


# ------------------------------------------------------------ P5

@register("event_calendar", O.compose(O.head_ctes(False), """
select *, cast(hour(event_time) as integer) as hour,
       cast(isodow(event_time) - 1 as integer) as day_of_week,
       isodow(event_time) - 1 in (5, 6) as is_weekend,
       cast(month(event_time) as integer) as month, cast(dayofmonth(event_time) as integer) as day
from clicks"""))
def q_calendar(spark, sf_dir):
    return P.event_calendar(load_clicks(spark, sf_dir))


# ------------------------------------------------------------ A1-A4

@register("category_rates", O.compose(O.head_ctes(True), f"""
select category_id, {O.rnd('buy_rate')} as buy_rate, {O.rnd('engagement')} as engagement from crate_"""))
def q_category_rates(spark, sf_dir):
    _, train, _ = _splits(spark, sf_dir)
    return round_doubles(R.category_rates(train))


@register("product_rates", O.compose(O.head_ctes(True), f"""
select product_id, {O.rnd('buy_rate')} as buy_rate from prate_"""))
def q_product_rates(spark, sf_dir):
    _, train, _ = _splits(spark, sf_dir)
    return round_doubles(R.product_rates(train))


@register("rate_thresholds", O.compose(O.head_ctes(True), f"""
select {O.rnd('p75')} as p75, {O.rnd('p90')} as p90 from thr_"""))
def q_thresholds(spark, sf_dir):
    _, train, _ = _splits(spark, sf_dir)
    cr = R.category_rates(train)
    hi, uhi = R.rate_thresholds(cr)
    one = cr.agg(F.count(F.lit(1)).alias("_n"))
    return round_doubles(one.select(F.lit(hi).cast("double").alias("p75"), F.lit(uhi).cast("double").alias("p90")))


# ------------------------------------------------------------ K3 / J3

@register("sample_sessions", O.compose(O.head_ctes(False) + [f"""
first_ as (
  select user_session from clicks where user_session is not null group by user_session
  order by min(struct_pack(t := event_time, i := event_id)), user_session limit {SAMPLE_SESSIONS})"""],
    "select * from clicks where user_session in (select user_session from first_)"))
def q_sample(spark, sf_dir):
    return P.sample_sessions(load_clicks(spark, sf_dir), SAMPLE_SESSIONS)


# ------------------------------------------------------------ P6 / P7 / P9

def _base_tables(spark, sf_dir):
    ws = _ws(spark, sf_dir)
    return ws.features("train", BASE), ws.features("val", BASE)


def _scale_sql(method: str) -> str:
    ctes = O.head_ctes(True) + O.feature_ctes("tr_", FAMILIES, O.TRAIN_COND, px="a", rounded=False) \
        + O.feature_ctes("va_", FAMILIES, O.VAL_COND, px="b", rounded=False)
    stats, cols = [], []
    for c in ALL_COLS:
        if method == "robust":
            stats += [f"quantile_cont({c}, 0.5) as m_{c}",
                      f"quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) as s_{c}"]
        else:
            stats += [f"avg({c}) as m_{c}", f"stddev_pop({c}) as s_{c}"]
        cols.append(f"{O.rnd(f'(cast({c} as double) - m_{c}) / (case when s_{c} = 0 then 1.0 else s_{c} end)')}"
                    f" as {c}")
    ctes.append("st_ as (select " + ", ".join(stats) + " from tr_)")
    return O.compose(ctes, " union all ".join(
        f"select '{name}' as split, user_session, " + ", ".join(cols) + f" from {t}, st_"
        for name, t in (("train", "tr_"), ("validation", "va_"))))


def _scaled(spark, sf_dir, method: str):
    """All features, fitted on train, applied to both splits."""
    ws = _ws(spark, sf_dir)
    model = P.fit_scaler(ws.features("train"), ALL_COLS, method)
    return round_doubles(both_splits(lambda s: model.transform(ws.features(s)).select("user_session", *ALL_COLS)))


@register("robust_scale", _scale_sql("robust"))
def q_robust(spark, sf_dir):
    return _scaled(spark, sf_dir, "robust")


@register("standard_scale", _scale_sql("standard"))
def q_standard(spark, sf_dir):
    return _scaled(spark, sf_dir, "standard")


@register("iqr_outliers", O.compose(
    O.head_ctes(False) + O.feature_ctes("tr_", BASE, O.TRAIN_COND, with_rates=False, rounded=False) + [
        "q_ as (select quantile_cont(session_value, 0.25) as q1, quantile_cont(session_value, 0.75) as q3 from tr_)"],
    "select user_session, session_value from tr_, q_ "
    "where session_value between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)"))
def q_iqr(spark, sf_dir):
    tr, _ = _base_tables(spark, sf_dir)
    return P.remove_outliers(tr).select("user_session", "session_value")



# ------------------------------------------------------------ A6 / K3

@register("page_values", O.compose(O.head_ctes(True), f"""
select category_id, {O.rnd('page_value')} as page_value from pval_"""))
def q_page_values(spark, sf_dir):
    return round_doubles(_ws(spark, sf_dir).rates(with_page_values=True).lookups.page_values)


@register("first_sessions", O.compose(O.head_ctes(False), f"""
select user_session, cast(row_number() over (order by min(struct_pack(t := event_time, i := event_id)),
       user_session) as integer) as start_rank
from clicks where user_session is not null group by user_session
qualify start_rank <= {SAMPLE_SESSIONS}"""))
def q_first_sessions(spark, sf_dir):
    top = P.first_session_starts(_ws(spark, sf_dir).clicks, SAMPLE_SESSIONS)
    return global_row_index(top, ["start", "user_session"]).select(
        "user_session", (F.col("row_index") + 1).cast("int").alias("start_rank"))


# ------------------------------------------------------------ J1 / P13 join path

MERGED = ["base", "behavioral", "temporal"]


@register("merged_families", O.both_splits_sql(MERGED, with_rates=False))
def q_merged(spark, sf_dir):
    """Families built separately (as from a cache) and merged on user_session;
    equals the one-pass table of the same families."""
    from sessionlab.operators.features import build_features, merge_feature_tables
    ws = _ws(spark, sf_dir)
    return round_doubles(both_splits(lambda s: merge_feature_tables([build_features(ws.split(s), [f]) for f in MERGED])))
