"""The feature families as projections over the session statistics.

Each family is a list of named ``Column`` expressions over the table built by
``operators.sessions.session_stats``; building several families is one
projection of one statistics table, not one pass per family.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlab.functions.exprs import between_flag, flag, in_flag, ratio, safe_ratio
from sessionlab.operators.rates import RateModel
from sessionlab.operators.sessions import Lookups, session_stats
from sessionlab.schema import ADD_CART, BUY, CLICK_SCHEMA_NO_TARGET, REMOVE_CART, SESSION, TARGET, VIEW

# Fixed values of the feature rules.
EVENTS_PER_MINUTE_FLOOR = 0.01
PEAK_HOURS = (10, 11, 12, 15)
PAYDAYS = (15, 30, 31)
SUMMER_MONTHS = (6, 7, 8)
WINTER_MONTHS = (12, 1, 2)


def _n():
    return F.col("n")


def _duration_seconds() -> Column:
    return F.when(_n() > 1, F.col("span_s")).otherwise(F.lit(0.0))


def _duration_minutes() -> Column:
    return _duration_seconds() / F.lit(60.0)


def _max_gap() -> Column:
    return F.when(_n() > 1, F.col("gap_max")).otherwise(F.lit(0.0))


def _std_gap() -> Column:
    return F.when(_n() > 2, F.coalesce(F.col("gap_std"), F.lit(0.0))).otherwise(F.lit(0.0))


def _last_is(v):
    return flag(F.col("last_type") == F.lit(v))


def _first_is(v):
    return flag(F.col("first_type") == F.lit(v))


def base_columns() -> list[Column]:
    """B1-B19."""
    dur = _duration_minutes()
    return [
        _n().cast("long").alias("total_events"),
        F.col("up").cast("long").alias("unique_products"),
        F.col("uc").cast("long").alias("unique_categories"),
        F.col("n_buy").cast("long").alias("buy_count"),
        F.col("n_addcart").cast("long").alias("addcart_count"),
        F.col("n_view").cast("long").alias("view_count"),
        F.col("n_remove").cast("long").alias("remove_count"),
        ratio("n_buy", "n").alias("buy_ratio"),
        ratio("n_addcart", "n").alias("addcart_ratio"),
        ratio("n_view", "n").alias("view_ratio"),
        ratio("n_remove", "n").alias("remove_ratio"),
        _last_is(BUY).alias("last_event_buy"),
        _last_is(ADD_CART).alias("last_event_addcart"),
        _last_is(VIEW).alias("last_event_view"),
        _last_is(REMOVE_CART).alias("last_event_remove"),
        _first_is(VIEW).alias("first_event_view"),
        _first_is(ADD_CART).alias("first_event_addcart"),
        dur.alias("duration_minutes"),
        (_n().cast("double") / F.greatest(dur, F.lit(EVENTS_PER_MINUTE_FLOOR))).alias("events_per_minute"),
    ]


def behavioral_columns() -> list[Column]:
    """H1-H15."""
    revisits = F.col("n_product_events") - F.col("up")
    return [
        flag(F.col("n_buy") > 1).alias("has_multiple_buys"),
        _last_is(BUY).alias("has_buy_end"),
        flag(F.col("n_addcart_buy") > 0).alias("has_addcart_buy_pattern"),
        flag(F.col("n_view_buy") > 0).alias("has_view_buy_pattern"),
        F.col("n_addcart_remove").cast("long").alias("indecision_count"),
        revisits.cast("long").alias("product_revisits"),
        F.col("n_category_changes").cast("long").alias("category_changes"),
        _max_gap().alias("max_time_gap"),
        flag((_n() > 1) & (F.col("n_long_gap") > 0)).alias("has_long_pause"),
        flag((_n() > 1) & (F.col("n_quick_gap") > 0)).alias("has_quick_actions"),
        flag((F.col("up") == 1) & (_n() > 1)).alias("is_focused_shopper"),
        flag((F.col("up") >= 3) & (F.col("uc") <= 2)).alias("is_comparison_shopper"),
        flag(F.col("uc") >= 3).alias("is_explorer"),
        safe_ratio("n_buy", "n_addcart").alias("cart_conversion_rate"),
        ratio(revisits, "up", floor=1).alias("revisit_ratio"),
    ]


def research_columns(high: float | None, ultra_high: float | None) -> list[Column]:
    """R1-R29; needs the rate lookups and thresholds."""
    dur = _duration_minutes()
    max_cat = F.col("c_max")

    def above(th):
        if th is None:  # no fitted categories: pandas percentile of [] fails, flag off
            return F.lit(0).cast("long")
        return flag(max_cat > F.lit(float(th)))

    return [
        F.col("n_buy").cast("long").alias("monetary_proxy"),
        F.col("c_sum").alias("total_category_score"),
        F.when(F.col("first_buy_rn").isNotNull(),
               F.lit(1.0) - (F.col("first_buy_rn") - 1).cast("double") / _n().cast("double"))
         .otherwise(F.lit(0.0)).alias("decisiveness_score"),
        # a set of the session's categories: a missing category is one member
        flag(F.col("n_category_keys") > 2).alias("has_comparison_pattern"),
        max_cat.alias("max_category_score"),
        F.col("c_avg").alias("avg_category_score"),
        F.col("p_max").alias("max_product_score"),
        F.col("p_avg").alias("avg_product_score"),
        F.col("e_avg").alias("avg_engagement"),
        F.col("e_max").alias("max_engagement"),
        flag(_n() == 1).alias("is_bounce"),
        flag((_n() == 1) & (F.col("first_type") == F.lit(VIEW))).alias("has_immediate_exit"),
        dur.alias("session_duration_minutes"),
        _max_gap().alias("max_time_gap"),
        _std_gap().alias("std_time_between_events"),
        F.when((F.col("n_viewed_products") > 0) & (dur > 0), dur / F.col("n_viewed_products").cast("double"))
         .otherwise(F.lit(0.0)).alias("time_per_product"),
        F.col("max_pn").cast("long").alias("max_product_interactions"),
        ratio(F.col("uc") + F.col("up"), "n").alias("exploration_score"),
        ratio("uc", "up", floor=1).alias("category_diversity"),
        F.col("n_addcart_remove").cast("long").alias("decision_changes"),
        flag(F.col("n_addcart") >= 2).alias("has_multiple_addcart_sequence"),
        flag(F.col("n_view_addcart_buy") > 0).alias("has_view_addcart_buy_sequence"),
        ratio("n_addcart_buy", "n_addcart", floor=1).alias("funnel_addcart_to_buy"),
        above(high).alias("has_high_buy_rate_category"),
        above(ultra_high).alias("has_ultra_high_buy_rate_category"),
        F.col("uc").cast("long").alias("unique_categories"),
        F.col("up").cast("long").alias("unique_products"),
        _n().cast("long").alias("total_events"),
        F.col("n_buy").cast("long").alias("buy_count"),
    ]


def temporal_columns() -> list[Column]:
    """T1-T27, from the session's first event time."""
    t0 = F.col("t_first")
    hour, dow, day, month = F.hour(t0), F.weekday(t0), F.dayofmonth(t0), F.month(t0)
    span = _duration_seconds() / F.lit(3600.0)
    return [
        hour.cast("long").alias("hour"),
        dow.cast("long").alias("day_of_week"),
        day.cast("long").alias("day"),
        month.cast("long").alias("month"),
        flag(dow >= 5).alias("is_weekend"),
        flag(dow == 0).alias("is_monday"),
        flag(dow == 4).alias("is_friday"),
        flag(dow == 6).alias("is_sunday"),
        flag((hour >= 22) | (hour <= 6)).alias("is_night"),
        between_flag(hour, 7, 12).alias("is_morning"),
        between_flag(hour, 13, 18).alias("is_afternoon"),
        between_flag(hour, 19, 22).alias("is_evening"),
        between_flag(hour, 9, 17).alias("is_business_hours"),
        between_flag(hour, 11, 14).alias("is_lunch_time"),
        in_flag(hour, PEAK_HOURS).alias("is_peak_hour"),
        between_flag(hour, 19, 22).alias("is_prime_shopping"),
        flag(day <= 5).alias("is_month_start"),
        flag(day >= 25).alias("is_month_end"),
        between_flag(day, 13, 17).alias("is_mid_month"),
        in_flag(day, PAYDAYS).alias("is_payday"),
        in_flag(month, SUMMER_MONTHS).alias("is_summer"),
        in_flag(month, WINTER_MONTHS).alias("is_winter"),
        span.alias("session_span_hours"),
        flag((_n() > 1) & (span >= 1)).alias("crosses_hour_boundary"),
        flag((_n() > 1) & (F.to_date(t0) != F.to_date(F.col("t_last")))).alias("crosses_day_boundary"),
        flag(span < 0.1).alias("is_quick_session"),
        flag(span > 2).alias("is_extended_session"),
    ]


def page_value_columns() -> list[Column]:
    """V1-V5, the older page-value family."""
    secs = _duration_seconds()
    dur = secs / F.lit(60.0)
    return [
        dur.alias("session_duration_minutes"),
        secs.alias("session_duration_seconds"),
        # mean of consecutive gaps telescopes to (last - first) / (n - 1): exact
        F.when(_n() > 1, secs / (_n() - 1).cast("double")).otherwise(F.lit(0.0)).alias("avg_time_between_events"),
        _std_gap().alias("std_time_between_events"),
        _max_gap().alias("max_time_gap"),
        (_n().cast("double") / F.greatest(dur, F.lit(EVENTS_PER_MINUTE_FLOOR))).alias("event_intensity"),
        F.col("pv_sum").alias("total_page_value"),
        F.col("pv_max").alias("max_page_value"),
        F.col("pv_avg").alias("avg_page_value"),
        flag(F.col("n_view_addcart_buy") > 0).alias("has_view_addcart_buy_sequence"),
        flag(F.col("n_addcart") >= 2).alias("has_multiple_addcart_sequence"),
        # a set of the session's categories: a missing category is one member
        flag(F.col("n_category_keys") > 2).alias("has_comparison_pattern"),
        ratio("n_addcart_buy", "n_addcart", floor=1).alias("funnel_addcart_to_buy"),
    ]


FAMILIES = ("base", "behavioral", "research", "temporal")


def family_columns(name: str, rates: RateModel | None = None) -> list[Column]:
    if name == "base":
        return base_columns()
    if name == "behavioral":
        return behavioral_columns()
    if name == "research":
        if rates is None:
            raise ValueError("research features need fitted rates (fit_rates on the train split)")
        return research_columns(rates.high_threshold, rates.ultra_high_threshold)
    if name == "temporal":
        return temporal_columns()
    if name == "page_value":
        if rates is None or rates.lookups.page_values is None:
            raise ValueError("page-value features need fit_rates(..., with_page_values=True)")
        return page_value_columns()
    raise ValueError(f"unknown feature family {name!r}")


def _needs(families) -> tuple[bool, bool]:
    fam = set(families)
    return bool(fam - {"temporal"}), bool(fam - {"temporal"})


def build_features(clicks: DataFrame, families=FAMILIES, rates: RateModel | None = None,
                   keep_ids: bool = True, bucket_seconds: float | None = None) -> DataFrame:
    """J1 + P13 in one pass: the listed families over one statistics table.

    Output: user_session, user_id, the features of every family in order
    with overlapping names kept from the first family that has them, then
    session_value when the log has the target.
    """
    lookups = rates.lookups if rates is not None else Lookups()
    need_p, need_c = _needs(families)
    kw = {} if bucket_seconds is None else {"bucket_seconds": bucket_seconds}
    st = session_stats(clicks, lookups, need_products=need_p, need_categories=need_c, **kw)
    cols, seen = [], set()
    if keep_ids:
        cols += [F.col(SESSION), F.col("user_id")]
        seen |= {SESSION, "user_id"}
    for fam in families:
        fcols = family_columns(fam, rates)
        for c, nm in zip(fcols, st.select(*fcols).columns):
            if nm not in seen:
                cols.append(c)
                seen.add(nm)
    if TARGET in st.columns:
        cols.append(F.col(TARGET))
    return st.select(*cols)


def merge_feature_tables(tables: list[DataFrame]) -> DataFrame:
    """J1 + P13 for separately built (e.g. cached) family tables: inner
    equi-joins on ``user_session``; a later table only contributes columns
    not already present (the first family wins, the target is kept once).
    Tables written by this library are keyed by session, so with bucketed
    or co-partitioned tables the joins need no re-shuffle."""
    out = tables[0]
    for t in tables[1:]:
        new = [c for c in t.columns if c == SESSION or c not in out.columns]
        out = out.join(t.select(*new), SESSION, "inner")
    return out


def feature_names(families=FAMILIES) -> list[str]:
    """Names of the candidate features of ``families`` in table order, as Spark
    resolves them over an empty log (no job runs)."""
    return list(_feature_names(tuple(families)))


@lru_cache
def _feature_names(families: tuple[str, ...]) -> tuple[str, ...]:
    spark = SparkSession.active()
    none = lambda schema: spark.createDataFrame([], schema)
    lookups = Lookups(none("category_id string, buy_rate double, engagement double"), none("product_id string, buy_rate double"),
                      none("category_id string, page_value double"),
                      rows={"category_rates": 0, "product_rates": 0, "page_values": 0})
    return tuple(build_features(none(CLICK_SCHEMA_NO_TARGET), families, RateModel(lookups, 0.0, 0.0), keep_ids=False).columns)
