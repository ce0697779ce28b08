"""Per-session statistics: the one shared pass behind every feature family.

The reference loops over sessions once per family and split.  Here the click
rows are exchanged once, on (session, time bucket); each bucket is reduced to
a mergeable state (counts, sums, its first two and last two events), and the
states of a session, a small table, are merged in bucket order: what happens
between two buckets follows from the states beside the edge.  No click row is
joined back, and a session that holds a third of all rows is spread over its
buckets.  Distinct products and categories go through a two-step aggregate,
(session, key) then session, so no set of keys is ever collected into one row,
and the learned rate tables are joined on the (session, key) rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.functions.exprs import is_ntz, seconds_between
from sessionlab.operators.lookup import lookup_join
from sessionlab.operators.ordered import BUCKET, DEFAULT_BUCKET_SECONDS, LRN, add_bucket, local_window
from sessionlab.schema import ADD_CART, BUY, REMOVE_CART, SESSION, TARGET, TIME, VIEW, tie_columns

# Thresholds of the timing flags, in seconds (fixed values).
LONG_PAUSE_SECONDS = 300
QUICK_ACTION_SECONDS = 10


def _is(c: str | Column, v: str):
    return (F.col(c) if isinstance(c, str) else c) == F.lit(v)


# Adjacent steps that are counted (fixed values): name -> event types in order.
STEPS = {"n_addcart_buy": (ADD_CART, BUY), "n_view_buy": (VIEW, BUY), "n_addcart_remove": (ADD_CART, REMOVE_CART),
         "n_view_addcart_buy": (VIEW, ADD_CART, BUY)}


def _step(types: tuple[str, ...], *columns) -> Column:
    e = F.lit(True)
    for c, v in zip(columns, types):
        e = e & _is(c, v)
    return e


def _changed(before, now) -> Column:
    """A missing category equals nothing (as NaN != NaN)."""
    return ~F.coalesce(before == now, F.lit(False))


def bucket_states(clicks: DataFrame, bucket_seconds: float = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """One mergeable state per (session, bucket).

    Order inside a session: event_time (nulls last), then the tie columns.
    Rows without a session are dropped, as a pandas groupby drops null keys.
    """
    clicks = add_bucket(clicks.filter(F.col(SESSION).isNotNull()), TIME, bucket_seconds)
    w = local_window(SESSION, [TIME, *tie_columns(clicks)])
    rows = clicks.withColumns({
        LRN: F.row_number().over(w), "prev_type": F.lag("event_type", 1).over(w),
        "prev2_type": F.lag("event_type", 2).over(w), "prev_cat": F.lag("category_id", 1).over(w),
        "prev_time": F.lag(TIME, 1).over(w)})
    rows = rows.withColumn("gap_s", seconds_between("prev_time", TIME, is_ntz(clicks, TIME)))
    gap, at = F.col("gap_s"), F.col(LRN)
    event = F.struct(F.col("event_type").alias("type"), F.col("category_id").alias("cat"), F.col(TIME).alias("time"))
    aggs = [
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(_is("event_type", v)).alias(c) for c, v in
          (("n_buy", BUY), ("n_addcart", ADD_CART), ("n_view", VIEW), ("n_remove", REMOVE_CART))],
        F.min(TIME).alias("t_first"), F.max(TIME).alias("t_last"),
        F.min_by(event, at).alias("first"), F.max_by(event, at).alias("last"),
        F.max(F.when(at == 2, F.col("event_type"))).alias("second_type"),
        F.max_by("prev_type", at).alias("last_but_one_type"),
        F.min_by("user_id", at).alias("user_id"),
        F.count(gap).alias("gaps"), F.avg(gap).alias("gap_mean"), F.var_pop(gap).alias("gap_var"), F.max(gap).alias("gap_max"),
        F.count_if(gap > LONG_PAUSE_SECONDS).alias("n_long_gap"), F.count_if(gap < QUICK_ACTION_SECONDS).alias("n_quick_gap"),
        *[F.count_if(_step(t, *(["prev_type", "event_type"] if len(t) == 2 else ["prev2_type", "prev_type", "event_type"])))
          .alias(c) for c, t in STEPS.items()],
        F.count_if((at > 1) & _changed(F.col("prev_cat"), F.col("category_id"))).alias("n_category_changes"),
        F.min(F.when(_is("event_type", BUY), at)).alias("first_buy"),
        F.count("product_id").alias("n_product_events"),
    ]
    if TARGET in clicks.columns:
        aggs.append(F.min_by(TARGET, at).alias(TARGET))
    return rows.groupBy(SESSION, BUCKET).agg(*aggs)


def merged_states(states: DataFrame, ntz: bool) -> DataFrame:
    """One row per session from its bucket states: sums and extremes of the
    states, and the steps, changes and gaps between neighbouring buckets."""
    w = Window.partitionBy(SESSION).orderBy(BUCKET)
    whole = Window.partitionBy(SESSION)
    before = lambda c, k=1: F.lag(c, k).over(w)
    s = states.withColumns({
        "offset": F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "edge": before("n").isNotNull(), "p": before("last"),
        "pp_type": F.when(before("n") >= 2, before("last_but_one_type")).otherwise(before(F.col("last.type"), 2))})
    s = s.withColumn("edge_gap", seconds_between("p.time", "first.time", ntz))
    gap = F.col("edge_gap")
    # mean of all gaps of the session, then squared deviations from it
    total = F.sum(F.coalesce(F.col("gap_mean") * F.col("gaps"), F.lit(0.0)) + F.coalesce(gap, F.lit(0.0))).over(whole)
    many = F.sum(F.col("gaps") + F.when(gap.isNotNull(), 1).otherwise(0)).over(whole)
    s = s.withColumns({"all_gaps": many, "mean": F.try_divide(total, many)})
    inside = F.coalesce(F.col("gaps") * (F.col("gap_var") + (F.col("gap_mean") - F.col("mean")) ** 2), F.lit(0.0))
    square = inside + F.coalesce((gap - F.col("mean")) ** 2, F.lit(0.0))

    def plus(c: str, more) -> Column:
        return F.sum(F.col(c) + F.coalesce(more.cast("long"), F.lit(0))).alias(c)

    p, f = F.col("p.type"), F.col("first.type")
    steps = []
    for c, t in STEPS.items():
        if len(t) == 2:
            steps.append(plus(c, _step(t, p, f)))
        else:
            over = F.coalesce(_step(t, F.col("pp_type"), p, f).cast("long"), F.lit(0)) \
                + F.coalesce(_step(t, p, f, F.col("second_type")).cast("long"), F.lit(0))
            steps.append(plus(c, over))
    first = lambda c: F.min_by(c, F.col(BUCKET))
    aggs = [
        *[F.sum(c).alias(c) for c in ("n", "n_buy", "n_addcart", "n_view", "n_remove", "n_product_events")],
        first("first.type").alias("first_type"), F.max_by("last.type", F.col(BUCKET)).alias("last_type"),
        first("user_id").alias("user_id"),
        F.min("t_first").alias("t_first"), F.max("t_last").alias("t_last"),
        F.max(F.greatest("gap_max", gap)).alias("gap_max"), F.max("mean").alias("gap_avg"),
        F.sqrt(F.when(F.max("all_gaps") > 1, F.sum(square) / (F.max("all_gaps") - 1))).alias("gap_std"),
        plus("n_long_gap", gap > LONG_PAUSE_SECONDS), plus("n_quick_gap", gap < QUICK_ACTION_SECONDS),
        *steps,
        plus("n_category_changes", F.col("edge") & _changed(F.col("p.cat"), F.col("first.cat"))),
        F.min(F.col("offset") + F.col("first_buy")).alias("first_buy_rn"),
    ]
    if TARGET in states.columns:
        aggs.append(first(TARGET).alias(TARGET))
    return s.groupBy(SESSION).agg(*aggs)


def main_stats(clicks: DataFrame, bucket_seconds: float = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """One row per session with every order-dependent statistic."""
    ntz = is_ntz(clicks, TIME)
    st = merged_states(bucket_states(clicks, bucket_seconds), ntz)
    return st.withColumn("span_s", seconds_between("t_first", "t_last", ntz))


@dataclass
class Lookups:
    """Fitted lookup tables (see operators.rates)."""
    category_rates: DataFrame | None = None    # category_id, buy_rate, engagement
    product_rates: DataFrame | None = None     # product_id, buy_rate
    page_values: DataFrame | None = None       # category_id, page_value
    max_broadcast_rows: int | None = None
    rows: dict | None = None                   # checked row count per table name


def _join_opts(lk: Lookups, table: str) -> dict:
    out = {} if lk.max_broadcast_rows is None else {"max_broadcast_rows": lk.max_broadcast_rows}
    if lk.rows and table in lk.rows:
        out["rows"] = lk.rows[table]
    return out


def product_stats(clicks: DataFrame, lookups: Lookups | None = None) -> DataFrame:
    """Per session: distinct products, most interacted product, distinct viewed
    products and product buy-rate scores over the session's distinct products
    (a null product is one key with score 0, as ``unique()`` keeps NaN)."""
    pk = (clicks.filter(F.col(SESSION).isNotNull())
          .groupBy(SESSION, "product_id")
          .agg(F.count(F.lit(1)).alias("pcnt"), F.max(_is("event_type", VIEW)).alias("viewed")))
    aggs = [
        F.count("product_id").alias("up"),
        F.coalesce(F.max(F.when(F.col("product_id").isNotNull(), F.col("pcnt"))), F.lit(0)).alias("max_pn"),
        F.count_if(F.col("viewed") & F.col("product_id").isNotNull()).alias("n_viewed_products"),
    ]
    if lookups is not None and lookups.product_rates is not None:
        rates = lookups.product_rates.select("product_id", F.col("buy_rate").alias("p_rate"))
        pk = lookup_join(pk, rates, "product_id", salt_by=SESSION, **_join_opts(lookups, "product_rates"))
        score = F.coalesce(F.col("p_rate"), F.lit(0.0))
        aggs += [F.max(score).alias("p_max"), F.avg(score).alias("p_avg")]
    return pk.groupBy(SESSION).agg(*aggs)


def category_stats(clicks: DataFrame, lookups: Lookups | None = None) -> DataFrame:
    """Per session: distinct categories and rate / engagement / page-value
    scores over the session's distinct categories (unseen key scores 0)."""
    ck = clicks.filter(F.col(SESSION).isNotNull()).select(SESSION, "category_id").distinct()
    aggs = [F.count("category_id").alias("uc"), F.count(F.lit(1)).alias("n_category_keys")]
    lk = lookups or Lookups()
    if lk.category_rates is not None:
        rates = lk.category_rates.select("category_id", F.col("buy_rate").alias("c_rate"),
                                         F.col("engagement").alias("c_eng"))
        ck = lookup_join(ck, rates, "category_id", salt_by=SESSION, **_join_opts(lk, "category_rates"))
        r = F.coalesce(F.col("c_rate"), F.lit(0.0))
        e = F.coalesce(F.col("c_eng"), F.lit(0.0))
        aggs += [F.sum(r).alias("c_sum"), F.max(r).alias("c_max"), F.avg(r).alias("c_avg"),
                 F.avg(e).alias("e_avg"), F.max(e).alias("e_max")]
    if lk.page_values is not None:
        pv = lk.page_values.select("category_id", F.col("page_value").alias("c_pv"))
        ck = lookup_join(ck, pv, "category_id", salt_by=SESSION, **_join_opts(lk, "page_values"))
        v = F.coalesce(F.col("c_pv"), F.lit(0.0))
        aggs += [F.sum(v).alias("pv_sum"), F.max(v).alias("pv_max"), F.avg(v).alias("pv_avg")]
    return ck.groupBy(SESSION).agg(*aggs)


def key_stats(clicks: DataFrame, lookups: Lookups | None = None) -> DataFrame:
    """``product_stats`` and ``category_stats`` in one pass: one grouping-sets
    aggregate over (session, product) and (session, category) (map-side
    partial aggregation, a single exchange of the click rows), the lookups
    on the key rows, then one per-session aggregate that picks each set's
    rows by ``grouping_id``."""
    lk = lookups or Lookups()
    keys = (clicks.filter(F.col(SESSION).isNotNull())
            .groupingSets([[SESSION, "product_id"], [SESSION, "category_id"]], SESSION, "product_id", "category_id")
            .agg(F.count(F.lit(1)).alias("pcnt"), F.max(_is("event_type", VIEW)).alias("viewed"),
                 F.grouping_id().alias("_gid")))
    is_p = F.col("_gid") == F.lit(1)      # category_id aggregated away: product rows
    is_c = F.col("_gid") == F.lit(2)      # product_id aggregated away: category rows
    aggs = [
        F.count(F.when(is_p, F.col("product_id"))).alias("up"),
        F.coalesce(F.max(F.when(is_p & F.col("product_id").isNotNull(), F.col("pcnt"))), F.lit(0)).alias("max_pn"),
        F.count_if(is_p & F.col("viewed") & F.col("product_id").isNotNull()).alias("n_viewed_products"),
        F.count(F.when(is_c, F.col("category_id"))).alias("uc"),
        F.count_if(is_c).alias("n_category_keys"),
    ]
    if lk.product_rates is not None:
        rates = lk.product_rates.select("product_id", F.col("buy_rate").alias("p_rate"))
        keys = lookup_join(keys, rates, "product_id", salt_by=SESSION, **_join_opts(lk, "product_rates"))
        score = F.when(is_p, F.coalesce(F.col("p_rate"), F.lit(0.0)))
        aggs += [F.max(score).alias("p_max"), F.avg(score).alias("p_avg")]
    if lk.category_rates is not None:
        rates = lk.category_rates.select("category_id", F.col("buy_rate").alias("c_rate"),
                                         F.col("engagement").alias("c_eng"))
        keys = lookup_join(keys, rates, "category_id", salt_by=SESSION, **_join_opts(lk, "category_rates"))
        r = F.when(is_c, F.coalesce(F.col("c_rate"), F.lit(0.0)))
        e = F.when(is_c, F.coalesce(F.col("c_eng"), F.lit(0.0)))
        aggs += [F.sum(r).alias("c_sum"), F.max(r).alias("c_max"), F.avg(r).alias("c_avg"),
                 F.avg(e).alias("e_avg"), F.max(e).alias("e_max")]
    if lk.page_values is not None:
        pv = lk.page_values.select("category_id", F.col("page_value").alias("c_pv"))
        keys = lookup_join(keys, pv, "category_id", salt_by=SESSION, **_join_opts(lk, "page_values"))
        v = F.when(is_c, F.coalesce(F.col("c_pv"), F.lit(0.0)))
        aggs += [F.sum(v).alias("pv_sum"), F.max(v).alias("pv_max"), F.avg(v).alias("pv_avg")]
    return keys.groupBy(SESSION).agg(*aggs)


def session_stats(clicks: DataFrame, lookups: Lookups | None = None, need_products: bool = True,
                  need_categories: bool = True,
                  bucket_seconds: float = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Main statistics joined with the product / category statistics.

    All three sides are keyed and hash-partitioned by ``user_session`` with
    one row per session, so the joins are shuffle-free merges of equal keys.
    """
    st = main_stats(clicks, bucket_seconds)
    if need_products and need_categories:
        return st.join(key_stats(clicks, lookups), SESSION, "inner")
    if need_products:
        st = st.join(product_stats(clicks, lookups), SESSION, "inner")
    if need_categories:
        st = st.join(category_stats(clicks, lookups), SESSION, "inner")
    return st


__all__ = ["bucket_states", "merged_states", "main_stats", "product_stats", "category_stats", "session_stats", "Lookups", "BUCKET"]
