"""DuckDB SQL that states every query's expected result independently.

These are plain window / group-by formulations over the pre-registered
views (``events`` ...); the Spark side computes the same results with the
skew-split operators.  Doubles are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

SPLIT_DATE = "2024-01-24"


def count_filter(sql: str) -> str:
    """Rewrite ``count_if(c)`` as ``count(*) filter (where c)``: DuckDB's
    count_if is NULL over all-NULL input, Spark's is 0."""
    out, i, tok = [], 0, "count_if("
    while True:
        j = sql.find(tok, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k = 1, j + len(tok)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(f"count(*) filter (where {sql[j + len(tok):k - 1]})")
        i = k


def flag(cond: str) -> str:
    return f"cast(case when {cond} then 1 else 0 end as bigint)"


def ratio(num: str, den: str, floor: float | None = None) -> str:
    d = f"cast({den} as double)"
    if floor is not None:
        d = f"greatest({d}, {floor})"
    return f"(cast({num} as double) / {d})"


CLICKS_CTES = """
ev_ as (
  select event_id, ts, user_id, event_type, value,
         cast(json_extract_string(props, '$.k') as int) as k from events where ts is not null),
brk_ as (
  select *, case when ts <= lag(ts) over (partition by user_id order by ts, event_id)
                             + interval 12 hours then 0 else 1 end as brk from ev_),
sid_ as (
  select *, sum(brk) over (partition by user_id order by ts, event_id
                           rows between unbounded preceding and current row) as sid from brk_),
c0_ as (
  select event_id, ts as event_time,
         'U' || cast(user_id as varchar) as user_id,
         'U' || cast(user_id as varchar) || '-S' || cast(sid as varchar) as user_session,
         case event_type when 'purchase' then 'BUY' when 'click' then 'ADD_CART'
                         when 'error' then 'REMOVE_CART' else 'VIEW' end as event_type,
         'P' || cast(k as varchar) as product_id,
         'C' || cast(k % 10 as varchar) as category_id, value from sid_),
clicks as (
  select event_id, event_time, user_id, user_session, event_type, product_id, category_id,
         cast(sum(cast(value as decimal(18,2))) over (partition by user_session) as double)
           as session_value
  from c0_)"""


def split_cte(name: str, cond: str, src: str = "clicks") -> str:
    return f"{name} as (select * from {src} where {cond})"


TRAIN_COND = f"cast(event_time as date) < date '{SPLIT_DATE}'"
VAL_COND = f"cast(event_time as date) >= date '{SPLIT_DATE}'"


def rates_ctes(train: str = "train_clicks") -> str:
    return f"""
crate_ as (
  select category_id,
         cast(count_if(event_type = 'BUY') as double) / nullif(count(distinct user_session), 0) as buy_rate,
         cast(count(event_type) as double) / nullif(count(distinct user_session), 0) as engagement
  from {train} group by category_id),
prate_ as (
  select product_id,
         cast(count_if(event_type = 'BUY') as double) / nullif(count(distinct user_session), 0) as buy_rate
  from {train} group by product_id),
thr_ as (
  select quantile_cont(buy_rate, 0.75) as p75, quantile_cont(buy_rate, 0.90) as p90 from crate_),
pv_first_ as (
  select user_session, category_id,
         arg_min(session_value, struct_pack(t := event_time, i := event_id))
           filter (where session_value is not null) as v
  from {train} where user_session is not null group by user_session, category_id),
pval_ as (select category_id, avg(v) as page_value from pv_first_ group by category_id)"""


def stats_ctes(src: str, with_rates: bool, with_pv: bool = False, px: str = "") -> str:
    """Per-session statistics of the click rows in ``src``."""
    p_rate = ", max(coalesce(pr.buy_rate, 0)) as p_max, avg(coalesce(pr.buy_rate, 0)) as p_avg" \
        if with_rates else ""
    p_join = f"left join prate_ pr on {px}pk.product_id = pr.product_id" if with_rates else ""
    c_rate = (", sum(coalesce(cr.buy_rate, 0)) as c_sum, max(coalesce(cr.buy_rate, 0)) as c_max,"
              " avg(coalesce(cr.buy_rate, 0)) as c_avg, avg(coalesce(cr.engagement, 0)) as e_avg,"
              " max(coalesce(cr.engagement, 0)) as e_max") if with_rates else ""
    c_join = f"left join crate_ cr on {px}ck.category_id = cr.category_id" if with_rates else ""
    pv_agg = (", sum(coalesce(pv.page_value, 0)) as pv_sum, max(coalesce(pv.page_value, 0)) as pv_max,"
              " avg(coalesce(pv.page_value, 0)) as pv_avg") if with_pv else ""
    pv_join = f"left join pval_ pv on {px}ck.category_id = pv.category_id" if with_pv else ""
    return f"""
{px}e_ as (
  select *, row_number() over w as rn,
         lag(event_type) over w as prev_type, lag(event_type, 2) over w as prev2_type,
         lag(category_id) over w as prev_cat,
         date_diff('microsecond', lag(event_time) over w, event_time) / 1e6 as gap_s
  from {src} where user_session is not null
  window w as (partition by user_session order by event_time, event_id)),
{px}m_ as (
  select user_session, count(*) as n,
         count_if(event_type = 'BUY') as n_buy, count_if(event_type = 'ADD_CART') as n_addcart,
         count_if(event_type = 'VIEW') as n_view, count_if(event_type = 'REMOVE_CART') as n_remove,
         arg_min(event_type, rn) as first_type, arg_max(event_type, rn) as last_type,
         arg_min(user_id, rn) as user_id, arg_min(session_value, rn) as session_value,
         min(event_time) as t_first, max(event_time) as t_last,
         max(gap_s) as gap_max, avg(gap_s) as gap_avg, stddev_samp(gap_s) as gap_std,
         count_if(gap_s > 300) as n_long_gap, count_if(gap_s < 10) as n_quick_gap,
         count_if(prev_type = 'ADD_CART' and event_type = 'BUY') as n_addcart_buy,
         count_if(prev_type = 'VIEW' and event_type = 'BUY') as n_view_buy,
         count_if(prev_type = 'ADD_CART' and event_type = 'REMOVE_CART') as n_addcart_remove,
         count_if(prev2_type = 'VIEW' and prev_type = 'ADD_CART' and event_type = 'BUY')
           as n_view_addcart_buy,
         count_if(rn > 1 and not coalesce(prev_cat = category_id, false)) as n_category_changes,
         min(case when event_type = 'BUY' then rn end) as first_buy_rn,
         count(product_id) as n_product_events
  from {px}e_ group by user_session),
{px}pk as (
  select user_session, product_id, count(*) as pcnt, bool_or(event_type = 'VIEW') as viewed
  from {src} where user_session is not null group by user_session, product_id),
{px}p_ as (
  select {px}pk.user_session, count({px}pk.product_id) as up,
         coalesce(max(case when {px}pk.product_id is not null then pcnt end), 0) as max_pn,
         count_if(viewed and {px}pk.product_id is not null) as n_viewed_products{p_rate}
  from {px}pk {p_join} group by {px}pk.user_session),
{px}ck as (select distinct user_session, category_id from {src} where user_session is not null),
{px}c_ as (
  select {px}ck.user_session, count({px}ck.category_id) as uc, count(*) as n_category_keys{c_rate}{pv_agg}
  from {px}ck {c_join} {pv_join} group by {px}ck.user_session),
{px}st as (select * from {px}m_ join {px}p_ using (user_session) join {px}c_ using (user_session))"""


def _dur_secs() -> str:
    return "(case when n > 1 then date_diff('microsecond', t_first, t_last) / 1e6 else 0.0 end)"


def base_sql() -> list[tuple[str, str]]:
    dur = f"({_dur_secs()} / 60.0)"
    out = [("total_events", "cast(n as bigint)"), ("unique_products", "cast(up as bigint)"),
           ("unique_categories", "cast(uc as bigint)"), ("buy_count", "cast(n_buy as bigint)"),
           ("addcart_count", "cast(n_addcart as bigint)"), ("view_count", "cast(n_view as bigint)"),
           ("remove_count", "cast(n_remove as bigint)"),
           ("buy_ratio", ratio("n_buy", "n")), ("addcart_ratio", ratio("n_addcart", "n")),
           ("view_ratio", ratio("n_view", "n")), ("remove_ratio", ratio("n_remove", "n")),
           ("last_event_buy", flag("last_type = 'BUY'")),
           ("last_event_addcart", flag("last_type = 'ADD_CART'")),
           ("last_event_view", flag("last_type = 'VIEW'")),
           ("last_event_remove", flag("last_type = 'REMOVE_CART'")),
           ("first_event_view", flag("first_type = 'VIEW'")),
           ("first_event_addcart", flag("first_type = 'ADD_CART'")),
           ("duration_minutes", dur),
           ("events_per_minute", f"(cast(n as double) / greatest({dur}, 0.01))")]
    return out


def behavioral_sql() -> list[tuple[str, str]]:
    rev = "(n_product_events - up)"
    return [("has_multiple_buys", flag("n_buy > 1")), ("has_buy_end", flag("last_type = 'BUY'")),
            ("has_addcart_buy_pattern", flag("n_addcart_buy > 0")),
            ("has_view_buy_pattern", flag("n_view_buy > 0")),
            ("indecision_count", "cast(n_addcart_remove as bigint)"),
            ("product_revisits", f"cast({rev} as bigint)"),
            ("category_changes", "cast(n_category_changes as bigint)"),
            ("max_time_gap", "(case when n > 1 then gap_max else 0.0 end)"),
            ("has_long_pause", flag("n > 1 and n_long_gap > 0")),
            ("has_quick_actions", flag("n > 1 and n_quick_gap > 0")),
            ("is_focused_shopper", flag("up = 1 and n > 1")),
            ("is_comparison_shopper", flag("up >= 3 and uc <= 2")),
            ("is_explorer", flag("uc >= 3")),
            ("cart_conversion_rate",
             "(case when n_addcart > 0 then cast(n_buy as double) / n_addcart else 0.0 end)"),
            ("revisit_ratio", ratio(rev, "up", 1))]


def research_sql() -> list[tuple[str, str]]:
    dur = f"({_dur_secs()} / 60.0)"
    return [("monetary_proxy", "cast(n_buy as bigint)"), ("total_category_score", "c_sum"),
            ("decisiveness_score",
             "(case when first_buy_rn is not null then 1.0 - cast(first_buy_rn - 1 as double) / n"
             " else 0.0 end)"),
            ("has_comparison_pattern", flag("n_category_keys > 2")),
            ("max_category_score", "c_max"), ("avg_category_score", "c_avg"),
            ("max_product_score", "p_max"), ("avg_product_score", "p_avg"),
            ("avg_engagement", "e_avg"), ("max_engagement", "e_max"),
            ("is_bounce", flag("n = 1")), ("has_immediate_exit", flag("n = 1 and first_type = 'VIEW'")),
            ("session_duration_minutes", dur),
            ("max_time_gap", "(case when n > 1 then gap_max else 0.0 end)"),
            ("std_time_between_events", "(case when n > 2 then coalesce(gap_std, 0.0) else 0.0 end)"),
            ("time_per_product",
             f"(case when n_viewed_products > 0 and {dur} > 0 then {dur} / n_viewed_products else 0.0 end)"),
            ("max_product_interactions", "cast(max_pn as bigint)"),
            ("exploration_score", ratio("(uc + up)", "n")),
            ("category_diversity", ratio("uc", "up", 1)),
            ("decision_changes", "cast(n_addcart_remove as bigint)"),
            ("has_multiple_addcart_sequence", flag("n_addcart >= 2")),
            ("has_view_addcart_buy_sequence", flag("n_view_addcart_buy > 0")),
            ("funnel_addcart_to_buy", ratio("n_addcart_buy", "n_addcart", 1)),
            ("has_high_buy_rate_category", flag("c_max > (select p75 from thr_)")),
            ("has_ultra_high_buy_rate_category", flag("c_max > (select p90 from thr_)")),
            ("unique_categories", "cast(uc as bigint)"), ("unique_products", "cast(up as bigint)"),
            ("total_events", "cast(n as bigint)"), ("buy_count", "cast(n_buy as bigint)")]


def temporal_sql() -> list[tuple[str, str]]:
    h, d, dom, mo = "hour(t_first)", "(isodow(t_first) - 1)", "dayofmonth(t_first)", "month(t_first)"
    span = f"({_dur_secs()} / 3600.0)"
    return [("hour", f"cast({h} as bigint)"), ("day_of_week", f"cast({d} as bigint)"),
            ("day", f"cast({dom} as bigint)"), ("month", f"cast({mo} as bigint)"),
            ("is_weekend", flag(f"{d} >= 5")), ("is_monday", flag(f"{d} = 0")),
            ("is_friday", flag(f"{d} = 4")), ("is_sunday", flag(f"{d} = 6")),
            ("is_night", flag(f"{h} >= 22 or {h} <= 6")), ("is_morning", flag(f"{h} between 7 and 12")),
            ("is_afternoon", flag(f"{h} between 13 and 18")), ("is_evening", flag(f"{h} between 19 and 22")),
            ("is_business_hours", flag(f"{h} between 9 and 17")),
            ("is_lunch_time", flag(f"{h} between 11 and 14")),
            ("is_peak_hour", flag(f"{h} in (10, 11, 12, 15)")),
            ("is_prime_shopping", flag(f"{h} between 19 and 22")),
            ("is_month_start", flag(f"{dom} <= 5")), ("is_month_end", flag(f"{dom} >= 25")),
            ("is_mid_month", flag(f"{dom} between 13 and 17")), ("is_payday", flag(f"{dom} in (15, 30, 31)")),
            ("is_summer", flag(f"{mo} in (6, 7, 8)")), ("is_winter", flag(f"{mo} in (12, 1, 2)")),
            ("session_span_hours", span),
            ("crosses_hour_boundary", flag(f"n > 1 and {span} >= 1")),
            ("crosses_day_boundary", flag("n > 1 and cast(t_first as date) <> cast(t_last as date)")),
            ("is_quick_session", flag(f"{span} < 0.1")), ("is_extended_session", flag(f"{span} > 2"))]


def page_value_sql() -> list[tuple[str, str]]:
    secs = _dur_secs()
    return [("session_duration_minutes", f"({secs} / 60.0)"), ("session_duration_seconds", secs),
            ("avg_time_between_events", f"(case when n > 1 then {secs} / cast(n - 1 as double) else 0.0 end)"),
            ("std_time_between_events", "(case when n > 2 then coalesce(gap_std, 0.0) else 0.0 end)"),
            ("max_time_gap", "(case when n > 1 then gap_max else 0.0 end)"),
            ("event_intensity", f"(cast(n as double) / greatest({secs} / 60.0, 0.01))"),
            ("total_page_value", "pv_sum"), ("max_page_value", "pv_max"), ("avg_page_value", "pv_avg"),
            ("has_view_addcart_buy_sequence", flag("n_view_addcart_buy > 0")),
            ("has_multiple_addcart_sequence", flag("n_addcart >= 2")),
            ("has_comparison_pattern", flag("n_category_keys > 2")),
            ("funnel_addcart_to_buy", ratio("n_addcart_buy", "n_addcart", 1))]


FAMILY_SQL = {"base": base_sql, "behavioral": behavioral_sql, "research": research_sql,
              "temporal": temporal_sql, "page_value": page_value_sql}


def feature_exprs(families) -> list[tuple[str, str]]:
    seen, out = {"user_session", "user_id"}, []
    for fam in families:
        for name, e in FAMILY_SQL[fam]():
            if name not in seen:
                seen.add(name)
                out.append((name, e))
    return out


def r6(e: str, name: str, is_double: bool) -> str:
    return f"{rnd(e)} as {name}" if is_double else f"{e} as {name}"


def rnd(e: str) -> str:
    """Round to 6 decimals exactly as ``functions.exprs.round_doubles``."""
    return f"(round(({e}) * 1000000.0) / 1000000.0)"


def is_double_expr(e: str) -> bool:
    return not (e.startswith("cast(") and e.endswith("as bigint)"))


def feature_ctes(name: str, families, src_cond: str | None = None, ids: bool = True,
                 target: bool = True, with_rates: bool = True, px: str = "",
                 rounded: bool = True) -> list[str]:
    """CTEs computing feature table ``name`` from ``clicks`` rows matching
    ``src_cond`` (expects the clicks / train_clicks / rate CTEs before)."""
    with_pv = "page_value" in families
    ctes, src = [], "clicks"
    if src_cond:
        ctes.append(split_cte(f"{px}src_clicks", src_cond))
        src = f"{px}src_clicks"
    ctes.append(stats_ctes(src, with_rates, with_pv, px).strip())
    cols = []
    if ids:
        cols += ["user_session", "user_id"]
    if rounded:
        cols += [r6(e, n, is_double_expr(e)) for n, e in feature_exprs(families)]
    else:
        cols += [f"{e} as {n}" for n, e in feature_exprs(families)]
    if target:
        cols.append(f"{rnd('session_value')} as session_value" if rounded else "session_value")
    ctes.append(f"{name} as (select " + ",\n  ".join(cols) + f"\nfrom {px}st)")
    return ctes


def head_ctes(with_rates: bool = True) -> list[str]:
    out = [CLICKS_CTES.strip(), split_cte("train_clicks", TRAIN_COND),
           split_cte("val_clicks", VAL_COND)]
    if with_rates:
        out.append(rates_ctes().strip())
    return out


def compose(ctes: list[str], final: str) -> str:
    return count_filter("with " + ",\n".join(ctes) + "\n" + final)


def feature_table_sql(families, src_cond: str | None = None, ids: bool = True,
                      target: bool = True, with_rates: bool = True) -> str:
    """Full SQL of the feature table of the clicks matching ``src_cond``."""
    ctes = head_ctes(with_rates) + feature_ctes("ft", families, src_cond, ids, target, with_rates)
    return compose(ctes, "select * from ft")


def both_splits_sql(families, label: bool = True, ids: bool = True, target: bool = True, with_rates: bool = True) -> str:
    """The feature tables of the train and the validation clicks, with lookups
    fitted on train; ``label`` adds a ``split`` column."""
    ctes = head_ctes(with_rates)
    parts = []
    for name, cond, px in (("train", TRAIN_COND, "a"), ("validation", VAL_COND, "b")):
        ctes += feature_ctes(f"{px}ft", families, cond, ids, target, with_rates, px=px)
        parts.append("select " + (f"'{name}' as split, " if label else "") + f"* from {px}ft")
    return compose(ctes, "\nunion all ".join(parts))
