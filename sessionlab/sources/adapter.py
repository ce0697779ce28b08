"""Test-data adapter: the driver's ``events`` table as a click log.

purchase -> BUY, click -> ADD_CART, error -> REMOVE_CART, anything else ->
VIEW; product ``'P'||k`` and category ``'C'||(k % 10)`` from ``props.k``;
sessions are runs of a user's events with gaps of at most 12 hours;
session_value is the session's value total.

Sessionising needs no window over the events: with hour buckets and a 12
hour gap a session can only start at a bucket's first event, so per-bucket
first / last times and value sums (partial aggregation) decide sessions and
their totals, which are joined back on (user, bucket)
(``operators.ordered.gap_sessions``).  One very active user is spread over
its buckets.  Events without a time are dropped (they cannot be placed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlab.functions.exprs import epoch_micros, is_ntz
from sessionlab.operators.ordered import (BUCKET, DEFAULT_BUCKET_SECONDS, gap_sessions, split_lag,
                                          split_running_sum)
from sessionlab.schema import ADD_CART, BUY, REMOVE_CART, VIEW

# Fixed values of the adapter.
SESSION_GAP_HOURS = 12
N_CATEGORIES = 10
EVENT_TYPE_MAP = {"purchase": BUY, "click": ADD_CART, "error": REMOVE_CART}


def map_event_type(c) -> F.Column:
    e = F.when(c == F.lit("purchase"), F.lit(EVENT_TYPE_MAP["purchase"]))
    e = e.when(c == F.lit("click"), F.lit(EVENT_TYPE_MAP["click"]))
    e = e.when(c == F.lit("error"), F.lit(EVENT_TYPE_MAP["error"]))
    return e.otherwise(F.lit(VIEW))


def clicks_from_events(events: DataFrame, gap_hours: int = SESSION_GAP_HOURS,
                       bucket_seconds: float = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """event_id, event_time, user_id, user_session, event_type, product_id,
    category_id, session_value."""
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    # exact cents: values carry two decimals, so a decimal sum is order-free
    ev = events.select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"),
                       F.col("value").cast("decimal(18,2)").alias("_cents"))
    gap_s = int(gap_hours) * 3600
    if bucket_seconds <= gap_s:
        ev = gap_sessions(ev, "user_id", "ts", gap_s, "_sid", sum_col="_cents", sum_out="_total",
                          bucket_seconds=bucket_seconds)
    else:
        ev = _windowed_sessions(ev, gap_s, bucket_seconds)
    uid = F.col("user_id").cast("string")
    clicks = ev.select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.concat(F.lit("U"), uid).alias("user_id"),
        F.concat(F.lit("U"), uid, F.lit("-S"), F.col("_sid").cast("string")).alias("user_session"),
        map_event_type(F.col("event_type")).alias("event_type"),
        F.concat(F.lit("P"), F.col("k").cast("string")).alias("product_id"),
        F.concat(F.lit("C"), (F.col("k") % N_CATEGORIES).cast("string")).alias("category_id"),
        F.col("_total").cast("double").alias("session_value"),
    )
    return clicks


def _windowed_sessions(ev: DataFrame, gap_s: int, bucket_seconds: float) -> DataFrame:
    """General path (buckets wider than the gap): lag and running sum of
    session breaks with the split windows, totals joined back."""
    ev = ev.filter(F.col("ts").isNotNull())
    order = ["ts", "event_id"]
    ev = split_lag(ev, "user_id", order, {"_prev_ts": ("ts", 1)}, time_col="ts", bucket_seconds=bucket_seconds)
    ntz = is_ntz(ev, "ts")
    gap_us = epoch_micros("ts", ntz) - epoch_micros("_prev_ts", ntz)
    brk = F.when(gap_us <= F.lit(gap_s * 1_000_000), F.lit(0)).otherwise(F.lit(1))
    ev = split_running_sum(ev.withColumn("_brk", brk), "user_id", order, "_brk", "_sid",
                           time_col="ts", bucket_seconds=bucket_seconds)
    totals = ev.groupBy("user_id", "_sid").agg(F.sum("_cents").alias("_total"))
    return ev.join(totals, ["user_id", "_sid"], "inner")


def load_clicks(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """Read ``events`` under ``sf_dir`` and adapt it to the click log."""
    return clicks_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"), **kw)


__all__ = ["clicks_from_events", "load_clicks", "map_event_type", "BUCKET"]
