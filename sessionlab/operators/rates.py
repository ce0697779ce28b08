"""Learned lookup tables (fit on the training split only).

A1-A3: per category BUY events / distinct sessions, non-null events /
distinct sessions; per product BUY events / distinct sessions.
A4: 75th / 90th percentile of the category buy rates, computed once.
A6: page value, the mean over sessions of the session's first non-null
target value, per category (uses the target: train only, optional family).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlab.functions.quantiles import exact_quantiles
from sessionlab.operators.sessions import Lookups
from sessionlab.schema import BUY, SESSION, TARGET, TIME, tie_columns

# Percentiles of the category buy rate used by the high / ultra-high flags.
HIGH_RATE_PERCENTILE = 0.75
ULTRA_HIGH_RATE_PERCENTILE = 0.90


def category_rates(clicks: DataFrame) -> DataFrame:
    """category_id, buy_rate, engagement (rates may exceed 1)."""
    g = clicks.groupBy("category_id").agg(
        F.count_if(F.col("event_type") == F.lit(BUY)).alias("n_buy"),
        F.count("event_type").alias("n_events"),
        F.count_distinct(SESSION).alias("n_sessions"))
    # a key seen only in rows without a session has no rate (scores 0)
    return g.select("category_id",
                    F.try_divide(F.col("n_buy").cast("double"), F.col("n_sessions")).alias("buy_rate"),
                    F.try_divide(F.col("n_events").cast("double"), F.col("n_sessions")).alias("engagement"))


def product_rates(clicks: DataFrame) -> DataFrame:
    """product_id, buy_rate."""
    g = clicks.groupBy("product_id").agg(
        F.count_if(F.col("event_type") == F.lit(BUY)).alias("n_buy"),
        F.count_distinct(SESSION).alias("n_sessions"))
    return g.select("product_id",
                    F.try_divide(F.col("n_buy").cast("double"), F.col("n_sessions")).alias("buy_rate"))


def rate_thresholds(cat_rates: DataFrame) -> tuple[float | None, float | None]:
    """A4 over the fitted category table."""
    q = exact_quantiles(cat_rates, ["buy_rate"], [HIGH_RATE_PERCENTILE, ULTRA_HIGH_RATE_PERCENTILE])
    return q["buy_rate"][0], q["buy_rate"][1]


def page_values(clicks: DataFrame) -> DataFrame:
    """category_id, page_value: first non-null target per (session,
    category) in event order, averaged per category."""
    order = F.struct(F.col(TIME), *[F.col(c) for c in tie_columns(clicks)])
    first = (clicks.filter(F.col(SESSION).isNotNull())
             .groupBy(SESSION, "category_id")
             .agg(F.min_by(F.col(TARGET), F.when(F.col(TARGET).isNotNull(), order)).alias("v")))
    return first.groupBy("category_id").agg(F.avg("v").alias("page_value"))


@dataclass
class RateModel:
    """Fitted state of the research family (and the page-value family)."""
    lookups: Lookups
    high_threshold: float | None
    ultra_high_threshold: float | None

    def write(self, path: str, mode: str = "overwrite") -> None:
        """Persist the fitted tables as parquet plus the thresholds."""
        lk = self.lookups
        lk.category_rates.write.mode(mode).parquet(f"{path}/category_rates")
        lk.product_rates.write.mode(mode).parquet(f"{path}/product_rates")
        if lk.page_values is not None:
            lk.page_values.write.mode(mode).parquet(f"{path}/page_values")
        spark = lk.category_rates.sparkSession
        spark.createDataFrame([(self.high_threshold, self.ultra_high_threshold, lk.page_values is not None)],
                              "high_threshold double, ultra_high_threshold double, has_page_values boolean") \
            .write.mode(mode).parquet(f"{path}/thresholds")

    @classmethod
    def read(cls, spark, path: str) -> "RateModel":
        th = spark.read.parquet(f"{path}/thresholds").first()
        pv = spark.read.parquet(f"{path}/page_values") if th["has_page_values"] else None
        return cls(Lookups(spark.read.parquet(f"{path}/category_rates"),
                           spark.read.parquet(f"{path}/product_rates"), pv),
                   th["high_threshold"], th["ultra_high_threshold"])


def fit_rates(train_clicks: DataFrame, with_page_values: bool = False,
              max_broadcast_rows: int | None = None) -> RateModel:
    """A5: fit the rate tables and thresholds on the training click log.

    The fitted tables are checkpointed (reused by every split) and counted
    once: the counts are the checked sizes behind the broadcast decision.
    """
    cr = category_rates(train_clicks).checkpoint(eager=True)
    pr = product_rates(train_clicks).checkpoint(eager=True)
    pv = page_values(train_clicks).checkpoint(eager=True) \
        if with_page_values and TARGET in train_clicks.columns else None
    rows = {"category_rates": cr.count(), "product_rates": pr.count()}
    if pv is not None:
        rows["page_values"] = pv.count()
    hi, uhi = rate_thresholds(cr)
    return RateModel(Lookups(cr, pr, pv, max_broadcast_rows, rows), hi, uhi)
