"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Every query reads the driver's tables under ``sf_dir`` (the ``events``
table through the click-log adapter) and runs over all of it.  Doubles are
rounded to 6 decimals, counts and flags are bigint, on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlab.functions.exprs import round_doubles
from sessionlab.operators.features import build_features
from sessionlab.plans import oracle as O
from sessionlab.sources.adapter import load_clicks
from sessionlab.sources.store import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _splits(spark, sf_dir):
    """The adapted click log, staged once per session, and its two time
    splits (plain filters on the staged table: pushed to its parquet scan)."""
    from sessionlab.plans.workspace import workspace
    ws = workspace(spark, sf_dir)
    return ws.clicks, ws.split("train"), ws.split("val")


def _ws(spark, sf_dir):
    from sessionlab.plans.workspace import workspace
    return workspace(spark, sf_dir)


# ---------------------------------------------------------------- sources

@register("click_log", "with " + O.CLICKS_CTES.strip() + "\nselect * from clicks")
def q_click_log(spark, sf_dir):
    return load_clicks(spark, sf_dir)


# ---------------------------------------------------------------- families

@register("base_features", O.feature_table_sql(["base"], with_rates=False))
def q_base(spark, sf_dir):
    return round_doubles(build_features(_ws(spark, sf_dir).clicks, ["base"]))


@register("behavioral_features", O.feature_table_sql(["behavioral"], with_rates=False, ids=True, target=False))
def q_behavioral(spark, sf_dir):
    df = build_features(_ws(spark, sf_dir).clicks, ["behavioral"])
    return round_doubles(df.drop("session_value"))


@register("temporal_features", O.feature_table_sql(["temporal"], with_rates=False, target=False))
def q_temporal(spark, sf_dir):
    df = build_features(_ws(spark, sf_dir).clicks, ["temporal"])
    return round_doubles(df.drop("session_value"))


def both_splits(make) -> DataFrame:
    """``make(split)`` of train and validation, told apart by ``split``."""
    return make("train").select(F.lit("train").alias("split"), "*").unionByName(
        make("val").select(F.lit("validation").alias("split"), "*"))


@register("research_features", O.both_splits_sql(["research"]))
def q_research(spark, sf_dir):
    ws = _ws(spark, sf_dir)
    return round_doubles(both_splits(lambda s: build_features(ws.split(s), ["research"], ws.rates())))


@register("page_value_features", O.both_splits_sql(["page_value"]))
def q_page_value(spark, sf_dir):
    ws = _ws(spark, sf_dir)
    return round_doubles(both_splits(
        lambda s: build_features(ws.split(s), ["page_value"], ws.rates(with_page_values=True))))


@register("feature_table", O.both_splits_sql(["base", "behavioral", "research", "temporal"]))
def q_feature_table(spark, sf_dir):
    ws = _ws(spark, sf_dir)
    return round_doubles(both_splits(ws.features))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLE)


# query modules register themselves on import
from sessionlab.plans import prep_queries, eval_queries, model_queries, linear_queries, io_queries  # noqa: E402,F401
