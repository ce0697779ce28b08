"""Properties of the feature table on the driver's events (sf0.001)."""
import pytest
from pyspark.sql import functions as F

from sessionlab.functions.exprs import round_doubles
from sessionlab.operators.features import FAMILIES, build_features, feature_names, merge_feature_tables
from sessionlab.operators.rates import fit_rates
from sessionlab.operators.prepare import train_val_split
from sessionlab.plans import oracle as O
from sessionlab.sources.adapter import load_clicks
from conftest import SF001


@pytest.fixture(scope="module")
def clicks(spark):
    return load_clicks(spark, SF001).cache()


@pytest.fixture(scope="module")
def table(clicks):
    train, _ = train_val_split(clicks)
    return build_features(clicks, rates=fit_rates(train)).cache()


def test_names_and_count(spark, table):
    names = feature_names(FAMILIES)
    assert len(names) == 85
    assert names == [n for n, _ in O.feature_exprs(FAMILIES)]
    assert table.columns == ["user_session", "user_id", *names, "session_value"]


def test_one_row_per_session(clicks, table):
    assert table.count() == clicks.select("user_session").distinct().count() == 329


def test_ratios_sum_to_one(table):
    s = F.col("buy_ratio") + F.col("addcart_ratio") + F.col("view_ratio") + F.col("remove_ratio")
    assert table.filter(F.abs(s - 1) > 1e-9).count() == 0


def test_flags_are_binary(table):
    flags = [c for c in table.columns if c.startswith(("is_", "has_", "last_event", "first_event", "crosses_"))]
    bad = table.select(*[F.count_if(~F.col(c).isin(0, 1)).alias(c) for c in flags]).first()
    assert all(v == 0 for v in bad)


def test_revisits_identity(table):
    assert table.filter(F.col("product_revisits") + F.col("unique_products") != F.col("total_events")).count() == 0


@pytest.mark.parametrize("parts,bucket", [(1, 3600.0), (16, 60.0), (3, 1e9)])
def test_invariant_to_partitioning_and_split_width(clicks, table, parts, bucket):
    train, _ = train_val_split(clicks)
    other = build_features(clicks.repartition(parts), rates=fit_rates(train), bucket_seconds=bucket)
    cols = table.columns
    a, b = round_doubles(table.select(cols), 9), round_doubles(other.select(cols), 9)
    assert a.exceptAll(b).count() == 0
    assert other.count() == table.count()


def test_merge_of_family_tables_equals_one_pass(clicks, table):
    train, _ = train_val_split(clicks)
    rates = fit_rates(train)
    parts = [build_features(clicks, [f], rates) for f in FAMILIES]
    merged = merge_feature_tables(parts)
    one = table.select(*merged.columns)
    a, b = round_doubles(merged, 9), round_doubles(one, 9)
    assert sorted(merged.columns) == sorted(table.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_same_features_under_dst_session_zone(spark, clicks, table):
    train, _ = train_val_split(clicks)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        other = build_features(clicks, rates=fit_rates(train)).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    a = round_doubles(table, 9).collect()
    b = spark.createDataFrame(other, table.schema)
    assert round_doubles(b, 9).exceptAll(round_doubles(table, 9)).count() == 0 and len(a) == len(other)


def test_salted_lookup_fallback_equals_broadcast(clicks, table):
    import dataclasses
    from sessionlab.operators.rates import RateModel
    from sessionlab.plans.explain import plan_string
    train, _ = train_val_split(clicks)
    rates = fit_rates(train)
    forced = RateModel(dataclasses.replace(rates.lookups, max_broadcast_rows=0),
                       rates.high_threshold, rates.ultra_high_threshold)
    from sessionlab.operators.sessions import product_stats
    assert "_salt" in plan_string(product_stats(clicks, forced.lookups))
    other = build_features(clicks, rates=forced)
    a, b = round_doubles(table, 9), round_doubles(other.select(table.columns), 9)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
