"""Hand-derived golden sessions (FIXTURES.md section 3), one assertion per value."""
import datetime as dt

import pytest

from sessionlab.operators.features import build_features
from sessionlab.operators.rates import fit_rates
from sessionlab.schema import CLICK_SCHEMA

ROWS = [
    ("S1", "U1", "2024-01-15 10:00:00", "VIEW", "P1", "C1", 100.0),
    ("S1", "U1", "2024-01-15 10:00:05", "ADD_CART", "P1", "C1", 100.0),
    ("S1", "U1", "2024-01-15 10:06:45", "BUY", "P1", "C1", 100.0),
    ("S2", "U2", "2024-01-06 22:00:00", "VIEW", "P2", "C2", 5.0),
    ("S3", "U3", "2024-01-15 23:50:00", "ADD_CART", "P3", "C1", 60.0),
    ("S3", "U3", "2024-01-15 23:55:00", "REMOVE_CART", "P3", "C1", 60.0),
    ("S3", "U3", "2024-01-16 00:30:00", "ADD_CART", "P4", "C2", 60.0),
    ("S3", "U3", "2024-01-16 02:00:00", "BUY", "P4", "C2", 60.0),
    ("S3", "U3", "2024-01-16 02:00:00", "VIEW", "P5", "C3", 60.0),
]

GOLDEN = {
    "total_events": (3, 1, 5), "unique_products": (1, 1, 3), "unique_categories": (1, 1, 3),
    "buy_count": (1, 0, 1), "addcart_count": (1, 0, 2), "view_count": (1, 1, 1), "remove_count": (0, 0, 1),
    "last_event_buy": (1, 0, 0), "last_event_view": (0, 1, 1),
    "first_event_view": (1, 1, 0), "first_event_addcart": (0, 0, 1),
    "duration_minutes": (6.75, 0, 130), "events_per_minute": (0.444444, 100, 0.038462),
    "has_buy_end": (1, 0, 0), "has_addcart_buy_pattern": (1, 0, 1), "has_view_buy_pattern": (0, 0, 0),
    "indecision_count": (0, 0, 1), "product_revisits": (2, 0, 2), "category_changes": (0, 0, 2),
    "max_time_gap": (400, 0, 5400), "std_time_between_events": (279.307179, 0, 2479.919354),
    "has_long_pause": (1, 0, 1), "has_quick_actions": (1, 0, 1),
    "is_focused_shopper": (1, 0, 0), "is_comparison_shopper": (0, 0, 0), "is_explorer": (0, 0, 1),
    "cart_conversion_rate": (1, 0, 0.5), "revisit_ratio": (2, 0, 0.666667),
    "decisiveness_score": (0.333333, 0, 0.4), "is_bounce": (0, 1, 0), "has_immediate_exit": (0, 1, 0),
    "time_per_product": (6.75, 0, 130), "max_product_interactions": (3, 1, 2),
    "exploration_score": (0.666667, 2, 1.2), "category_diversity": (1, 1, 1),
    "has_view_addcart_buy_sequence": (1, 0, 0), "funnel_addcart_to_buy": (1, 0, 0.5),
    "hour": (10, 22, 23), "day_of_week": (0, 5, 0), "day": (15, 6, 15),
    "is_night": (0, 1, 1), "is_evening": (0, 1, 0), "is_morning": (1, 0, 0),
    "is_payday": (1, 0, 1), "is_mid_month": (1, 0, 1), "is_month_start": (0, 0, 0),
    "session_span_hours": (0.1125, 0, 2.166667),
    "crosses_hour_boundary": (0, 0, 1), "crosses_day_boundary": (0, 0, 1),
    "is_quick_session": (0, 1, 0), "is_extended_session": (0, 0, 1),
    "total_category_score": (0.5, 0.5, 1), "max_category_score": (0.5, 0.5, 0.5),
    "avg_category_score": (0.5, 0.5, 0.333333),
    "max_product_score": (1, 0, 1), "avg_product_score": (1, 0, 0.333333),
    "max_engagement": (2.5, 1.5, 2.5), "avg_engagement": (2.5, 1.5, 1.666667),
    "has_high_buy_rate_category": (0, 0, 0), "has_ultra_high_buy_rate_category": (0, 0, 0),
}


@pytest.fixture(scope="module")
def golden(spark):
    rows = [(dt.datetime.fromisoformat(t), et, p, c, u, s, v) for s, u, t, et, p, c, v in ROWS]
    clicks = spark.createDataFrame(rows, CLICK_SCHEMA)
    rates = fit_rates(clicks)
    ft = build_features(clicks, rates=rates, bucket_seconds=1800)
    return {r["user_session"]: r.asDict() for r in ft.collect()}, rates


def test_lookups(golden):
    _, rates = golden
    cr = {r["category_id"]: (r["buy_rate"], r["engagement"]) for r in rates.lookups.category_rates.collect()}
    assert cr == {"C1": (0.5, 2.5), "C2": (0.5, 1.5), "C3": (0.0, 1.0)}
    pr = {r["product_id"]: r["buy_rate"] for r in rates.lookups.product_rates.collect()}
    assert pr == {"P1": 1.0, "P2": 0.0, "P3": 0.0, "P4": 1.0, "P5": 0.0}
    assert rates.high_threshold == pytest.approx(0.5) and rates.ultra_high_threshold == pytest.approx(0.5)


@pytest.mark.parametrize("feature", sorted(GOLDEN))
def test_golden_value(golden, feature):
    ft, _ = golden
    for sess, want in zip(("S1", "S2", "S3"), GOLDEN[feature]):
        assert ft[sess][feature] == pytest.approx(want, abs=1e-6), (sess, feature)


def test_ids_and_target(golden):
    ft, _ = golden
    assert ft["S3"]["user_id"] == "U3" and ft["S3"]["session_value"] == 60.0
    assert len(ft["S1"]) == 85 + 3
