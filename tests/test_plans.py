"""Plan shape of the main jobs: one full shuffle of the click rows for the
ordered statistics, broadcast lookups, pushed-down split filter, pruned
columns, no Python evaluation, no single-partition exchange."""
import pytest

from sessionlab.operators.features import build_features
from sessionlab.plans.explain import plan_string
from sessionlab.plans.workspace import workspace
from conftest import SF01


@pytest.fixture(scope="module")
def final_plan(spark):
    ws = workspace(spark, SF01)
    ft = build_features(ws.split("train"), rates=ws.rates())
    ft.collect()
    return plan_string(ft)


def _exchanges(plan):
    return [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln and "ReusedExchange" not in ln]


def test_click_rows_are_exchanged_once(spark):
    """With broadcast off: the rows go through one exchange on (session,
    bucket), their states through one on the session, and nothing is joined."""
    from sessionlab.operators.sessions import main_stats
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stats = main_stats(workspace(spark, SF01).split("train"))
        stats.collect()
        plan = plan_string(stats)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rows, states = _exchanges(plan)
    assert sum("_bucket" in ln for ln in (rows, states)) == 1, plan
    assert "Join" not in plan


def test_one_exchange_of_rows_in_the_feature_table(final_plan):
    full = [ln for ln in _exchanges(final_plan) if "user_session" in ln and "_bucket" in ln]
    assert len(full) == 1, full


def test_split_windows_keep_the_partitioning(spark):
    """The summary is joined back by plain equality: the wide rows are not
    shuffled again for the join."""
    from sessionlab.operators.ordered import split_running_sum
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = workspace(spark, SF01).clicks.selectExpr("event_id", "user_id", "event_time", "session_value as wide", "1L as one")
        out = split_running_sum(df, "user_id", ["event_time", "event_id"], "one", "s")
        out.collect()
        plan = plan_string(out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "<=>" not in plan and "isnull(_key" not in plan
    wide = [ln for ln in _exchanges(plan) if "_bucket" in ln]
    assert 1 <= len(wide) <= 3, plan       # the rows, the totals, the totals by key back on (key, bucket)


def test_lookups_are_broadcast(final_plan):
    assert final_plan.count("BroadcastHashJoin") >= 2


def test_split_filter_pushed_and_columns_pruned(final_plan):
    assert "LessThan(event_time,2024-01-24T00:00)" in final_plan
    schemas = [ln.split("ReadSchema: ")[1] for ln in final_plan.splitlines() if "ReadSchema: " in ln]
    # the key-level branch reads only what it needs
    assert any("user_id" not in sc and "session_value" not in sc and "product_id" in sc for sc in schemas), schemas


def test_no_python_and_no_single_partition(final_plan):
    for bad in ("BatchEvalPython", "ArrowEvalPython", "SinglePartition"):
        assert bad not in final_plan


def test_key_levels_share_one_exchange(final_plan):
    lines = [ln for ln in final_plan.splitlines() if "Exchange hashpartitioning(user_session" in ln
             and "ReusedExchange" not in ln]
    grouped = [ln for ln in lines if "spark_grouping_id" in ln]
    assert len(grouped) == 1, lines
    assert not any("product_id" in ln and "spark_grouping_id" not in ln for ln in lines)


def test_adapter_windows_only_over_bucket_aggregates(spark):
    from sessionlab.sources.adapter import load_clicks
    from conftest import SF001
    plan = plan_string(load_clicks(spark, SF001))
    windows = [ln for ln in plan.splitlines() if "Window [" in ln]
    assert windows, plan
    # every window orders buckets of the per-bucket table, never the events
    assert all("windowspecdefinition(user_id" in ln and "_bucket" in ln and "event_id" not in ln
               for ln in windows), windows
    assert "partial_min" in plan                    # per-bucket times pre-aggregated map-side
