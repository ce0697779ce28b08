"""Physical-plan inspection helpers (used by the plan-shape tests)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def plan_string(df: DataFrame, mode: str = "simple") -> str:
    """The plan text as ``df.explain(mode)`` prints it; after an action it is
    the final adaptive plan."""
    jvm = df.sparkSession.sparkContext._jvm
    text = jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
    # an executed adaptive plan also prints its initial plan: keep the final one
    return text.split("== Initial Plan ==")[0]


def count(plan: str, token: str) -> int:
    return plan.count(token)
