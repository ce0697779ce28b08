"""Data-quality checks: null profile (A8) and train/test feature validation
(E9), each a single aggregate pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Test-side null rate above which a feature is reported (fixed value).
MAX_TEST_NULL_RATE = 0.5


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, position, null_count) for every column, one pass."""
    cols = cols or df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(i).alias("position"),
                                         F.col(f"n{i}").alias("null_count")) for i, c in enumerate(cols)]))
    return counts.select(stack.alias("s")).select("s.column", "s.position", "s.null_count")


def validate_features(train: DataFrame, test: DataFrame, feature_cols: list[str]) -> DataFrame:
    """Per feature whether it exists in test, whether the types agree,
    the test null rate, and ``ok`` (no issue).  Schemas are compared on the
    driver (metadata only); null rates are one aggregate over ``test``."""
    tr_types = {f.name: f.dataType.simpleString() for f in train.schema.fields}
    te_types = {f.name: f.dataType.simpleString() for f in test.schema.fields}
    present = [c for c in feature_cols if c in te_types]
    rates = {}
    if present:
        r = test.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(f"r{i}")
                       for i, c in enumerate(present)]).first()
        rates = {c: r[f"r{i}"] for i, c in enumerate(present)}
    rows = []
    for c in feature_cols:
        in_test = c in te_types
        same = in_test and tr_types.get(c) == te_types.get(c)
        rate = rates.get(c)
        ok = in_test and same and (rate is None or rate <= MAX_TEST_NULL_RATE)
        rows.append((c, in_test, same, rate, ok))
    return train.sparkSession.createDataFrame(
        rows, "feature string, in_test boolean, dtype_match boolean, test_null_rate double, ok boolean")


def require_features(df: DataFrame, feature_cols: list[str]) -> None:
    """Scoring guard: raise when selected features are missing."""
    missing = [c for c in feature_cols if c not in df.columns]
    if missing:
        raise ValueError(f"features missing for scoring: {missing}")
