"""Click-log schema and event vocabulary."""

from pyspark.sql import types as T

# The four event types of the click log.
BUY = "BUY"
ADD_CART = "ADD_CART"
REMOVE_CART = "REMOVE_CART"
VIEW = "VIEW"
EVENT_TYPES = (VIEW, ADD_CART, REMOVE_CART, BUY)

SESSION = "user_session"
TIME = "event_time"
TARGET = "session_value"

CLICK_SCHEMA = T.StructType([
    T.StructField("event_time", T.TimestampNTZType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("product_id", T.StringType(), True),
    T.StructField("category_id", T.StringType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("user_session", T.StringType(), True),
    T.StructField("session_value", T.DoubleType(), True),
])

# Scoring input: the same log without the target.
CLICK_SCHEMA_NO_TARGET = T.StructType([f for f in CLICK_SCHEMA.fields if f.name != TARGET])


def tie_columns(df) -> list[str]:
    """Deterministic tie-break after event_time: event_id if present, else the
    remaining identifying columns."""
    if "event_id" in df.columns:
        return ["event_id"]
    return [c for c in ("event_type", "product_id", "category_id", "user_id") if c in df.columns]
