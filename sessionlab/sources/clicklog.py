"""Click-log scans (S1-S3) and the test-data entry point.

Reads use an explicit schema (no inference pass over the data).  Time is
parsed once at read; ordering is not materialised here, it lives in the
session states (``operators.sessions``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlab.schema import CLICK_SCHEMA, CLICK_SCHEMA_NO_TARGET, TIME, tie_columns
from sessionlab.sources.adapter import load_clicks

# The CSV contract, for reading and writing: a header; an empty field is a
# missing value, and so is the empty string, quoted or not (as in pandas); a
# quote inside quotes is doubled; white space is kept; times keep microseconds.  A field may hold line breaks only if ``multiline`` is set
# (such files cannot be split between tasks).
CSV_OPTIONS = {"header": True, "nullValue": "", "emptyValue": "", "quote": '"', "escape": '"',
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def csv_reader(spark: SparkSession, multiline: bool = False):
    return spark.read.options(**CSV_OPTIONS).option("multiLine", multiline)


def csv_writer(df: DataFrame, mode: str = "errorifexists"):
    return df.write.mode(mode).options(**CSV_OPTIONS).option("timestampNTZFormat", TIME_FORMAT)


def read_clicks(spark: SparkSession, path: str, fmt: str = "csv", with_target: bool = True,
                time_format: str | None = None, bad_column: str | None = None, multiline: bool = False) -> DataFrame:
    """S1 + S2: read a click log (CSV with header, or parquet) and parse
    ``event_time`` to TIMESTAMP_NTZ.

    A CSV value that is not of its column's type makes the read fail; with
    ``bad_column`` the row stays, the value is null, and that column holds the
    line (for a time: its text), null in good rows."""
    schema = CLICK_SCHEMA if with_target else CLICK_SCHEMA_NO_TARGET
    if fmt != "csv":
        return spark.read.schema(schema).parquet(path)
    fields = [T.StructField(f.name, T.StringType() if f.name == TIME else f.dataType, True) for f in schema.fields]
    reader = csv_reader(spark, multiline).option("mode", "PERMISSIVE" if bad_column else "FAILFAST")
    if bad_column:
        fields.append(T.StructField(bad_column, T.StringType(), True))
        reader = reader.option("columnNameOfCorruptRecord", bad_column)
    raw = reader.schema(T.StructType(fields)).csv(path)
    text = F.col(TIME)
    if time_format:
        parse = F.try_to_timestamp(text, F.lit(time_format)).cast("timestamp_ntz") if bad_column \
            else F.to_timestamp_ntz(text, F.lit(time_format))
    else:
        parse = text.try_cast("timestamp_ntz") if bad_column else text.cast("timestamp_ntz")
    if bad_column:
        raw = raw.withColumn(bad_column, F.coalesce(bad_column, F.when(text.isNotNull() & parse.isNull(), text)))
    return raw.withColumn(TIME, parse)


def write_clicks(df: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """A click log as ``read_clicks`` reads it, columns in the schema's order."""
    out = df.select(*[f.name for f in CLICK_SCHEMA.fields if f.name in df.columns])
    if fmt == "csv":
        csv_writer(out, mode).csv(path)
    else:
        out.write.mode(mode).parquet(path)


def load_raw_data(spark: SparkSession, train_path: str, test_path: str, fmt: str = "csv"
                  ) -> tuple[DataFrame, DataFrame]:
    """(train, test) click logs; test has no target."""
    return read_clicks(spark, train_path, fmt, True), read_clicks(spark, test_path, fmt, False)


def sorted_log(df: DataFrame) -> DataFrame:
    """S3 at a sink: a time-ordered log, rows without a time last, ties by the
    tie columns (a range-partitioned global sort, only when a sorted file is
    asked for)."""
    return df.orderBy(F.col(TIME).asc_nulls_last(), *tie_columns(df))


__all__ = ["CSV_OPTIONS", "csv_reader", "csv_writer", "read_clicks", "write_clicks", "load_raw_data", "sorted_log", "load_clicks"]
