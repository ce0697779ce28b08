"""Lookup joins against fitted tables with a checked broadcast size.

A fitted rate table has one row per category or product.  Categories are a
small dimension; products may not be.  The table is broadcast only when its
row count (an aggregate over the fitted table, not over the events) is below
``max_broadcast_rows``.  Beyond that the join shuffles: rows per key are
counted, a key of many rows is dealt over as many salts as its count asks for,
and only its table row is repeated.  Rows without a key match nothing and are
spread by a hash of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlab.sources.store import stage

# Rows of a lookup table that may be broadcast to every executor.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000

# Rows of one key that go to one salt.
ROWS_PER_SALT = 1_000_000


def table_rows(table: DataFrame) -> int:
    """Row count of a fitted lookup table (bounded by its key domain)."""
    return table.count()


def salted(df: DataFrame, table: DataFrame, key: str, rows_per_salt: int = ROWS_PER_SALT,
           salt_by: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``: no (key, salt) holds much over
    ``rows_per_salt`` rows of ``df``.  The counted heavy keys are at most
    rows / ``rows_per_salt``, a table far below any broadcast limit."""
    spread = F.xxhash64(salt_by) if salt_by else F.xxhash64(*df.columns)
    heavy = stage(df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
                  .where(F.col("_n") > rows_per_salt)
                  .select(key, F.ceil(F.col("_n") / rows_per_salt).cast("long").alias("_salts")), "heavy_keys")
    salts = F.coalesce("_salts", F.lit(1).cast("long"))
    left = (df.join(F.broadcast(heavy), key, "left")
            .withColumn("_salt", F.when(F.col(key).isNull(), spread).otherwise(F.pmod(spread, salts))).drop("_salts"))
    right = (table.join(F.broadcast(heavy), key, "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("_salts"))
    return left, right


def lookup_join(df: DataFrame, table: DataFrame, key: str, how: str = "left",
                max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                rows_per_salt: int = ROWS_PER_SALT, rows: int | None = None,
                salt_by: str | None = None) -> DataFrame:
    """``df LEFT JOIN table USING (key)`` with table keys unique.

    ``rows`` may pass a known size; ``salt_by`` names a column of ``df``
    that spreads a hot key (defaults to a hash of all columns of ``df``).
    A null key, on either side, matches nothing.
    """
    n = table_rows(table) if rows is None else rows
    if n <= max_broadcast_rows:
        return df.join(F.broadcast(table), key, how)
    left, right = salted(df, table.where(F.col(key).isNotNull()), key, rows_per_salt, salt_by)
    return left.join(right, [key, "_salt"], how).drop("_salt")
