"""Global row index in a total order without a single-partition window.

``row_number() over (order by ...)`` with no partition moves every row into
one task.  Instead the order key alone is range-partitioned and sorted, and
rows are numbered where they lie: ``monotonically_increasing_id`` holds the
partition and the place within it, so no window and no second exchange is
needed.  The numbered keys are written once (range bounds are sampled and
must not be taken twice); one count per partition is summed up in partition
order and joined back, a table as long as the number of partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.sources.store import stage

# monotonically_increasing_id: partition number in the upper bits.
_PLACE_BITS = 33


def global_row_index(keys: DataFrame, order_cols: list[str | Column], out_col: str = "row_index",
                     partitions: int | None = None) -> DataFrame:
    """``keys`` with a 0-based index of every row in ``order_cols`` order.

    Every column of ``keys`` goes through the range exchange: pass the order
    key and an identifier, and join the index to wide rows by the identifier.
    Rows equal in the whole order key get consecutive indexes in no
    particular order.  An empty frame gives an empty frame."""
    n = partitions or int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stage(keys.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
                   .withColumn("_at", F.monotonically_increasing_id()), "row_index")
    part = F.shiftright("_at", _PLACE_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0))
                                      - F.shiftleft(F.col("_part"), _PLACE_BITS)).alias("_shift"))
    # one row per range partition, whatever the table holds
    return (placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(out_col, F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift"))
