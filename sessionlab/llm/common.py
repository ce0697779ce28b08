"""Helpers shared by the operators of this package."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Documents without an id take the largest key: they never stand for a group
#: that has a numbered member.
NO_ID = 2 ** 63 - 1


def col(df: DataFrame, name: str) -> Column:
    """The column of that exact name (dots and back-ticks are plain letters)."""
    return df["`" + name.replace("`", "``") + "`"]


def key(df: DataFrame, id_col: str) -> Column:
    return F.coalesce(col(df, id_col).cast("long"), F.lit(NO_ID))


def unkey(c: Column) -> Column:
    return F.when(c == NO_ID, None).otherwise(c).cast("long")


def free_names(df: DataFrame, many: int) -> list[str]:
    """Column names that ``df`` does not have in any spelling."""
    taken = {c.lower() for c in df.columns}
    return [n for n in (f"_own{i}" for i in range(many + len(taken))) if n not in taken][:many]


def keyed_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(k, text): only the two needed columns reach the scan, so further
    columns of any name cannot clash.  Null text is the empty text."""
    return docs.select(key(docs, id_col).alias("k"),
                       F.coalesce(col(docs, text_col).cast("string"), F.lit("")).alias("text"))


def shuffle_partitions(spark) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a null-free Arrow string column, without
    a Python object per row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    big = column.cast(pa.large_binary())
    offsets = np.frombuffer(big.buffers()[1], dtype=np.int64)[big.offset: big.offset + len(big) + 1]
    data = big.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


_KEPT: dict = {}


def kept(name, make):
    """What a Python worker keeps for its next tasks; ``slices`` of any other
    operator lets go of it, so that one operator's memory is held at a time."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def slices(batches, max_bytes: int, column: str = "text", rows: int = 1 << 30, keep: bool = False):
    """Cut Arrow batches into runs of whole rows of about ``max_bytes`` of
    text, so that numpy work arrays stay bounded whatever a batch holds (a
    longer row makes a run of its own).  ``keep``: the caller uses ``kept``."""
    if not keep:
        _KEPT.clear()
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.diff(utf8(batch.column(column))[1])
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            stop = min(stop, start + rows)
            yield batch.slice(start, stop - start)
            start = stop


def few(batches, rows: int = 256):
    """Cut Arrow batches into runs of few rows, for work on Python objects."""
    for batch in batches:
        for s in range(0, batch.num_rows, rows):
            yield batch.slice(s, rows)


def judged(batches, at: int, max_bytes: int, judge):
    """The rows of Arrow batches that ``judge`` keeps, cut into runs of about
    ``max_bytes`` of text (column ``at``): only a run is copied at a time.
    ``judge`` takes a run as (k, text) batch, k from 0, and returns booleans."""
    for batch in batches:
        text = batch.column(at).cast(pa.string()).fill_null("")
        rest = 0
        for part in slices([pa.RecordBatch.from_arrays([text], names=["text"])], max_bytes):
            probe = pa.RecordBatch.from_arrays([pa.array(np.arange(part.num_rows)), part.column("text")], names=["k", "text"])
            yield batch.slice(rest, part.num_rows).filter(pa.array(judge(probe), pa.bool_()))
            rest += part.num_rows


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (null ids as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def hashed_sample(rows: DataFrame, label: str, per_class: int, by: tuple[str, ...] = ("k",)) -> DataFrame:
    """At most about ``per_class`` rows of each label, chosen by a hash of the
    columns ``by`` (the same rows on every run): a share of each class as wide
    as the class is rare, then cut to the bound.  Rows equal in ``by`` and
    label are one.  Pass narrow rows; labels are few."""
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    if not counts:
        return rows.limit(0)
    share = F.lit(0)
    for value, n in counts.items():
        share = F.when(F.col(label) == F.lit(value), int(min(1.0, per_class / n) * 1_000_003)).otherwise(share)
    return (rows.withColumn("_h", F.pmod(F.xxhash64(*by), F.lit(1_000_003))).where(F.col("_h") < share)
            .dropDuplicates([*by, label]).orderBy("_h", *by, label).limit(int(per_class * len(counts) * 1.2) + 10).drop("_h"))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))
