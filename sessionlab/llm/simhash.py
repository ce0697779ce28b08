"""SimHash near-dedup: fingerprints, exact links by tiled comparison, classes.

Links are sought among distinct fingerprints.  With a radius of d bits the 64
bits are cut into d + 1 bands: two linked fingerprints are equal in one band
at least, so each is compared only inside its d + 1 band buckets.  A bucket
beyond one tile is cut into tiles by the population counts of the other
bands (and by a hash where one count still holds too many); pairs of tiles
whose counts differ by more than d are skipped, all others are compared
exactly with numpy exclusive-or and bit counts.  Nothing is capped: a hot
bucket only becomes more tile pairs, spread over tasks.

Each task reduces its links to a spanning forest before they leave it, and
classes come from alternating large-star / small-star rounds on DataFrames,
each written to the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlab.llm.common import col, free_names, key, keyed_text, shuffle_partitions, slices, unkey
from sessionlab.sources.store import stage

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
TILE = 1024


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    # bytes.split() without arguments cuts at exactly \x20 and \x09-\x0D
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[:len(words) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist())], dtype="<u8")
    # counts of each bit, in blocks so that the unpacked bits stay small
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 4096):
        part = h[i:i + 4096].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int, seed: int):
    for part in slices(batches, 1 << 22):
        fps = np.array([fingerprint(t, shingle, seed) for t in part.column("text").to_pylist()], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([part.column("k"), part.column("v"), pa.array(fps.view(np.int64))],
                                         names=["k", "v", "fp"])


def fingerprints(docs: DataFrame, id_col="doc_id", text_col="text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(k, v, fp) per document: id, a hash of the text, and the unsigned bits
    in a signed long."""
    return keyed_text(docs, id_col, text_col).withColumn("v", F.xxhash64("text")).mapInArrow(
        lambda it: _fingerprints(it, shingle, seed), "k long, v long, fp long")


# ------------------------------------------------------------------- links

def bands(radius: int) -> list[int]:
    """Masks of radius + 1 runs of bits that together are all 64."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _roots(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Smallest member of each component, by label propagation with jumps."""
    lab = np.arange(n)
    while True:
        low = np.minimum(lab[u], lab[v])
        new = lab.copy()
        np.minimum.at(new, lab[u], low)
        np.minimum.at(new, lab[v], low)
        new = new[new]
        new = new[new]
        if np.array_equal(new, lab):
            return lab
        lab = new


def _compare(cell: np.ndarray, side: np.ndarray, fp: np.ndarray, radius: int):
    """Links inside each cell.  Rows come sorted by (cell, side).  Cells of
    few rows are compared together, row against the d-th next; larger ones
    as tiles of TILE x TILE."""
    starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(cell)])))
    us, vs = [], []
    small = np.repeat(sizes <= 32, sizes)
    idx = np.flatnonzero(small)
    for d in range(1, int(sizes[sizes <= 32].max(initial=1))):
        a, b = idx[:-d], idx[d:]
        ok = (cell[a] == cell[b]) & ((side[a] == 2) | (side[a] != side[b]))
        a, b = a[ok], b[ok]
        near = np.bitwise_count(fp[a] ^ fp[b]) <= radius
        us.append(a[near])
        vs.append(b[near])
    for s, n in zip(starts[sizes > 32], sizes[sizes > 32]):
        cross = side[s] != 2
        left = np.arange(s, s + n)
        right = left
        if cross:
            left, right = left[side[left] == 0], right[side[right] == 1]
        for i in range(0, len(left), TILE):
            x = left[i:i + TILE]
            for j in range(0 if cross else i, len(right), TILE):
                y = right[j:j + TILE]
                p, q = np.nonzero(np.bitwise_count(fp[x][:, None] ^ fp[y][None, :]) <= radius)
                if len(p):
                    # a tile's links are reduced at once: they may be TILE squared
                    both = np.concatenate((x, y))
                    r = _roots(p, q + len(x), len(both))
                    k = np.flatnonzero(r != np.arange(len(both)))
                    us.append(both[k])
                    vs.append(both[r[k]])
    if not us:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(us), np.concatenate(vs)


def _links(batches: Iterator[pa.RecordBatch], radius: int):
    batches = list(batches)
    if not sum(b.num_rows for b in batches):
        return
    table = pa.Table.from_batches(batches)
    cell, side, fp = (table.column(c).to_numpy() for c in ("cell", "side", "fp"))
    order = np.lexsort((side, cell))
    cell, side, fp = cell[order], side[order], fp[order]
    u, v = _compare(cell, side, fp.view(np.uint64), radius)
    # a forest over the task's fingerprints, each named once
    names, at = np.unique(fp, return_inverse=True)
    root = _roots(at[u], at[v], len(names))
    k = np.flatnonzero(root != np.arange(len(names)))
    yield pa.RecordBatch.from_arrays([pa.array(names[k]), pa.array(names[root[k]])], names=["u", "v"])


def links(fps: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """(u, v) pairs that connect exactly the fingerprints within ``radius``
    bits of each other, directly or over others.  ``fps`` has distinct fp."""
    spark = fps.sparkSession
    masks = [_signed(m) for m in bands(radius)]
    fp = F.col("fp")

    def pops(own):
        return F.array(*[F.bit_count(fp.bitwiseAND(F.lit(m))).cast("int") for i, m in enumerate(masks) if i != own])

    rows = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("band"), fp.bitwiseAND(F.lit(m)).alias("part"), pops(i).alias("pop"))
        for i, m in enumerate(masks)])).alias("r")).select("fp", "r.*")
    counts = rows.groupBy("band", "part", "pop").agg(F.count("*").alias("n"))
    totals = counts.groupBy("band", "part").agg(F.sum("n").alias("total"))
    # buckets beyond one tile: tiles by population counts, hashed further if need be
    hot = (counts.join(totals.where(F.col("total") > tile), ["band", "part"])
           .select("band", "part", "pop", F.ceil(F.col("n") / tile).cast("int").alias("salts")))
    hot = stage(hot, "simhash_hot")
    tiles = hot.select("band", "part", "pop",
                       F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    a = tiles.select("band", "part", F.col("pop").alias("pa"), F.col("salt").alias("sa"))
    b = tiles.select("band", "part", F.col("pop").alias("pb"), F.col("salt").alias("sb"))
    gap = reduce(lambda x, y: x + y, [F.abs(F.col("pa")[i] - F.col("pb")[i]) for i in range(radius)], F.lit(0))
    before = F.struct("pa", "sa") <= F.struct("pb", "sb")
    pairs = (a.join(b, ["band", "part"]).where(before & (gap <= radius))
             .withColumn("cell", F.xxhash64("band", "part", "pa", "sa", "pb", "sb")))
    same = (F.col("pa") == F.col("pb")) & (F.col("sa") == F.col("sb"))
    sides = pairs.select(
        "band", "part", "cell",
        F.explode(F.when(same, F.array(F.struct(F.col("pa").alias("pop"), F.col("sa").alias("salt"), F.lit(2).alias("side"))))
                  .otherwise(F.array(F.struct(F.col("pa").alias("pop"), F.col("sa").alias("salt"), F.lit(0).alias("side")),
                                     F.struct(F.col("pb").alias("pop"), F.col("sb").alias("salt"), F.lit(1).alias("side"))))
                  ).alias("s")).select("band", "part", "cell", "s.*")
    hot_rows = (rows.join(hot, ["band", "part", "pop"])
                .withColumn("salt", F.pmod(F.xxhash64("fp"), F.col("salts")).cast("int"))
                .join(sides, ["band", "part", "pop", "salt"])
                .select("cell", "side", "fp"))
    cold_rows = (rows.join(totals.where((F.col("total") > 1) & (F.col("total") <= tile)), ["band", "part"])
                 .select(F.xxhash64("band", "part").alias("cell"), F.lit(2).alias("side"), "fp"))
    return (hot_rows.unionByName(cold_rows)
            .repartition(shuffle_partitions(spark), "cell")
            .mapInArrow(lambda it: _links(it, radius), "u long, v long"))


# ----------------------------------------------------------------- classes

def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for nodes that have edges.

    Alternating large-star and small-star (Kiveris et al.): a node points its
    larger, then its smaller neighbours at the smallest one it knows, until
    nothing changes: O(log^2 n) rounds, and stars only at the end.  Neighbour
    minima are partial aggregates, so a node of any degree is no hot task.
    """
    def stars(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if not large:
            both = both.where("v < u")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        j = both.join(low, "u")
        if large:
            out = j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = j.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    def state(e: DataFrame):
        r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    e = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(),
              "simhash_edges")
    seen = state(e)
    while seen[0]:
        e = stage(stars(stars(e, True), False), "simhash_stars")
        now = state(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_dedup(docs: DataFrame, id_col="doc_id", text_col="text", shingle: int = 3, radius: int = 2,
               seed: int = 42, tile: int = TILE) -> DataFrame:
    """(k, v, doc_id, fingerprint, component_id, component, root) per row of
    ``docs``; ``root``, the class's smallest fingerprint, tells classes apart.

    Null and empty texts and texts of white space have fingerprint zero and
    link like any other; a null id stays null and names a class only if no
    numbered document is in it (null then); repeated rows come back each;
    an empty table gives no rows; other columns are not read.
    """
    fps = stage(fingerprints(docs, id_col, text_col, shingle, seed), "simhash_fps")
    distinct = stage(fps.groupBy("fp").agg(F.min("k").alias("k")), "simhash_distinct")
    comp = components(links(distinct.select("fp"), radius, tile))
    roots = distinct.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = roots.groupBy("root").agg(F.min("k").alias("component"))
    classes = roots.join(least, "root").select("fp", "component", "root")
    return fps.join(classes, "fp").select(
        "k", "v", unkey(F.col("k")).alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        unkey(F.col("component")).alias("component_id"), "component", "root")


def representatives(docs: DataFrame, id_col="doc_id", text_col="text", **how) -> DataFrame:
    """Rows of ``docs`` (all columns, whatever their names), one of each class:
    that of the smallest id; of several such rows that of the smallest text
    hash, once.

    A class whose documents all lack an id keeps one of them; null and empty
    texts are one class; repeated rows stay once; an empty table stays empty.
    """
    found = near_dedup(docs, id_col, text_col, **how)
    # by root: classes without an id, or with one id, share their component
    own = free_names(docs, 2)
    chosen = (found.where("k = component").groupBy("root", "k").agg(F.min("v").alias("v"))
              .select(F.col("k").alias(own[0]), F.col("v").alias(own[1])))
    text = F.coalesce(col(docs, text_col).cast("string"), F.lit(""))
    rows = docs.withColumn(own[0], key(docs, id_col)).withColumn(own[1], F.xxhash64(text))
    return rows.join(chosen, own, "left_semi").dropDuplicates(own).drop(*own)
