"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are normalised (letters lower-case, everything but letters and digits
one space).  A probe is any ``window`` characters of a benchmark item, from
every place of it (a shorter item is one probe).  A place of a document that
equals a probe but for e edits shares at least len + 1 - q (e + 1) of its
q-grams, and they lie on at most e + 1 neighbouring diagonals.  So q-gram hits
of whole items are counted in diagonal bands that are e wider than their
step, hence overlap enough that one band holds all of them; probes that reach
the bound within a band are verified by banded alignment (free ends in the
text).  The costs of probes that start d apart differ by at most d, so most of
a run of probes is decided by the alignments of a few.  q is at most ``Q`` and
small enough that the bound is positive: items too short for an edit are
matched exactly.

Documents are never shuffled: items go to the tasks, at most ``BLOCK_BYTES``
of them at a time (further blocks are further passes).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlab.llm.common import col, judged, keyed_text, slices, unkey, utf8

WINDOW, ERROR, Q = 80, 0.1, 8
BLOCK_BYTES = 2 << 20
_BITS = 20
#: Rows of one numpy pass (a document's number has 14 bits in a key).
_ROWS = 1 << 14

_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[128:] = np.arange(128, 256)


def normalised(raw: np.ndarray, offsets: np.ndarray):
    """Normalised bytes, the place of each in ``raw``, and document offsets."""
    c = _FOLD[raw]
    if len(c) > 1:                                   # capitals of Latin-1
        up = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)) + 1
        c[up] += 0x20
    space = c == 32
    keep = np.ones(len(c), dtype=bool)
    keep[1:] = ~(space[1:] & space[:-1])
    inner = offsets[(offsets > 0) & (offsets < len(c))]
    keep[inner] = True                               # a document keeps its first byte
    place = np.flatnonzero(keep)
    return c[place], place, np.searchsorted(place, offsets)


def codes(c: np.ndarray, q: int) -> np.ndarray:
    """The q (at most 8) bytes from each place as one integer, by doubling."""
    n = len(c) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    powers, size = {1: c.astype(np.uint64)}, 1
    while size * 2 <= q:
        h = powers[size]
        powers[size * 2] = h[:-size] << np.uint64(8 * size) | h[size:]
        size *= 2
    out, have = powers[size][:n], size
    while have < q:
        size = 1 << ((q - have).bit_length() - 1)
        out = out << np.uint64(8 * size) | powers[size][have:have + n]
        have += size
    return out


def _slot(x: np.ndarray) -> np.ndarray:
    return (x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITS)


@dataclass
class Table:
    """The q-grams, for one q, of the items that need it."""
    q: int
    step: int                    # step of the diagonal bands
    shift: int                   # added to diagonals, which may start before a text
    grams: np.ndarray            # sorted distinct codes
    begin: np.ndarray            # occurrences of each code ...
    probe: np.ndarray            # ... by item
    offset: np.ndarray           # ... and place in it
    bitmap: np.ndarray


@dataclass
class Probes:
    """One block of items; a probe is ``size`` characters from any place."""
    item: np.ndarray             # item id of each text
    text: list                   # normalised bytes of each item
    size: np.ndarray             # characters of its probes
    edits: np.ndarray
    bound: np.ndarray            # q-grams a place must share
    tables: list


def build_probes(items: list[tuple[int, bytes]], window: int = WINDOW, error: float = ERROR, q: int = Q) -> Probes:
    owner, text = [], []
    for item, raw in items:
        c, _, _ = normalised(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        c = c.tobytes().strip()
        if c:
            owner.append(item)
            text.append(c)
    size = np.minimum(np.array([len(t) for t in text], dtype=np.int64), window)
    edits = (size * error).astype(np.int64)
    # the bound must stay positive, else the lemma tells nothing
    grams = np.clip(size // (edits + 1), 1, q)
    bound = np.maximum(size + 1 - grams * (edits + 1), 1)
    tables = [_table(text, np.flatnonzero(grams == n), edits, int(n)) for n in np.unique(grams)]
    return Probes(np.array(owner, dtype=np.int64), text, size, edits, bound, tables)


def _table(text: list, members: np.ndarray, edits: np.ndarray, q: int) -> Table:
    parts = [codes(np.frombuffer(text[i], np.uint8), q) for i in members]
    every = np.concatenate(parts)
    probe = np.repeat(members, [len(p) for p in parts])
    offset = np.concatenate([np.arange(len(p)) for p in parts])
    order = np.argsort(every, kind="stable")
    grams, begin = np.unique(every[order], return_index=True)
    bitmap = np.zeros(1 << _BITS, dtype=bool)
    bitmap[_slot(grams)] = True
    step = max(1, int(edits[members].max()))
    return Table(q, step, max(map(len, parts)) + 2 * step, grams, np.append(begin, len(every)),
                 probe[order], offset[order], bitmap)


def align(probe: np.ndarray, region: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Banded edit distance of equal-length probes (rows) to regions whose
    column j of probe row i is text j + i; start and end in the text are
    free.  Returns distance, first and last + 1 column in the region."""
    n, m = probe.shape
    big = 1 << 14
    cost = np.zeros((n, width), dtype=np.int32)
    begin = np.tile(np.arange(width, dtype=np.int32), (n, 1))   # diagonal of the start
    steps = np.arange(width, dtype=np.int32)
    for i in range(m):
        # cell (i, j) stands for text position i + j; its upper neighbour in
        # the same text position is column j + 1 of the row before
        change = cost + (region[:, i:i + width] != probe[:, i:i + 1])
        down = np.full_like(cost, big)
        down[:, :-1] = cost[:, 1:] + 1
        use = down < change
        new = np.where(use, down, change)
        from_ = np.where(use, np.concatenate((begin[:, 1:], begin[:, -1:]), axis=1), begin)
        # insertions run along the row: smallest of new[j'] + (j - j')
        tagged = (new - steps) * 1024 + steps[::-1]    # ties: the nearest source
        run = np.minimum.accumulate(tagged, axis=1)
        source = (width - 1) - run % 1024
        cost = run // 1024 + steps
        begin = np.take_along_axis(from_, source, axis=1)
    end = cost.argmin(axis=1)
    rows = np.arange(n)
    return cost[rows, end], begin[rows, end], end + m


def _runs(key: np.ndarray, off: np.ndarray, p: Probes, q: int, probe: np.ndarray):
    """(row of the first hit of its band, row of a hit in it, start in the
    item) of every probe that holds the bound's number of q-grams.  Hits come
    sorted by (key, off)."""
    need = p.bound[probe]
    last = np.arange(len(key)) + need - 1
    ok = last < len(key)
    first, last = np.flatnonzero(ok), last[ok]
    ok = (key[first] == key[last]) & (off[last] - off[first] <= p.size[probe[first]] - q)
    first, last = first[ok], last[ok]
    if not len(first):
        return (np.zeros(0, np.int64),) * 3
    top = np.array([len(t) for t in p.text], dtype=np.int64)[probe[first]] - p.size[probe[first]]
    low = np.maximum(off[last] - (p.size[probe[first]] - q), 0)
    high = np.minimum(off[first], top)
    # both ends only grow within a band: each probe once
    same = np.concatenate(([False], key[first[1:]] == key[first[:-1]]))
    low[same] = np.maximum(low[same], high[np.flatnonzero(same) - 1] + 1)
    n = np.maximum(high - low + 1, 0)
    start = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
    group = np.searchsorted(key, key[first], side="left")
    return np.repeat(group, n), np.repeat(first, n), start


def _settle(group: np.ndarray, start: np.ndarray, edits: np.ndarray, equal: np.ndarray, cost_of):
    """Probes within their edits, as (rows, cost, known); other rows than
    known ones (equal or aligned) have an upper bound of their cost.  Each
    group's fewest edits and its first and last probe found are known.  Rows
    come sorted by (group, start)."""
    n = len(group)
    big = np.int64(1 << 40)
    new = np.concatenate(([True], group[1:] != group[:-1]))
    g = np.cumsum(new) - 1
    rank = np.arange(n) - np.flatnonzero(new)[g]
    short = np.bincount(g)[g] <= 32
    cost = np.where(equal, 0, big)
    todo = np.zeros(n, dtype=bool)
    rows = np.arange(n)
    for stride in (64, 16, 4, 1, 0):
        at = np.flatnonzero(todo)
        if len(at):
            cost[at] = cost_of(at)
        done = cost < big
        # the nearest known probes on both sides
        before = np.maximum.accumulate(np.where(done, rows, 0))
        after = np.minimum.accumulate(np.where(done, rows, n - 1)[::-1])[::-1]
        lower, upper = np.zeros(n, np.int64), np.full(n, big)
        for near in (before, after):
            ok = done[near] & (g[near] == g)
            gap = np.abs(start - start[near])
            lower = np.where(ok, np.maximum(lower, cost[near] - gap), lower)
            upper = np.where(ok, np.minimum(upper, cost[near] + gap), upper)
        best = np.full(g[-1] + 1, big)
        np.minimum.at(best, g, cost)
        if stride:
            open_ = ~done & (lower <= edits) & ((upper > edits) | (lower < best[g]))
            todo = open_ & (rank % stride == np.where(short, 0, stride // 2))
    found = np.flatnonzero(upper <= edits)
    edge = np.ones(len(found), dtype=bool)
    edge[1:-1] = (g[found[1:-1]] != g[found[:-2]]) | (g[found[1:-1]] != g[found[2:]])
    rest = found[edge & (cost[found] == big)]
    if len(rest):
        cost[rest] = cost_of(rest)
    return found, np.minimum(cost[found], upper[found]), cost[found] < big


def matches(raw: np.ndarray, offsets: np.ndarray, p: Probes):
    """(document, item's number, probe's start, edits, start, end) of the
    probes found, with places in ``raw`` bytes; where a probe needed no
    alignment, start is the largest number and end -1."""
    c, place, at = normalised(raw, offsets)
    out = [_matches(c, place, at, p, t) for t in p.tables]
    return np.concatenate(out) if out else np.zeros((0, 6), np.int64)


def _matches(c: np.ndarray, place: np.ndarray, at: np.ndarray, p: Probes, t: Table):
    none = np.zeros((0, 6), np.int64)
    x = codes(c, t.q)
    if not len(x):
        return none
    hit = np.flatnonzero(t.bitmap[_slot(x)])
    i = np.searchsorted(t.grams, x[hit])
    i[i == len(t.grams)] = 0
    true = t.grams[i] == x[hit]
    hit, i = hit[true], i[true]
    doc = np.searchsorted(at, hit, side="right") - 1
    inside = hit + t.q <= at[doc + 1]
    hit, i, doc = hit[inside], i[inside], doc[inside]
    if not len(hit):
        return none
    counts = t.begin[i + 1] - t.begin[i]
    flat = np.arange(counts.sum()) + np.repeat(t.begin[i] - (np.cumsum(counts) - counts), counts)
    probe = t.probe[flat]
    off = t.offset[flat]
    diagonal = np.repeat(hit, counts) - off
    band = (diagonal + t.shift) // t.step
    # one integer per hit and band: document, item, band; a band is two steps
    # wide (at least step + edits diagonals) and starts every step
    key = (np.repeat(doc.astype(np.uint64), counts) << np.uint64(49) | probe.astype(np.uint64) << np.uint64(28)
           | band.astype(np.uint64))
    key = np.concatenate((key, key - np.uint64(1)))
    order = np.sort(key)
    new = np.flatnonzero(np.concatenate(([True], order[1:] != order[:-1])))
    n = np.diff(np.append(new, len(order)))
    good = order[new]
    good = good[n >= p.bound[_item(good)]]
    if not len(good):
        return none
    # only hits of bands that reach the bound are put in the item's order
    j = np.minimum(np.searchsorted(good, key), len(good) - 1)
    kept = np.flatnonzero(good[j] == key)
    key, off, diagonal = key[kept], off[kept % len(off)], diagonal[kept % len(off)]
    order = np.lexsort((off, key))
    key, off = key[order], off[order]
    diagonal = diagonal[order]
    # a place's hits lie within step + 1 of the band's diagonals
    above = (diagonal + t.shift) - (key & np.uint64((1 << 28) - 1)).astype(np.int64) * t.step
    runs = []
    for j in range(t.step):
        own = np.flatnonzero((above >= j) & (above <= j + t.step))
        first, hits, start = _runs(key[own], off[own], p, t.q, _item(key[own]))
        runs.append(np.column_stack((np.searchsorted(key, key[own[first]]), start, own[hits])))
    runs = np.concatenate(runs)
    if not len(runs):
        return none
    runs = runs[np.lexsort(runs.T[::-1])]
    runs = runs[np.concatenate(([True], (runs[1:, :2] != runs[:-1, :2]).any(axis=1)))]
    group, start, within = runs.T
    pr = _item(key[group])
    d = (key[group] >> np.uint64(49)).astype(np.int64)
    low = (key[group] & np.uint64((1 << 28) - 1)).astype(np.int64) * t.step - t.shift   # first diagonal of the band
    width = 2 * t.step                                 # edits stay within the step + 1 diagonals
    a, z = np.full(len(group), np.iinfo(np.int64).max), np.full(len(group), -1)
    # probes that equal the text on a hit's diagonal need no alignment
    left = diagonal[within] + start
    equal = (left >= at[d]) & (left + p.size[pr] <= at[d + 1])
    body = np.frombuffer(b"".join(p.text), np.uint8)
    base = np.cumsum([0] + [len(x) for x in p.text])
    for size in np.unique(p.size[pr]):
        own = np.flatnonzero(equal & (p.size[pr] == size))
        for s in range(0, len(own), 1 << 15):
            w, reach = own[s:s + (1 << 15)], np.arange(size)
            equal[w] = (c[left[w][:, None] + reach] == body[(base[pr[w]] + start[w])[:, None] + reach]).all(axis=1)
    a[equal], z[equal] = place[left[equal]], place[left[equal] + p.size[pr[equal]] - 1] + 1

    def cost_of(rows):
        costs = np.zeros(len(rows), np.int64)
        for size in np.unique(p.size[pr[rows]]):
            own = np.flatnonzero(p.size[pr[rows]] == size)
            for s in range(0, len(own), 4096):
                o = own[s:s + 4096]
                w = rows[o]
                left = low[w] + start[w]
                idx = left[:, None] + np.arange(width + size)[None, :]
                valid = (idx >= at[d[w]][:, None]) & (idx < at[d[w] + 1][:, None])
                region = np.where(valid, c[np.clip(idx, 0, len(c) - 1)], 0).astype(np.uint8)
                pattern = np.frombuffer(b"".join(p.text[k][b:b + size] for k, b in zip(pr[w], start[w])),
                                        np.uint8).reshape(len(w), size)
                costs[o], first, last = align(pattern, region, width)
                f = np.clip(left + first, at[d[w]], at[d[w] + 1] - 1)
                e = np.clip(left + last, f + 1, at[d[w] + 1])
                a[w], z[w] = place[f], place[e - 1] + 1
        return costs

    found, cost, known = _settle(group, start, p.edits[pr], equal, cost_of)
    a, z = np.where(known, a[found], np.iinfo(np.int64).max), np.where(known, z[found], -1)
    return np.column_stack((d[found], pr[found], start[found], cost, a, z))


def _item(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(28) & np.uint64((1 << 21) - 1)).astype(np.int64)


def blocks(items: DataFrame, id_col="item_id", text_col="text", block_bytes: int = BLOCK_BYTES, **how) -> Iterator[Probes]:
    """Probes of all items, in blocks of bounded size (items without text or
    id give none)."""
    rows = items.select(col(items, id_col).cast("long").alias("i"), col(items, text_col).cast("string").alias("t")).where(
        "i is not null and t is not null").distinct()
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for b in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("t"), F.lit(n)) == b)
        got = sorted((r.i, r.t.encode("utf-8")) for r in part.collect())
        if got:
            yield build_probes(got, **how)


_FOUND = "k long, item_id long, edits int, probes int, start long, end long"


def _find(batches: Iterator[pa.RecordBatch], p: Probes):
    names = [x.split()[0] for x in _FOUND.split(", ")]
    for part in slices(batches, 1 << 20, rows=_ROWS):
        raw, at = utf8(part.column("text"))
        m = matches(raw, at, p)
        if not len(m):
            continue
        doc, item = m[:, 0], p.item[m[:, 1]]
        pair, inverse = np.unique(np.column_stack((doc, item)), axis=0, return_inverse=True)
        inverse = inverse.reshape(-1)
        edits = np.full(len(pair), 1 << 30)
        start, end = np.full(len(pair), np.iinfo(np.int64).max), np.zeros(len(pair), np.int64)
        np.minimum.at(edits, inverse, m[:, 3])
        np.minimum.at(start, inverse, m[:, 4])
        np.maximum.at(end, inverse, m[:, 5])
        start, end = start - at[pair[:, 0]], end - at[pair[:, 0]]
        once = np.unique(np.column_stack((inverse, m[:, 1:3])), axis=0)[:, 0]
        probes = np.bincount(once, minlength=len(pair))
        cols = (part.column("k").to_numpy()[pair[:, 0]], pair[:, 1], edits.astype(np.int32), probes.astype(np.int32), start, end)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=names)


def contaminated(docs: DataFrame, items: DataFrame, id_col="doc_id", text_col="text", item_id_col="item_id",
                 item_text_col="text", window: int = WINDOW, error: float = ERROR) -> DataFrame:
    """(doc_id, item_id, edits, probes, start, end): each document and item
    that share a probe but for ``error`` of its length in edits; the fewest
    edits, the number of the item's probes found (one starts at each of its
    places), and the span in the text's bytes from the first to the last.

    Null and empty texts and items match nothing; a null document id stays
    null; repeated rows come back each; items with one id are one item; an
    empty table gives no rows; texts are read whole, other columns not.
    """
    rows = keyed_text(docs, id_col, text_col)
    found = [rows.mapInArrow(lambda it, p=p: _find(it, p), _FOUND)
             for p in blocks(items, item_id_col, item_text_col, window=window, error=error)]
    if not found:
        found = [rows.limit(0).select("k", *[F.lit(None).cast(x.split()[1]).alias(x.split()[0])
                                             for x in _FOUND.split(", ")[1:]])]
    one = reduce(DataFrame.unionByName, found)
    return one.select(unkey(F.col("k")).alias("doc_id"), "item_id", "edits", "probes", "start", "end")


def clean(docs: DataFrame, items: DataFrame, text_col="text", item_id_col="item_id", item_text_col="text",
          window: int = WINDOW, error: float = ERROR) -> DataFrame:
    """Rows of ``docs`` (all columns) whose text matches no item; a row
    travels with its verdict, so nothing is joined or shuffled."""
    at = docs.columns.index(text_col)

    def good(probe, p):
        bad = np.zeros(probe.num_rows, dtype=bool)
        for found in _find([probe], p):
            bad[found.column("k").to_numpy()] = True
        return ~bad

    schema = T.StructType(docs.schema.fields)
    for p in blocks(items, item_id_col, item_text_col, window=window, error=error):
        docs = docs.mapInArrow(lambda it, p=p: judged(it, at, 1 << 20, lambda probe: good(probe, p)), schema)
    return docs
