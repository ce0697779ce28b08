"""Suffix-array dedup: removes every byte covered by a ``length``-byte string
that also starts earlier in the corpus (by document id, then by position).

1. Winnowing picks anchors: of the q-gram hashes in each window of one
   ``length``-byte string the smallest, so equal strings choose the same
   anchor at the same place.  A string start belongs to the anchor its window
   chose; a maximal run of starts with one anchor is a *stretch*.
2. Anchors met only once in the corpus are dropped: no string of their
   stretches can repeat.  This only narrows the candidates.
3. The remaining stretches (text of their starts and length - 1 bytes more)
   are dealt out by anchor, so equal strings meet.  Those of a hot anchor, as
   of a line in a large share of all documents, are first cut anew by anchors
   of FINE_GRAM bytes, which the text around the line tells apart.  Equal stretches are
   merged before and after the shuffle.  What is left is cut into shards,
   each gets a suffix array by Larsson-Sadakane refinement (numpy) and
   Kasai's common prefixes; neighbours that share ``length`` bytes are one
   class, whose first start stays.  Shards are merged by binary search of
   one's classes in the other's.
4. Start runs go back to their documents, which lose the covered bytes.

A hot string travels once per map batch, not once per occurrence; only texts
themselves are shuffled whole, compressed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlab.llm.common import col, few, free_names, key, shuffle_partitions, slices, unkey, utf8
from sessionlab.sources.store import stage

LENGTH = 100
GRAM = 20
SHARD_BYTES = 1 << 21
SLICE_BYTES = 1 << 21
BUCKETS_PER_PARTITION = 4
#: An anchor in this many slices of text is hot; at most so many are; bytes of
#: the anchors that its stretches are cut by instead.
HOT_SLICES = 64
HOT_ANCHORS = 100_000
FINE_GRAM = 90

_TABLE = np.random.default_rng(20240131).integers(0, 2 ** 64, 256, dtype=np.uint64)
_M = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB),
      np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)]


# ----------------------------------------------------------------- anchors

def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of the ``gram`` bytes from each position, by doubling."""
    n = len(raw) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    powers = {1: _TABLE[raw]}
    size = 1
    while size * 2 <= gram:
        h = powers[size]
        powers[size * 2] = h[:-size] * _M[size.bit_length() % 5] + h[size:]
        size *= 2
    have, out = size, powers[size]
    while have < gram:
        size = 1 << ((gram - have).bit_length() - 1)
        out = out[:n + gram - have - size] * _M[(have + size) % 5] + powers[size][have:have + n + gram - have - size]
        have += size
    out = out[:n]
    out = (out ^ out >> np.uint64(31)) * _M[1]
    return out ^ out >> np.uint64(29)


def stretches(raw: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(anchor hash, document, first start, starts) of all stretches."""
    window = length - gram + 1
    starts = len(raw) - length + 1
    if starts <= 0:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z
    h = gram_hashes(raw, gram)
    # the smallest of each window, the leftmost of equals: hash above, place below
    low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    size, total = 1, len(low) - window + 1
    while size * 2 <= window:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    low = np.minimum(low[:total], low[window - size:window - size + total])
    anchor = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # starts whose string stays inside its document
    sizes = np.diff(offsets)
    doc = np.repeat(np.arange(len(sizes)), np.maximum(sizes - length + 1, 0))
    if not len(doc):
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z
    counts = np.maximum(sizes - length + 1, 0)
    begin = np.cumsum(counts) - counts
    at = np.arange(len(doc)) - begin[doc] + offsets[:-1][doc]
    anchor = anchor[at]
    new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]))))
    run = np.diff(np.concatenate((new, [len(doc)])))
    d = doc[new]
    return h[anchor[new]], d, at[new] - offsets[:-1][d], run


_NONE = np.zeros(0, np.int64)
_Z = zstandard.ZstdCompressor(level=1)


def _planes(a: np.ndarray) -> bytes:
    """Bytes of an integer column, plane by plane: sorted or small values
    leave planes of zeros."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes()


def _unplanes(b: bytes, kind: str, n: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(width, n).T).reshape(-1).view(kind)


_COLS = (("h", "<u8"), ("k", "<i8"), ("v", "<i8"), ("lo", "<u4"), ("n", "<u4"), ("many", "u1"))


def _pack(h, k, v, lo, n, many) -> bytes:
    order = np.argsort(h, kind="stable")
    cols = [np.diff(h[order], prepend=np.uint64(0)), k[order], v[order], lo[order], n[order], many[order]]
    body = b"".join(_planes(np.ascontiguousarray(c, dtype=t)) for c, (_, t) in zip(cols, _COLS))
    return len(h).to_bytes(4, "little") + _Z.compress(body)


def _unpack(blob: bytes):
    size = int.from_bytes(blob[:4], "little")
    body = zstandard.ZstdDecompressor().decompress(blob[4:])
    out, at = [], 0
    for _, t in _COLS:
        w = np.dtype(t).itemsize * size
        out.append(_unplanes(body[at:at + w], t, size))
        at += w
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def _survey(batches: Iterator[pa.RecordBatch], length: int, gram: int, buckets: int):
    """Stretches of each slice of text by bucket.  A hash seen twice in the
    slice is marked: all its stretches are known to repeat."""
    for part in slices(batches, SLICE_BYTES):
        raw, at = utf8(part.column("text"))
        h, d, lo, n = stretches(raw, at, length, gram)
        if not len(h):
            continue
        k = part.column("k").to_numpy()[d]
        v = part.column("v").to_numpy()[d]
        _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
        many = (counts[inverse] > 1).astype(np.uint8)
        # of a repeated hash one stretch stands for all in the count; the rest
        # go to buckets of their own document, so a hot hash fills no bucket
        first = np.zeros(len(h), dtype=bool)
        first[np.unique(inverse, return_index=True)[1]] = True
        bucket = np.where(first, (h >> np.uint64(8)) % np.uint64(buckets), (k.astype(np.uint64) ^ h) % np.uint64(buckets)).astype(np.int64)
        many = many + 2 * ~first                  # 2: known, not part of the count
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        ids, blobs = [], []
        for g in np.split(order, cuts[1:]):
            ids.append(int(bucket[g[0]]))
            blobs.append(_pack(h[g], k[g], v[g], lo[g], n[g], many[g]))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])


def _repeated(batches: Iterator[pa.RecordBatch], hot_slices: int = HOT_SLICES):
    """Of a partition's buckets: stretches whose hash occurs again, packed by
    document; and, in rows without a document, hashes met in ``hot_slices``
    slices or more, with their number."""
    held: dict[int, list] = {}
    for b in batches:
        for bucket, blob in zip(b.column("bucket").to_pylist(), b.column("blob").to_pylist()):
            held.setdefault(bucket, []).append(blob)
    for bucket in sorted(held):
        h, k, v, lo, n, many = (np.concatenate(c) for c in zip(*map(_unpack, held.pop(bucket))))
        counted = many < 2
        _, inverse, counts = np.unique(h[counted], return_inverse=True, return_counts=True)
        stay = many >= 1
        stay[counted] |= counts[inverse] > 1
        if len(counts) and counts.max() >= hot_slices:
            place = np.unique(inverse, return_index=True)[1]
            often = counts >= hot_slices
            found = np.column_stack((h[counted][place[often]].view(np.int64), counts[often]))
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([None], pa.int64()),
                                              pa.array([found.astype("<i8").tobytes()], pa.binary())], names=["k", "v", "at"])
        at = np.flatnonzero(stay)
        if not len(at):
            continue
        order = at[np.lexsort((h[at], lo[at], v[at], k[at]))]
        # a row that is repeated gives each place once, not once per copy
        again = np.zeros(len(order), dtype=bool)
        again[1:] = np.logical_and.reduce([c[order][1:] == c[order][:-1] for c in (h, k, v, lo)])
        order = order[~again]
        k, v = k[order], v[order]
        cut = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (v[1:] != v[:-1]))))
        out = np.empty(len(order), dtype=_STRETCH)
        out["h"], out["lo"], out["n"] = h[order], lo[order], n[order]
        raw = out.tobytes()
        ends = (np.append(cut[1:], len(order)) * _STRETCH.itemsize).tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(k[cut]), pa.array(v[cut]),
             pa.array([raw[x:y] for x, y in zip([0, *ends[:-1]], ends)], pa.binary())], names=["k", "v", "at"])


_STRETCH = np.dtype([("h", "<u8"), ("lo", "<u4"), ("n", "<u2")])


# ------------------------------------------------------------ suffix arrays

def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array of bytes, exact to ``depth`` bytes (an end sorts first),
    by Larsson-Sadakane: first by eight bytes, then groups that are still
    equal are refined by the rank of the suffix as far on as is sorted, which
    doubles; groups that have come apart are left alone."""
    n = len(text)
    if n == 0:
        return _NONE
    padded = np.concatenate((text.astype(np.uint64) + np.uint64(1), np.zeros(8, np.uint64)))
    word = np.zeros(n, np.uint64)                  # seven bytes of nine bits
    for i in range(7):
        word = word << np.uint64(9) | padded[i:i + n]
    sa = np.argsort(word)
    s = word[sa]
    del padded, word
    head = np.concatenate(([True], s[1:] != s[:-1]))
    rank = np.empty(n + 1, np.int64)
    group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank[sa] = group
    rank[n] = -1
    done = 7
    follow = np.concatenate((head[1:], [True]))
    open_ = np.flatnonzero(~(head & follow))
    while done < depth and len(open_):
        step = min(done, depth - done)
        members = sa[open_]
        g = rank[members]
        second = rank[np.minimum(members + step, n)] + 1
        pair = g * (n + 2) + second                # one integer sorts faster than two
        order = np.argsort(pair)
        members, pair = members[order], pair[order]
        sa[open_] = members
        new = np.concatenate(([True], pair[1:] != pair[:-1]))
        place = np.maximum.accumulate(np.where(new, open_, 0))
        rank[members] = place
        last = np.concatenate((new[1:], [True]))
        open_ = open_[~(new & last)]
        done += step
    return sa


def _equal_bytes(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length, up to about ``most``, of the common prefix at places a and b,
    eight bytes at a time."""
    n = len(text)
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    word = np.lib.stride_tricks.sliding_window_view(padded, 8)[:n + 1]
    word = np.ascontiguousarray(word).view("<u8").reshape(-1)
    room = n - np.maximum(a, b)
    found = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for d in range(0, most, 8):
        x = word[np.minimum(a[live] + d, n)] ^ word[np.minimum(b[live] + d, n)]
        # equal low bytes: a zero byte below the lowest set bit
        low = x & (~x + np.uint64(1))
        equal = np.where(x == 0, 8, np.bitwise_count(low - np.uint64(1)) // 8)
        found[live] = d + equal
        live = live[(x == 0) & (d + 8 < room[live])]
        if not len(live):
            break
    return np.minimum(found, room)


def common_prefixes(text: np.ndarray, sa: np.ndarray, depth: int) -> np.ndarray:
    """Kasai: common prefix, up to ``depth``, of each suffix with its
    predecessor in the array.  In text order the value falls by at most one
    from a position to the next, and by exactly one where the bytes before
    both suffixes are equal, so bytes are compared only at the other places."""
    n = len(sa)
    before = np.full(n, -1, np.int64)              # in text order
    before[sa[1:]] = sa[:-1]
    prior = np.zeros(n, dtype=bool)
    i = np.flatnonzero(before[1:] > 0) + 1
    follows = before[i] == before[i - 1] + 1       # the same pair, one on
    prior[i[follows]] = text[i[follows] - 1] == text[before[i[follows]] - 1]
    lcp = np.zeros(n, np.int64)
    fresh = np.flatnonzero(~prior & (before >= 0))
    found = _equal_bytes(text, fresh, before[fresh], 2 * depth)   # twice: values carried on fall by one a place
    lcp[fresh] = found
    # carried on: value at the last fresh place, less the distance
    place = np.maximum.accumulate(np.where(prior, 0, np.arange(n)))
    carried = lcp[place] - (np.arange(n) - place)
    long = found >= 2 * depth
    out = np.where(prior, np.maximum(carried, 0), lcp)
    if long.any():
        # a run that goes on past what was compared is settled by its own length
        settle = np.isin(place, fresh[long]) & prior & (out < depth)
        for p in np.flatnonzero(settle):
            q, d = before[p], 0
            while d < depth and p + d < n and q + d < n and text[p + d] == text[q + d]:
                d += 1
            out[p] = d
    return np.minimum(out, depth)[sa]


class _Shard:
    """Distinct strings of one or more merged shards: sorted, each with its
    first occurrence (k, v, start)."""

    def __init__(self, strings, k, v, at):
        self.strings, self.k, self.v, self.at = strings, k, v, at


def _lowest(group, k, v, at):
    """Index of the first occurrence in each group (groups are 0, 1, ...)."""
    order = np.lexsort((at, v, k, group))
    first = np.concatenate(([True], group[order][1:] != group[order][:-1]))
    return order[first]


def _shard(contexts: list[bytes], k, v, lo, length: int):
    """Suffix array of one shard: duplicated starts (context, offset), and
    its distinct strings."""
    sizes = np.array([len(c) for c in contexts])
    text = np.frombuffer(b"".join(contexts), np.uint8)
    base = np.cumsum(sizes) - sizes
    sa = suffix_array(text, length)
    lcp = common_prefixes(text, sa, length)
    owner = np.repeat(np.arange(len(contexts)), sizes)
    offset = np.arange(len(text)) - base[owner]
    whole = offset <= sizes[owner] - length        # a string inside its stretch
    keep = whole[sa]
    # classes of equal strings among whole starts: a break anywhere between
    # two of them in the array separates them
    breaks = np.cumsum(lcp < length)
    members = sa[keep]
    cls = breaks[keep]
    group = np.cumsum(np.concatenate(([0], cls[1:] != cls[:-1]))) if len(cls) else cls
    own = owner[members]
    at = lo[own] + offset[members]
    first = _lowest(group, k[own], v[own], at)
    dup = np.ones(len(members), dtype=bool)
    dup[first] = False
    # an occurrence equal in place to the first (the same document twice) stays
    same = (k[own] == k[own][first][group]) & (v[own] == v[own][first][group]) & (at == at[first][group])
    dup &= ~same
    return members, own, offset[members], dup, group, first, text


def _strings(text: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Fixed-width strings that compare as bytes do (one is added to no byte:
    both sides have full width, so trailing zeros compare alike)."""
    view = np.lib.stride_tricks.sliding_window_view(text, length)[at]
    return np.ascontiguousarray(view).view(f"S{length}").reshape(-1)


def duplicates(contexts: list[bytes], k, v, lo, length: int, shard_bytes: int) -> np.ndarray:
    """(context, offset) rows of starts whose string has an earlier start
    among all contexts: per-shard arrays, merged by binary search."""
    sizes = np.array([len(c) for c in contexts], dtype=np.int64)
    shard = (np.cumsum(sizes) - sizes) // shard_bytes
    found, merged = [], None
    ids = np.unique(shard)
    for s in ids:
        which = np.flatnonzero(shard == s)
        members, own, offset, dup, group, first, text = _shard(
            [contexts[i] for i in which], k[which], v[which], lo[which], length)
        found.append(np.column_stack((which[own[dup]], offset[dup])))
        if len(ids) == 1:
            break
        strings = _strings(text, members[first], length)
        fc, fo = which[own[first]], offset[first]
        if merged is None:
            merged = (strings, fc, fo)
            continue
        ms, mc, mo = merged
        place = np.searchsorted(ms, strings)
        hit = place < len(ms)
        hit[hit] = ms[place[hit]] == strings[hit]
        p = place[hit]
        # of two first occurrences the later one is a duplicate
        new = (k[fc[hit]], v[fc[hit]], lo[fc[hit]] + fo[hit])
        old = (k[mc[p]], v[mc[p]], lo[mc[p]] + mo[p])
        later, equal = np.zeros(len(p), dtype=bool), np.ones(len(p), dtype=bool)
        for x, y in zip(new, old):
            later |= equal & (x > y)
            equal &= x == y
        found.append(np.column_stack((fc[hit][later], fo[hit][later])))
        swap = ~later & ~equal
        found.append(np.column_stack((mc[p[swap]], mo[p[swap]])))
        mc, mo = mc.copy(), mo.copy()
        mc[p[swap]], mo[p[swap]] = fc[hit][swap], fo[hit][swap]
        merged = (np.insert(ms, place[~hit], strings[~hit]), np.insert(mc, place[~hit], fc[~hit]),
                  np.insert(mo, place[~hit], fo[~hit]))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


# ---------------------------------------------------------------- contexts

_PLACE = np.dtype([("k", "<i8"), ("v", "<i8"), ("lo", "<u4"), ("n", "<u2")])


def _merge_equal(contexts: list[bytes], place: np.ndarray):
    """First occurrence of each distinct context, and the others' places."""
    order = np.lexsort((place["lo"], place["v"], place["k"]))
    seen: dict[bytes, int] = {}
    first = np.array([seen.setdefault(contexts[i], i) for i in order.tolist()], dtype=np.int64)
    firsts = order[first == order]
    # the same place met twice is no copy
    differs = np.zeros(len(order), dtype=bool)
    for f in ("k", "v", "lo"):
        differs |= place[f][order] != place[f][first]
    return firsts, order[differs]


def _runs_of(values: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """``rows`` cut where their (sorted) values change."""
    return np.split(rows, np.flatnonzero(np.diff(values)) + 1) if len(rows) else []


def _finer(raw: bytes, s: np.ndarray, length: int, gram: int):
    """Stretches of a hot anchor cut anew by anchors of ``gram`` bytes: equal
    strings still choose the same, but a line that many documents share no
    longer brings together what differs around it."""
    begin = s["lo"].astype(np.int64)
    size = s["n"].astype(np.int64) + length - 1
    text = np.frombuffer(b"".join([raw[a:a + z] for a, z in zip(begin.tolist(), size.tolist())]), np.uint8)
    h, which, lo, n = stretches(text, np.concatenate(([0], np.cumsum(size))), length, gram)
    out = np.empty(len(h), dtype=_STRETCH)
    out["h"], out["lo"], out["n"] = h, begin[which] + lo, n
    return out


def _contexts(batches: Iterator[pa.RecordBatch], length: int, buckets: int, hot: np.ndarray | None = None,
              fine: int = FINE_GRAM):
    """Text of the repeated stretches by bucket, equal ones merged; places of
    those found equal to an earlier one travel along as finished runs.
    ``hot``: sorted hashes of anchors whose stretches are cut finer."""
    unzip = zstandard.ZstdDecompressor()
    contexts: list[bytes] = []
    hashes: list = []
    places: list = []
    held = 0

    def batch():
        nonlocal contexts, hashes, places, held
        place, h = np.concatenate(places), np.concatenate(hashes)
        firsts, rest = _merge_equal(contexts, place)
        bucket = ((h >> np.uint64(8)) % np.uint64(buckets)).astype(np.int64)
        out = []
        firsts = firsts[np.lexsort((h[firsts], bucket[firsts]))]
        for which in _runs_of(bucket[firsts], firsts):
            body = b"".join([contexts[i] for i in which.tolist()])
            out.append((int(bucket[which[0]]), place[which].tobytes(), h[which].tobytes(),
                        len(body).to_bytes(4, "little") + _Z.compress(body)))
        # finished places by their own document: a hot stretch's copies spread
        own = (place["k"][rest] % buckets).astype(np.int64)
        rest = rest[np.argsort(own, kind="stable")]
        for which in _runs_of(np.sort(own), rest):
            out.append((int(place["k"][which[0]] % buckets), place[which].tobytes(), b"", None))
        contexts, hashes, places, held = [], [], [], 0
        cols = list(zip(*out)) or [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
            names=["bucket", "place", "hash", "body"])

    for b in batches:
        for k, v, size, text, ats in zip(*(b.column(c).to_pylist() for c in ("k", "v", "size", "z", "ats"))):
            raw = unzip.decompress(text, max_output_size=max(1, size))
            s = np.frombuffer(b"".join(ats), dtype=_STRETCH)
            s = s[np.unique(s["lo"], return_index=True)[1]]      # a start has one anchor
            if hot is not None and len(hot):
                often = hot[np.minimum(np.searchsorted(hot, s["h"]), len(hot) - 1)] == s["h"]
                if often.any():
                    s = np.concatenate((s[~often], _finer(raw, s[often], length, min(fine, length))))
            begin = s["lo"].astype(np.int64)
            end = begin + s["n"] + length - 1
            contexts += [raw[a:z] for a, z in zip(begin.tolist(), end.tolist())]
            hashes.append(s["h"])
            place = np.empty(len(s), dtype=_PLACE)
            place["k"], place["v"], place["lo"], place["n"] = k, v, s["lo"], s["n"]
            places.append(place)
            held += int(s["n"].sum()) + len(s) * (length + 80)
            if held > 1 << 25:
                yield batch()
    if contexts:
        yield batch()


def _runs(k, v, start) -> Iterator[tuple[int, int, bytes]]:
    """Runs of duplicated starts per document as (first, count) pairs."""
    order = np.lexsort((start, v, k))
    k, v, start = k[order], v[order], start[order]
    new = np.concatenate(([True], (np.diff(k) != 0) | (np.diff(v) != 0) | (np.diff(start) != 1)))
    at = np.flatnonzero(new)
    count = np.diff(np.concatenate((at, [len(k)])))
    k, v, start = k[at], v[at], start[at]
    cut = np.flatnonzero((np.diff(k) != 0) | (np.diff(v) != 0)) + 1
    for g in np.split(np.arange(len(k)), cut):
        yield int(k[g[0]]), int(v[g[0]]), np.column_stack((start[g], count[g])).astype("<u4").tobytes()


def _settle(batches: Iterator[pa.RecordBatch], length: int, shard_bytes: int):
    """Duplicated starts of a partition's buckets, as runs per document."""
    unzip = zstandard.ZstdDecompressor()
    held: dict[int, list] = {}
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("bucket", "place", "hash", "body"))):
            held.setdefault(row[0], []).append(row[1:])
    for bucket in sorted(held):
        contexts, places, hashes, done = [], [], [], []
        for place, hash_, body in held.pop(bucket):
            p = np.frombuffer(place, dtype=_PLACE)
            if body is None:
                done.append(p)
                continue
            text = unzip.decompress(body[4:], max_output_size=max(1, int.from_bytes(body[:4], "little")))
            ends = np.cumsum(p["n"].astype(np.int64) + length - 1)
            contexts += [text[a:z] for a, z in zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist())]
            places.append(p)
            hashes.append(np.frombuffer(hash_, np.uint64))
        k, v, start = [], [], []
        if contexts:
            place, h = np.concatenate(places), np.concatenate(hashes)
            firsts, rest = _merge_equal(contexts, place)
            done.append(place[rest])
            # stretches whose anchor is left once have nothing to meet
            _, inverse, counts = np.unique(h[firsts], return_inverse=True, return_counts=True)
            firsts = firsts[counts[inverse] > 1]
            firsts = firsts[np.argsort(h[firsts], kind="stable")]
            if len(firsts):
                p = place[firsts]
                lo = p["lo"].astype(np.int64)
                d = duplicates([contexts[i] for i in firsts], p["k"], p["v"], lo, length, shard_bytes)
                k.append(p["k"][d[:, 0]])
                v.append(p["v"][d[:, 0]])
                start.append(lo[d[:, 0]] + d[:, 1])
        for p in done:
            n = p["n"].astype(np.int64)
            k.append(np.repeat(p["k"], n))
            v.append(np.repeat(p["v"], n))
            start.append(np.repeat(p["lo"].astype(np.int64), n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        k, v, start = (np.concatenate(c) if c else _NONE for c in (k, v, start))
        if len(k):
            rows = list(_runs(k, v, start))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))],
                names=["k", "v", "runs"])


# ------------------------------------------------------------------ removal

def removed_spans(runs: bytes, length: int) -> np.ndarray:
    """Maximal removed byte runs (begin, end) from duplicated start runs."""
    r = np.frombuffer(runs, "<u4").astype(np.int64).reshape(-1, 2)
    if not len(r):
        return np.zeros((0, 2), np.int64)
    r = r[np.argsort(r[:, 0], kind="stable")]
    begin, end = r[:, 0], np.maximum.accumulate(r[:, 0] + r[:, 1] - 1 + length)
    new = np.concatenate(([True], begin[1:] > end[:-1]))
    at = np.flatnonzero(new)
    return np.column_stack((begin[at], end[np.concatenate((at[1:] - 1, [len(r) - 1]))]))


def _kept(raw: bytes, spans: np.ndarray) -> bytes:
    out, at = [], 0
    for a, b in spans.tolist():
        out.append(raw[at:a])
        at = b
    out.append(raw[at:])
    return b"".join(out)


def _zipped(batches: Iterator[pa.RecordBatch]):
    z = zstandard.ZstdCompressor(level=1)
    for part in slices(batches, 1 << 22):
        texts = [t.as_py() for t in part.column("text").cast(pa.large_binary())]
        yield pa.RecordBatch.from_arrays(
            [part.column("k"), part.column("v"), pa.array([len(t) for t in texts], pa.int64()),
             pa.array([z.compress(t) for t in texts], pa.binary())], names=["k", "v", "size", "z"])


def hot_anchors(found: DataFrame, most: int = HOT_ANCHORS) -> np.ndarray:
    """The anchors met in most slices, of those that ``_repeated`` names,
    sorted.  Any other is in less than one in ``most`` of all counted."""
    def named(batches):
        for b in batches:
            pairs = np.concatenate([np.frombuffer(x, "<i8").reshape(-1, 2) for x in b.column(0).to_pylist()] or [np.zeros((0, 2), np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["h", "slices"])

    rows = (found.where("k is null").select("at").mapInArrow(named, "h long, slices long")
            .orderBy(F.desc("slices"), "h").limit(most).collect())
    return np.sort(np.array([r["h"] for r in rows], np.int64).view(np.uint64))


def find_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES,
              hot_slices: int = HOT_SLICES) -> DataFrame:
    """(k, v, runs) for documents with duplicated starts; ``docs`` is
    (k, v, text)."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    buckets = parts * BUCKETS_PER_PARTITION
    survey = docs.mapInArrow(lambda it: _survey(it, length, gram, buckets), "bucket int, blob binary")
    known = stage(survey.repartition(parts, "bucket").mapInArrow(lambda it: _repeated(it, hot_slices), "k long, v long, at binary"),
                  "substring_anchors")
    hot = hot_anchors(known)
    repeated = known.where("k is not null").groupBy("k", "v").agg(F.collect_list("at").alias("ats"))
    zipped = docs.mapInArrow(_zipped, "k long, v long, size long, z binary").dropDuplicates(["k", "v"])
    found = (zipped.join(repeated, ["k", "v"])
             .mapInArrow(lambda it: _contexts(it, length, buckets, hot), "bucket int, place binary, hash binary, body binary"))
    return (found.repartition(parts, "bucket")
            .mapInArrow(lambda it: _settle(it, length, shard_bytes), "k long, v long, runs binary")
            .groupBy("k", "v").agg(F.collect_list("runs").alias("runs")))


def _remove(batches: Iterator[pa.RecordBatch], length: int):
    unzip = zstandard.ZstdDecompressor()
    for b in batches:
        out = []
        for k, size, text, runs in zip(*(b.column(c).to_pylist() for c in ("k", "size", "z", "runs"))):
            raw = unzip.decompress(text, max_output_size=max(1, size))
            spans = removed_spans(b"".join(runs or []), length)
            kept = _kept(raw, spans)
            out.append((k, len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                        spans.tolist(), kept))
        cols = list(zip(*out)) or [[]] * 7
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                         names=["k", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])


def dedup(docs: DataFrame, id_col="doc_id", text_col="text", length: int = LENGTH, gram: int = GRAM,
          shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept) per
    row: the maximal removed byte runs and the bytes that stay (which may cut
    through a character).

    A null text is the empty text; a null id comes after all others (and
    stays null); rows equal in id and text are one document, each of which is
    returned; rows with one id but other texts are ordered by a text hash;
    texts shorter than ``length`` are kept; an empty table gives no rows;
    other columns are not read.
    """
    text = F.coalesce(col(docs, text_col).cast("string"), F.lit(""))
    rows = docs.select(key(docs, id_col).alias("k"), F.xxhash64(text).alias("v"), text.alias("text"))
    runs = stage(find_runs(rows, length, gram, shard_bytes), "substring_runs")
    return (rows.mapInArrow(_zipped, "k long, v long, size long, z binary").join(runs, ["k", "v"], "left")
            .mapInArrow(lambda it: _remove(it, length),
                        "k long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                        "spans array<array<long>>, kept binary")
            .withColumn("doc_id", unkey(F.col("k"))))


def rewrite(docs: DataFrame, id_col="doc_id", text_col="text", length: int = LENGTH, gram: int = GRAM,
            shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` (all columns, whatever their names) with the repeated bytes gone
    from the text (and what is left of a cut character); rows whose whole text
    went are dropped.

    Null and empty texts stay as they are; documents without an id come after
    all others; rows equal in id and text are cut alike; an empty table stays
    empty.
    """
    text = F.coalesce(col(docs, text_col).cast("string"), F.lit(""))
    run_k, run_v, run_spans = free_names(docs, 3)
    rows = docs.withColumn(run_k, key(docs, id_col)).withColumn(run_v, F.xxhash64(text))
    plain = rows.select(F.col(run_k).alias("k"), F.col(run_v).alias("v"),
                        F.coalesce(col(rows, text_col).cast("string"), F.lit("")).alias("text"))
    runs = stage(find_runs(plain, length, gram, shard_bytes), "substring_runs").select(
        F.col("k").alias(run_k), F.col("v").alias(run_v), F.col("runs").alias(run_spans))
    at = docs.columns.index(text_col)
    fields = rows.schema.fields
    zipped = T.StructType([T.StructField(f.name, T.BinaryType()) if i == at else f for i, f in enumerate(fields)])

    def squeeze(batches):
        z = zstandard.ZstdCompressor(level=3)
        for b in few(batches):
            texts = b.column(at).cast(pa.large_binary()).to_pylist()
            cols = list(b.columns)
            cols[at] = pa.array([None if t is None else z.compress(t) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    def cut(batches):
        unzip = zstandard.ZstdDecompressor()
        for b in few(batches):
            new, keep = [], []
            for t, runs_ in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist()):
                raw = None if t is None else unzip.decompress(t)
                spans = removed_spans(b"".join(runs_ or []), length)
                if len(spans):
                    raw = _kept(raw, spans)
                new.append(None if raw is None else raw.decode("utf-8", "ignore"))
                keep.append(not len(spans) or bool(raw))
            cols = list(b.columns)[:len(fields) - 2]
            cols[at] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields[:-2]]).filter(pa.array(keep, pa.bool_()))

    joined = rows.mapInArrow(squeeze, zipped).join(runs, [run_k, run_v], "left")
    names = [f.name for f in fields]
    ordered = joined.select(*[col(joined, n) for n in names], run_spans)
    return ordered.mapInArrow(cut, T.StructType([T.StructField(f.name, T.StringType()) if i == at else f
                                                 for i, f in enumerate(fields[:-2])]))
