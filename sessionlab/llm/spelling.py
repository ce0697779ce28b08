"""Spelling variants of the corpus vocabulary by search schemes on a
bidirectional FM-index.

1. Words are counted over whole texts.
2. Two words one edit apart share, exactly, one half of the query at its
   place.  Every word is filed under the halves it could share with a query
   of its own length, one shorter or one longer; files are dealt into buckets
   of a bounded size.  A file that is too large is dealt by finer zones: the
   zone that may hold the edit is halved, and what stands outside it is
   matched exactly.  A zone of one letter bounds a file by the alphabet.
3. A bucket indexes its words as one cyclic text, each word after a
   delimiter, forward and backward.  An interval of suffix ranks is kept in
   both indexes, so a pattern grows on either side.  A query matches what
   stands outside its zone exactly, from the longer side, then crosses the
   zone with exactly one edit, and ends on both delimiters: the rank of the
   interval is then the number of the word found.

An edit is taken at the last place where it can stand (the length of the
common prefix), so that each pair is found once, in one zone.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlab.llm.common import col
from sessionlab.sources.store import stage

RUN = re.compile("[a-zÀ-ÿ]+")      # of a text whose A-Z are lower-cased
DROP = 199           # a run whose hash is divisible by this loses a letter
SHORTEST = 6
LEAST = 5            # occurrences of a word; also the factor from a word to its form
BUCKET_CHARS = 65_536
FILE_WORDS = 4_096
HELD_WORDS = 200_000
BLOCK = 32           # places of the index between stored counts

# --------------------------------------------------------------- counting


def runs(doc_id, text: str):
    """(word, times) of one document."""
    base = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    lowered = text.encode("utf-8", "replace").lower().decode()
    for run, times in Counter(RUN.findall(lowered)).items():
        h = zlib.crc32(run.encode(), base)
        if h % DROP == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= SHORTEST:
            yield run, times


def _counted(batches):
    held: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                          names=["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            text = text.as_py()
            if text:
                for word, times in runs(doc_id, text):
                    held[word] += times
                if len(held) > HELD_WORDS:
                    yield out()
                    held.clear()
    if held:
        yield out()


def vocabulary(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """(word, n) of the words that occur often enough."""
    rows = docs.select(col(docs, id_col).cast("string").alias("doc_id"), col(docs, text_col).cast("string").alias("text"))
    return (rows.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= LEAST))


# ---------------------------------------------------------------- the index

class Ranks:
    """Occurrence counts over the Burrows-Wheeler transform of a cyclic text
    (codes 0..size-1, rotations all distinct): one stored row per BLOCK."""

    def __init__(self, text: np.ndarray, size: int):
        n = len(text)
        rank, step = text.astype(np.int64), 1
        at = np.arange(n)
        while True:
            key = rank * (int(rank.max()) + 1) + rank[(at + step) % n]
            order = np.argsort(key)
            new = np.empty(n, np.int64)
            new[order] = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
            rank, step = new, step * 2
            if rank.max() == n - 1:
                break
        order = np.argsort(rank)
        padded = -(-(n + 1) // BLOCK) * BLOCK
        self.size = size
        self.bwt = np.full(padded, size, np.int64)          # filler is no code
        self.bwt[:n] = text[(order - 1) % n]
        blocks = padded // BLOCK
        per = np.bincount(np.arange(n) // BLOCK * size + self.bwt[:n], minlength=blocks * size).reshape(blocks, size)
        self.stored = np.concatenate((np.zeros((1, size), np.int64), np.cumsum(per, axis=0)))[:blocks]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=size))))[:size]
        self.steps = np.arange(BLOCK)

    def _block(self, at):
        start = at // BLOCK
        letters = self.bwt[start[:, None] * BLOCK + self.steps]
        return start, np.where(self.steps < (at - start * BLOCK)[:, None], letters, self.size)

    def upto(self, code, at):
        """How often ``code`` stands before rank ``at``, element by element."""
        start, letters = self._block(at)
        return self.stored[start, code] + (letters == code[:, None]).sum(axis=1)

    def all_upto(self, at):
        """The same for every code: one row per element."""
        start, letters = self._block(at)
        wide = self.size + 1
        flat = np.bincount((np.arange(len(at))[:, None] * wide + letters).ravel(), minlength=len(at) * wide)
        return self.stored[start] + flat.reshape(-1, wide)[:, :-1]


class States:
    """Intervals of equal width ``s`` in both indexes (``lo`` of the side that
    grows, ``other``), with the query and the place it has reached."""

    __slots__ = ("q", "at", "lo", "other", "s")

    def __init__(self, q, at, lo, other, s):
        self.q, self.at, self.lo, self.other, self.s = q, at, lo, other, s

    def take(self, which):
        return States(*(getattr(self, f)[which] for f in self.__slots__))

    @classmethod
    def joined(cls, parts):
        return cls(*(np.concatenate([getattr(p, f) for p in parts]) for f in cls.__slots__))


class Index:
    """Both indexes of sorted distinct words."""

    def __init__(self, words: list[str]):
        points = [np.frombuffer(w.encode("utf-32-le"), np.uint32) for w in words]
        self.length = np.array([len(p) for p in points], np.int64)
        letters = np.unique(np.concatenate(points))
        self.start = np.concatenate(([0], np.cumsum(self.length + 1)))[:-1] + 1
        text = np.zeros(int(self.length.sum()) + len(words), np.int64)
        text[np.delete(np.arange(len(text)), self.start - 1)] = np.searchsorted(letters, np.concatenate(points)) + 1
        self.text, self.size, self.count = text, len(letters) + 1, len(words)
        self.forward, self.backward = Ranks(text, self.size), Ranks(text[::-1], self.size)

    def letter(self, word, at):
        return self.text[np.minimum(self.start[word] + at, len(self.text) - 1)]

    def grow(self, states: States, code, right: bool) -> States:
        """Every state one ``code`` longer; those without an occurrence go."""
        ranks = self.backward if right else self.forward
        low, high = ranks.upto(code, states.lo), ranks.upto(code, states.lo + states.s)
        alive = np.flatnonzero(high > low)
        s, code = states.take(alive), code[alive]
        below, upper = ranks.all_upto(s.lo), ranks.all_upto(s.lo + s.s)
        smaller = np.concatenate((np.zeros((len(alive), 1), np.int64), np.cumsum(upper - below, axis=1)), axis=1)
        return States(s.q, s.at, ranks.first[code] + low[alive], s.other + smaller[np.arange(len(alive)), code],
                      (high - low)[alive])

    def grow_by_all(self, states: States, right: bool) -> tuple[States, np.ndarray]:
        """Every state longer by each letter that occurs there (not the delimiter)."""
        ranks = self.backward if right else self.forward
        low, high = ranks.all_upto(states.lo), ranks.all_upto(states.lo + states.s)
        width = high - low
        smaller = np.cumsum(width, axis=1) - width
        row, code = np.nonzero(width[:, 1:])
        code = code + 1
        return States(states.q[row], states.at[row], ranks.first[code] + low[row, code],
                      states.other[row] + smaller[row, code], width[row, code]), code

    def search(self, query, a, b, right: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of the words exactly one edit from the query word, the
        edit standing in its zone [a, b) (at the very end: in the last zone).
        A state's place is the number of letters matched from its side."""
        length = self.length[query]
        whole = np.full(len(query), self.count, np.int64)
        zero = np.zeros(len(query), np.int64)
        exact = States(np.arange(len(query)), zero, zero, zero, whole)       # of the first delimiter
        edited, found = [], []
        while len(exact.q) or edited:
            fresh = []
            if len(exact.q):
                q, L = exact.q, length[exact.q]
                gap = exact.at if right else L - exact.at           # an inserted letter would stand before this place
                place = gap if right else gap - 1                   # the next letter of the query
                inside = (place >= a[q]) & (place < b[q])
                insert = (gap >= a[q]) & ((gap < b[q]) | ((gap == L) & (b[q] == L)))
                for which, advance in ((inside, 1), (insert, 0)):
                    some = exact.take(np.flatnonzero(which))
                    if not len(some.q):
                        continue
                    more, code = self.grow_by_all(some, right)
                    end = length[more.q]
                    seat = more.at if right else end - more.at - advance
                    other = (code != self.letter(query[more.q], seat)) | (seat == end)
                    more = more.take(np.flatnonzero(other))
                    more.at = more.at + advance
                    fresh.append(more)
                # a letter left out: the last of equal letters in a row
                last = (place == L - 1) | (self.letter(query[q], place + 1) != self.letter(query[q], place))
                gone = exact.take(np.flatnonzero(inside & last))
                gone.at = gone.at + 1
                fresh.append(gone)
                onward = exact.take(np.flatnonzero((place < np.where(b[q] == L, L, b[q] - 1)) if right else (gap > a[q])))
                onward_at = onward.at if right else length[onward.q] - onward.at - 1
                exact = self.grow(onward, self.letter(query[onward.q], onward_at), right)
                exact.at = exact.at + 1
            if edited:
                now = States.joined(edited)
                L = length[now.q]
                done = now.at == L
                seat = np.where(done, 0, now.at if right else L - now.at - 1)
                now = self.grow(now, np.where(done, 0, self.letter(query[now.q], seat)), right)
                done = now.at == length[now.q]
                hit = now.take(np.flatnonzero(done))
                # the forward rank of delimiter, word, delimiter is the word's number
                found.append((hit.q, hit.other if right else hit.lo))
                rest = now.take(np.flatnonzero(~done))
                rest.at = rest.at + 1
                fresh.append(rest)
            edited = [f for f in fresh if len(f.q)]
        if not found:
            return zero[:0], zero[:0]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def near_words(words: list[str], query, a, b) -> tuple[np.ndarray, np.ndarray]:
    """(row of ``query``, number of the near word); ``words`` sorted, distinct."""
    index = Index(words)
    L = index.length[query]
    right = a >= L - b
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for side in (True, False):
        rows = np.flatnonzero(right == side)
        if len(rows):
            q, word = index.search(query[rows], a[rows], b[rows], side)
            out.append((rows[q], word))
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def _searched(table: pa.Table) -> pa.Table:
    """One bucket: for each query the number of near words and the best one."""
    words, query, a, b, n = (table.column(c) for c in ("word", "query", "a", "b", "n"))
    spelt = np.array(words.to_pylist(), dtype=object)
    n = n.to_numpy()
    distinct, first, number = np.unique(spelt, return_index=True, return_inverse=True)
    count = n[first]
    rows = np.flatnonzero(query.to_numpy(zero_copy_only=False))
    out = {"word": [], "n_near": [], "best_n": [], "best": []}
    if len(rows):
        q, near = near_words(list(distinct), number[rows], a.to_numpy()[rows], b.to_numpy()[rows])
        order = np.lexsort((near, -count[near], q))
        q, near = q[order], near[order]
        head = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.zeros(0, np.int64)
        out = {"word": list(spelt[rows[q[head]]]), "n_near": np.diff(np.append(head, len(q))),
               "best_n": count[near[head]], "best": list(distinct[near[head]])}
    return pa.table({"word": pa.array(out["word"], pa.string()), "n_near": pa.array(out["n_near"], pa.int64()),
                     "best_n": pa.array(out["best_n"], pa.int64()), "best": pa.array(out["best"], pa.string())})


# ----------------------------------------------------------------- the job

def _keyed(entries: DataFrame) -> DataFrame:
    """A file: queries of one length that share what stands outside a zone."""
    tail = F.col("long") - F.col("b")
    return entries.withColumn("key", F.xxhash64(
        "long", "a", "b", F.expr("substring(word, 1, a)"), F.substring(F.col("word"), F.length("word") - tail + 1, tail)))


def entries(words: DataFrame, file_words: int = FILE_WORDS) -> DataFrame:
    """(word, n, long, a, b, key, query): every word under each file where a
    query could find it; ``query`` where it is a query itself."""
    size = F.length("word")
    half = F.floor(F.col("long") / 2).cast("int")
    zones = F.explode(F.array(F.struct(F.lit(0).alias("a"), half.alias("b")), F.struct(half.alias("a"), F.col("long").alias("b"))))
    rows = (words.withColumn("long", F.explode(F.array(size - 1, size, size + 1))).where(F.col("long") >= SHORTEST)
            .withColumn("z", zones).select("word", "n", "long", "z.a", "z.b"))
    settled = []
    rows = _keyed(rows)
    while True:
        rows = stage(rows, "spelling_files")
        large = rows.groupBy("key").agg(F.count(F.lit(1)).alias("held"), F.max(F.col("b") - F.col("a")).alias("zone"))
        large = stage(large.where((F.col("held") > file_words) & (F.col("zone") > 1)).select("key"), "spelling_large")
        if large.isEmpty():
            settled.append(rows)
            break
        settled.append(rows.join(large, "key", "left_anti"))
        middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
        halves = F.explode(F.array(F.struct("a", middle.alias("b")), F.struct(middle.alias("a"), "b")))
        rows = _keyed(rows.join(large, "key", "left_semi").withColumn("z", halves).select("word", "n", "long", "z.a", "z.b"))
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out.withColumn("query", F.col("long") == size)


def variants(docs: DataFrame, id_col="doc_id", text_col="text", bucket_chars: int = BUCKET_CHARS,
             file_words: int = FILE_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary.

    A null text has no words; a null id counts as empty text; repeated rows
    count each; ties between forms go to the smaller word in code-point
    order; an empty table gives no rows; other columns are not read.
    """
    words = stage(vocabulary(docs, id_col, text_col), "spelling_words")
    filed = entries(words, file_words)
    size = filed.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    buckets = max(1, -(-size // bucket_chars))
    found = (filed.select("word", "n", "a", "b", "query", F.pmod("key", F.lit(buckets)).alias("bucket"))
             .groupBy("bucket").applyInArrow(_searched, "word string, n_near long, best_n long, best string"))
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"),
                        F.lit(None).cast("string").alias("best"))
    both = none.unionByName(found.withColumn("n", F.lit(None).cast("long")))
    better = F.struct((-F.col("best_n")).alias("less"), F.col("best"))
    joined = both.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"),
                                      F.min(F.when(F.col("best").isNotNull(), better)).alias("m"))
    strong = -F.col("m.less") >= LEAST * F.col("n")
    formed = stage(joined.select("word", F.when(strong, F.col("m.best")).alias("form"), "n", "n_near",
                                 F.when(strong, -F.col("m.less")).alias("form_n")), "spelling_forms")
    # n grows at least LEAST-fold along forms, which bounds the way to the root
    top = formed.agg(F.max("n")).first()[0] or 1
    hops = max(1, math.ceil(math.log(max(top, LEAST), LEAST)))
    roots = formed.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(hops)) if hops > 1 else 0):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = stage(roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling_roots")
    return (formed.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
