"""Toxicity with a gap-weighted subsequence kernel SVM and Nystrom landmarks.

The unit that is classified is the word (what stands between white space,
letters only and lower-cased, so inserted signs fall away; a run of
one-letter words, as in a spelled-out insult, is one word; a word of over
PIECE characters is read as overlapping pieces).  Its features are
all subsequences of LENGTH characters that span at most SPAN characters,
weighted DECAY ** span: k(x, z) is their normalised inner product, so a
character put between or left out costs a factor, not the match.

Training (on a bounded sample of labelled documents) knows only document
labels: a toxic document has some toxic word, a clean one has none.  So it
alternates, as multiple-instance SVMs do: take each toxic document's highest
words as positives and clean documents' highest words as negatives, choose
landmarks among both, map to K_nm K_mm^(-1/2), fit a squared-hinge SVM by
Newton steps, score all words, and choose again.  The machine is linear in
the explicit features, so it folds into one table that scores text at array
speed: exactly sum_j beta_j k(x, z_j).  A document's score is that of its
highest word, calibrated by a logistic fit on the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlab.llm.common import NO_ID, col, hashed_sample, key, keyed_text, slices, unkey, utf8

LENGTH, SPAN, DECAY = 4, 6, 0.7
TABLE_BITS = 21
TABLE = 1 << TABLE_BITS
PER_CLASS = 1000
LANDMARKS = 300
#: Offsets of the further characters after the first.
_OFFSETS = [(*x, b) for b in range(LENGTH - 1, SPAN) for x in combinations(range(1, b), LENGTH - 2)]
_MIX = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x165667B1], dtype=np.uint32)
_MIN_WORD = 4
#: Characters of the pieces that longer words are cut into, and their overlap.
PIECE, OVERLAP = 64, 24
_MARK = 1

_LETTER = np.zeros(256, dtype=np.uint32)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)
#: Signs and digits that are read as the letters they imitate.
for _sign, _letter in zip(b"013457@$", b"oieastas"):
    _LETTER[_sign] = _letter
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def words(raw: np.ndarray, offsets: np.ndarray):
    """Letters of all texts without the rest, each letter's word number, and
    each word's document."""
    n = len(raw)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    space = _SPACE[raw]
    letters = (_LETTER[raw] > 0) & ~space
    # digits alone are no letters: a sign counts only beside a real letter
    start = np.zeros(n, dtype=bool)
    if n:
        start[0] = True
        start[1:] = space[:-1] | (doc[1:] != doc[:-1])
    token = np.cumsum(start) - 1
    at = np.flatnonzero(letters)
    if not len(at):
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint32), z, z
    tok = token[at]
    first = np.concatenate(([True], tok[1:] != tok[:-1]))
    run = np.cumsum(first) - 1                       # tokens that have letters
    size = np.bincount(run)
    d = doc[at][first]
    single = size == 1
    joined = np.zeros(len(size), dtype=bool)         # goes on from the token before
    joined[1:] = single[1:] & single[:-1] & (d[1:] == d[:-1])
    word = (np.cumsum(~joined) - 1)[run]
    return _pieces(*_marked(_LETTER[raw[at]], word), d[~joined])


def _marked(c: np.ndarray, word: np.ndarray):
    """A mark before each word, so that its beginning is part of its features."""
    begin = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    return np.insert(c, begin, _MARK), np.insert(word, begin, word[begin])


def _pieces(c: np.ndarray, word: np.ndarray, doc: np.ndarray):
    """Words longer than PIECE, as in joined signs or scripts without spaces,
    are cut into pieces that overlap and together cover them, each a word: the
    norm of a long word would thin out what a part of it says."""
    size = np.bincount(word)
    if size.max() <= PIECE:
        return c, word, doc
    step = PIECE - OVERLAP
    many = np.maximum(1, -(-(size - OVERLAP) // step))
    owner = np.repeat(np.arange(len(size)), many)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    begin = (np.cumsum(size) - size)[owner] + nth * step
    length = np.minimum(PIECE, size[owner] - nth * step)
    piece = np.repeat(np.arange(len(owner)), length)
    at = np.arange(len(piece)) - np.repeat(np.cumsum(length) - length, length) + begin[piece]
    return c[at], piece, doc[owner]


def _features(c: np.ndarray, word: np.ndarray):
    """For each offset pair: positions of first characters and table slots."""
    n = len(c)
    parts = [c * m for m in _MIX]
    for offsets in _OFFSETS:
        b = offsets[-1]
        if n <= b:
            return
        ok = np.flatnonzero(word[b:] == word[:-b])
        slot = parts[0][ok]
        for p, o in zip(parts[1:], offsets):
            slot = slot ^ p[ok + o]
        slot ^= slot >> np.uint32(15)
        slot = (slot * np.uint32(0x27D4EB2F)) >> np.uint32(32 - TABLE_BITS)
        yield ok, slot, DECAY ** (b + 1)


def _norms(length: np.ndarray) -> np.ndarray:
    """Length of a word's feature vector (its subsequences taken as
    distinct): a function of the number of letters."""
    total = np.zeros(len(length))
    for *_, b in _OFFSETS:
        total += np.maximum(length - b, 0) * DECAY ** (2 * (b + 1))
    return np.sqrt(total)


def word_scores(c, word, n_words: int, table: np.ndarray) -> np.ndarray:
    total = np.zeros(n_words)
    for at, slot, weight in _features(c, word):
        total += np.bincount(word[at], weights=table[slot], minlength=n_words) * weight
    norm = _norms(np.bincount(word, minlength=n_words))
    return np.where(norm > 0, total / np.where(norm > 0, norm, 1), 0.0)


def _sparse(texts: list[bytes]):
    """Features of distinct words, word after word, rows of unit norm: where
    each word begins, slots, values (narrow types: this is the largest thing
    the driver holds)."""
    c = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint32)
    size = np.array([len(t) for t in texts])
    word = np.repeat(np.arange(len(texts), dtype=np.int32), size)
    norm = np.maximum(_norms(size), 1e-12).astype(np.float32)
    found = list(_features(c, word))
    counts = np.zeros(len(texts), dtype=np.int64)
    for at, _, _ in found:
        counts += np.bincount(word[at], minlength=len(texts))
    begin = np.concatenate(([0], np.cumsum(counts)))
    slots = np.empty(begin[-1], dtype=np.int32)
    values = np.empty(begin[-1], dtype=np.float32)
    fill = begin[:-1].copy()
    while found:
        at, slot, weight = found.pop()
        w = word[at]                                 # in word order
        per = np.bincount(w, minlength=len(texts))
        to = np.arange(len(w)) + np.repeat(fill - (np.cumsum(per) - per), per)
        slots[to] = slot
        values[to] = weight / norm[w]
        fill += per
    return begin, slots, values


@dataclass
class ToxicityModel:
    table: np.ndarray
    bias: float
    slope: float
    shift: float

    def calibrated(self, top: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (top + self.bias) + self.shift, -40, 40)))


def _svm(phi: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float):
    """Squared-hinge SVM with bias by Newton steps on the support set."""
    x = np.hstack([phi, np.ones((len(phi), 1))])
    w = np.zeros(x.shape[1])
    reg = np.eye(len(w))
    reg[-1, -1] = 1e-6
    for _ in range(20):
        inside = y * (x @ w) < 1
        xs, ws = x[inside], weight[inside]
        new = np.linalg.solve(reg + c * (xs.T * ws) @ xs, c * (xs.T * ws) @ y[inside])
        done = np.abs(new - w).max() < 1e-6
        w = new
        if done:
            break
    return w[:-1], w[-1]


def _per_word(x: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums of a feature column by word."""
    total = np.concatenate(([0.0], np.cumsum(x, dtype=np.float64)))
    return total[begin[1:]] - total[begin[:-1]]


def _distinct(members, n_names: int, sketch: int = 48, alike: float = 0.3) -> np.ndarray:
    """Of documents that share words as copies do, the first: true for those
    kept.  A sketch of minimal word hashes estimates the shared part."""
    rng = np.random.default_rng(11)
    sig = np.empty((len(members), sketch), dtype=np.int32)
    for j in range(sketch):
        order = rng.permutation(n_names).astype(np.int32)
        sig[:, j] = [order[m].min() if len(m) else -1 - i for i, m in enumerate(members)]
    keep = np.ones(len(members), dtype=bool)
    for i in range(len(sig)):
        if keep[i]:
            keep[i + 1:] &= (sig[i + 1:] == sig[i]).mean(axis=1) < alike
    return keep


def _first_view(members, toxic, slots, begin, passes: int = 4):
    """Where training starts: a weight per feature (log-odds of toxic against
    clean documents, less what chance would give) and greedy covers: features
    that, one after the other, explain most toxic documents not yet explained
    while clean documents lack them.  A further pass leaves out the words
    found so far, so a document may be explained by several words."""
    def features_of(m):
        return np.unique(np.concatenate([slots[begin[j]:begin[j + 1]] for j in m])) if len(m) else slots[:0]

    def incidence(which):
        sets = [features_of(m) for m in which]
        return np.repeat(np.arange(len(which), dtype=np.int32), [len(x) for x in sets]), np.concatenate(sets)

    n1, n0 = toxic.sum(), (~toxic).sum()
    s1, s0 = np.zeros(TABLE, dtype=np.int32), np.zeros(TABLE, dtype=np.int32)
    for m, t in zip(members, toxic):
        (s1 if t else s0)[features_of(m)] += 1
    odds = np.log((s1 + 0.5) / (n1 + 1)) - np.log((s0 + 0.5) / (n0 + 1))
    error = np.sqrt(1 / (s1 + 0.5) + 1 / (s0 + 0.5))
    table = np.sign(odds) * np.maximum(np.abs(odds) - 2 * error, 0)
    marks = np.zeros(TABLE, dtype=np.float32)
    members = [m if t else m[:0] for m, t in zip(members, toxic)]
    for n in range(passes):
        # with all documents open again, more features cover some by chance
        least = max(5, 0.015 * n1) if n else max(3, 0.003 * n1)
        doc, slot = incidence(members)
        while len(slot):
            gain = np.bincount(slot, minlength=TABLE) - 20 * s0 * (n1 / n0)
            best = int(gain.argmax())
            if gain[best] < least:
                break
            marks[best] = 1
            covered = np.zeros(len(members), dtype=bool)
            covered[doc[slot == best]] = True
            left = ~covered[doc]
            doc, slot = doc[left], slot[left]
        found = _per_word(marks[slots], begin) > 0
        members = [m[~found[m]] for m in members]
    return table, marks


def _telling(often: np.ndarray, clean: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Words in far more toxic documents than chance would put them: where
    every short part of an insult is a common syllable, the whole word tells."""
    expected = (often + clean) * n1 / (n1 + n0)
    return often >= np.maximum(4, 2.5 * expected + 2 * np.sqrt(expected))


def fit_words(docs: list[list[bytes]], toxic: np.ndarray, landmarks: int = LANDMARKS, rounds: int = 3,
              c: float = 4.0, prior: float | None = None) -> ToxicityModel | None:
    """Model from each sampled document's distinct words and its label.
    ``prior``: share of toxic documents among all, for the calibration (the
    sample holds more of them)."""
    if not len(docs) or toxic.all() or not toxic.any():
        return None
    names = sorted({w for d in docs for w in d if len(w) >= _MIN_WORD})
    if not names:
        return None
    index = {w: i for i, w in enumerate(names)}
    members = [np.array(sorted({index[w] for w in d if w in index}), dtype=np.int64) for d in docs]
    kept = _distinct(members, len(names))
    if not toxic[kept].any() or toxic[kept].all():
        return None
    members, toxic = [m for m, k in zip(members, kept) if k], toxic[kept]
    owner = np.repeat(np.arange(len(members)), [len(m) for m in members])
    flat = np.concatenate(members)
    begin, slots, values = _sparse(names)
    n1, n0 = toxic.sum(), (~toxic).sum()
    table, marks = _first_view(members, toxic, slots, begin)
    bias = 0.0
    clean_df = np.bincount(flat, weights=(~toxic)[owner], minlength=len(names))
    explained = np.zeros(0, dtype=np.int64)
    for step in range(rounds):
        score = _per_word(table[slots] * values, begin) + bias
        s = score[flat]
        by = np.lexsort((-s, owner))
        place = np.arange(len(by)) - np.searchsorted(owner[by], owner[by])
        if step == 0:          # a word with a feature that explains its document
            often = np.bincount(flat, weights=toxic[owner], minlength=len(names))
            telling = _telling(often, clean_df, n1, n0)
            marked = (_per_word(marks[slots], begin) > 0) | telling
            top1 = by[marked[flat[by]] & toxic[owner[by]]]
        else:
            top1 = by[(place < 1) & toxic[owner[by]]]
        positive = np.union1d(flat[top1], explained)
        if step == 0:
            explained = positive[often[positive] >= max(3, 0.01 * n1)]   # kept whatever later rounds choose
        positive = positive[clean_df[positive] <= 0.01 * n0]
        negative = np.unique(flat[by[place < 4][~toxic[owner[by[place < 4]]]]])
        spread = np.flatnonzero(clean_df > 0)
        negative = np.union1d(negative, spread[:: max(1, len(spread) // 3000)])
        negative = np.setdiff1d(negative, np.flatnonzero(telling))     # one stray clean document is no proof
        positive = np.setdiff1d(positive, negative)
        if not len(positive):
            return None
        train = np.concatenate([positive, negative])
        y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
        pick = np.concatenate([positive[np.argsort(-score[positive], kind="stable")][:: max(1, len(positive) // (landmarks // 2) or 1)][:landmarks // 2],
                               negative[np.argsort(-score[negative], kind="stable")][:: max(1, len(negative) // (landmarks // 2) or 1)][:landmarks // 2]])
        # landmark vectors over the table, and kernel values against them
        used = np.unique(np.concatenate([slots[begin[j]:begin[j + 1]] for j in pick]))
        column = np.full(TABLE, len(used), dtype=np.int32)           # slots no landmark has: a last column of zeros
        column[used] = np.arange(len(used), dtype=np.int32)
        z = np.zeros((len(pick), len(used) + 1))
        for r, j in enumerate(pick):
            at = slice(begin[j], begin[j + 1])
            np.add.at(z[r], column[slots[at]], values[at])

        def kernel(which):
            k = np.zeros((len(which), len(pick)))
            for r, j in enumerate(which):
                at = slice(begin[j], begin[j + 1])
                k[r] = z[:, column[slots[at]]] @ values[at]
            return k

        kmm = kernel(pick)
        w, v = np.linalg.eigh((kmm + kmm.T) / 2)
        keep = w > 1e-4 * w.max()
        root = v[:, keep] / np.sqrt(w[keep])
        phi = kernel(train) @ root
        weight = np.where(y > 0, len(y) / (2 * len(positive)), len(y) / (2 * len(negative)))
        beta, bias = _svm(phi, y, weight, c)
        table = np.zeros(TABLE, dtype=np.float32)
        table[used] = (z.T @ (root @ beta))[:-1]
    score = _per_word(table[slots] * values, begin)
    top = np.full(len(members), -4.0 - bias)
    np.maximum.at(top, owner, score[flat])
    # logistic fit of the label on a document's highest word
    x = np.column_stack([top + bias, np.ones(len(top))])
    t, a = toxic.astype(float), np.zeros(2)
    share = t.mean()
    prior = share if prior is None else prior
    by = np.where(toxic, prior / share, (1 - prior) / (1 - share))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        g = x.T @ (by * (p - t)) + 1e-2 * a
        h = (x.T * np.maximum(by * p * (1 - p), 1e-6)) @ x + 1e-2 * np.eye(2)
        a -= np.clip(np.linalg.solve(h, g), -2, 2)
    return ToxicityModel(table.astype(np.float32), float(bias), float(max(a[0], 1e-3)), float(a[1]))


def fit(docs: DataFrame, labels: DataFrame, label_col="toxic", id_col="doc_id", text_col="text",
        label_id_col="doc_id", per_class: int = PER_CLASS) -> ToxicityModel | None:
    """Fit on at most about ``per_class`` labelled documents of each class
    (hashed choice).  Their distinct words reach the driver."""
    known = (labels.select(key(labels, label_id_col).alias("k"), col(labels, label_col).cast("int").alias("y"))
             .where(f"y in (0, 1) and k <> {NO_ID}").groupBy("k").agg(F.max("y").alias("y")))
    chosen = hashed_sample(known, "y", per_class)

    def distinct_words(batches):
        for part in slices(batches, 1 << 21):
            raw, at = utf8(part.column("text"))
            c, word, doc = words(raw, at)
            text = c.astype(np.uint8).tobytes()
            ends = np.cumsum(np.bincount(word)) if len(word) else np.zeros(0, np.int64)
            sets: list[set] = [set() for _ in range(part.num_rows)]
            for w, (a, b) in enumerate(zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist())):
                sets[doc[w]].add(text[a:b])
            yield pa.RecordBatch.from_arrays(
                [part.column("y"), pa.array([b" ".join(sorted(s)) for s in sets], pa.binary())], names=["y", "words"])

    got = (keyed_text(docs, id_col, text_col).join(F.broadcast(chosen), "k")
           .mapInArrow(distinct_words, "y int, words binary").collect())
    got = sorted((bytes(r.words), r.y) for r in got)
    prior = known.agg(F.avg("y")).first()[0]
    return fit_words([w.split() for w, _ in got], np.array([y == 1 for _, y in got], dtype=bool), prior=prior)


def _predict(batches: Iterator[pa.RecordBatch], model: ToxicityModel | None):
    for part in slices(batches, 1 << 20):
        top = np.full(part.num_rows, -4.0 - (model.bias if model else 0))
        if model is not None:
            raw, at = utf8(part.column("text"))
            c, word, doc = words(raw, at)
            if len(word):
                np.maximum.at(top, doc, word_scores(c, word, len(doc), model.table))
            score = model.calibrated(top)
        else:
            score = np.zeros(part.num_rows)
        yield pa.RecordBatch.from_arrays([part.column("k"), pa.array(score)], names=["k", "score"])


def predict(docs: DataFrame, model: ToxicityModel | None, id_col="doc_id", text_col="text",
            threshold: float = 0.5) -> DataFrame:
    """(doc_id, score, predicted) per row.  Null, empty and letterless texts
    have the score of a document without any word; without a model (no
    labels of both kinds) every score is 0; null ids stay null; repeated
    rows come back each; texts are read whole."""
    return (keyed_text(docs, id_col, text_col)
            .mapInArrow(lambda it: _predict(it, model), "k long, score double")
            .select(unkey(F.col("k")).alias("doc_id"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"), "k"))
