"""Document quality by positive-unlabelled learning.

Trusted positives are labelled good documents, the unlabelled set is a sample
of all text.  A small network on document statistics minimises the
non-negative unbiased risk (Kiryo et al.)

    pi E_p[l(g)] + max(0, E_u[l(-g)] - pi E_p[l(-g)])

with the class prior pi estimated from the data: for the highest-scoring part
of the text, the share of unlabelled over the share of held-back positives,
at its smallest over all cuts (with a margin for chance).  Estimate and fit
alternate.

Both samples are bounded (``per_class``, ``unlabelled``: documented
parameters); only their statistics reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlab.llm.common import NO_ID, col, hashed_sample, key, keyed_text, slices, unkey, utf8

POSITIVES = 4000
UNLABELLED = 8000
_CLASSES = 9
_KIND = np.zeros(256, dtype=np.uint8)           # 0: any other byte
_KIND[97:123] = 1                               # lower-case letters
_KIND[65:91] = 2                                # capitals
_KIND[48:58] = 3                                # digits
_KIND[[9, 11, 12, 13, 32]] = 4                  # blanks
_KIND[10] = 5                                   # line feeds
_KIND[list(b".,;:'\"-()")] = 6                  # punctuation of prose
_KIND[list(b"!?")] = 7
_KIND[list(b"#$%&*+/<=>@[\\]^_`{|}~")] = 8      # signs


def statistics(text: str, counts: np.ndarray) -> list[float]:
    """Shares of byte kinds, word and line statistics of one text."""
    n = max(1, int(counts.sum()))
    w = text.split()
    m = max(1, len(w))
    lines = [x for x in text.split("\n") if x.strip()]
    chars = sum(map(len, w))
    distinct = len(set(w))
    return [*(np.sqrt(counts / n)).tolist(),
            counts[2] / max(1, counts[1] + counts[2]),
            np.log1p(n) / 10, np.log1p(len(w)) / 10, min(chars / m, 40) / 10,
            distinct / m, (np.log1p(distinct) / np.log1p(m)) if w else 0.0,
            sum(map(eq, w, w[1:])) / m,
            1 - len(set(lines)) / max(1, len(lines)),
            min(len(lines) / m, 1.0),
            sum(map(str.isalpha, w)) / m]


def features(batch: pa.RecordBatch) -> np.ndarray:
    raw, at = utf8(batch.column("text"))
    kind = _KIND[raw].astype(np.int64)
    doc = np.repeat(np.arange(batch.num_rows), np.diff(at))
    counts = np.bincount(doc * _CLASSES + kind, minlength=batch.num_rows * _CLASSES).reshape(-1, _CLASSES)
    return np.array([statistics(t, c) for t, c in zip(batch.column("text").to_pylist(), counts)], dtype=np.float64)


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    w2: np.ndarray
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(np.hstack([z, np.ones((len(z), 1))]) @ self.w1)
        return np.hstack([h, np.ones((len(h), 1))]) @ self.w2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _fit_risk(p: np.ndarray, u: np.ndarray, prior: float, steps: int, hidden: int = 24, seed: int = 7):
    """Adam on the non-negative risk with the logistic loss, all rows a step."""
    rng = np.random.default_rng(seed)
    x = np.vstack([p, u])
    x = np.hstack([x, np.ones((len(x), 1))])
    np_, nu = len(p), len(u)
    w = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), rng.normal(0, 0.1, hidden + 1)]
    mom = [np.zeros_like(a) for a in w]
    var = [np.zeros_like(a) for a in w]
    for t in range(1, steps + 1):
        h = np.tanh(x @ w[0])
        hb = np.hstack([h, np.ones((len(h), 1))])
        g = hb @ w[1]
        s = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
        # loss log(1 + exp(-yg)): derivative -(1 - s) for y = 1, s for y = -1
        neg_loss = np.logaddexp(0, g)
        negative = neg_loss[np_:].mean() - prior * neg_loss[:np_].mean()
        d = np.zeros(len(x))
        if negative >= 0:
            d[:np_] = (-(1 - s[:np_]) - s[:np_]) * prior / np_
            d[np_:] = s[np_:] / nu
        else:                                     # step back out of the overfitted region
            d[:np_] = s[:np_] * prior / np_
            d[np_:] = -s[np_:] / nu
        gh = np.outer(d, w[1][:-1]) * (1 - h * h)
        grads = [x.T @ gh + 1e-4 * w[0], hb.T @ d + 1e-4 * w[1]]
        rate = 0.02 * min(1, t / 20) * (0.5 * (1 + np.cos(np.pi * t / steps)) + 0.02)
        for i, gr in enumerate(grads):
            mom[i] = 0.9 * mom[i] + 0.1 * gr
            var[i] = 0.999 * var[i] + 0.001 * gr * gr
            w[i] = w[i] - rate * (mom[i] / (1 - 0.9 ** t)) / (np.sqrt(var[i] / (1 - 0.999 ** t)) + 1e-8)
    return w


def estimate_prior(p_scores: np.ndarray, u_scores: np.ndarray) -> float:
    """Smallest ratio of unlabelled to positive share above a cut, over cuts
    that hold a tenth of the positives or more, with a margin for chance."""
    p, u = np.sort(p_scores), np.sort(u_scores)
    cuts = np.quantile(p, np.linspace(0.02, 0.9, 89))
    sp = 1 - np.searchsorted(p, cuts) / len(p)
    su = 1 - np.searchsorted(u, cuts) / len(u)
    slack = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(len(p)) + 1 / np.sqrt(len(u)))
    best = int(np.argmin((su + slack) / sp))
    return float(np.clip(su[best] / sp[best], 0.02, 0.98))


def fit_statistics(p: np.ndarray, u: np.ndarray, steps: int = 400, rounds: int = 3) -> QualityModel | None:
    if len(p) < 2 or len(u) < 2:
        return None
    mean, scale = u.mean(axis=0), u.std(axis=0) + 1e-3
    zp, zu = (np.clip((a - mean) / scale, -8, 8) for a in (p, u))
    held = np.arange(len(p)) % 4 == 0
    prior = 0.7
    for _ in range(rounds):
        model = QualityModel(mean, scale, *_fit_risk(zp[~held], zu, prior, steps), prior)
        prior = estimate_prior(model.margin(p[held]), model.margin(u))
    return QualityModel(mean, scale, *_fit_risk(zp, zu, prior, 2 * steps), prior)


def fit(docs: DataFrame, labels: DataFrame, unlabelled: DataFrame, label_col="quality", id_col="doc_id",
        text_col="text", label_id_col="doc_id", positives: int = POSITIVES, web: int = UNLABELLED):
    """Positives: rows of ``labels`` with label 1; unlabelled: rows of
    ``unlabelled`` (same columns as ``docs``), both by hashed choice."""
    good = (labels.select(key(labels, label_id_col).alias("k"), col(labels, label_col).cast("int").alias("y"))
            .where(f"y is not null and k <> {NO_ID}").groupBy("k").agg(F.min("y").alias("y")).where("y = 1"))
    chosen = hashed_sample(good, "y", positives)

    def stats(batches):
        for part in slices(batches, 1 << 21):
            rows = [r.tobytes() for r in features(part)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["x"])

    def gathered(df):
        rows = sorted(bytes(r.x) for r in df.mapInArrow(stats, "x binary").collect())
        return np.frombuffer(b"".join(rows)).reshape(len(rows), -1) if rows else np.zeros((0, 1))

    p = gathered(keyed_text(docs, id_col, text_col).join(F.broadcast(chosen), "k").select("k", "text"))
    # by id and text: many rows may lack an id
    rows = keyed_text(unlabelled, id_col, text_col).withColumn("v", F.xxhash64("text"))
    ids = hashed_sample(rows.select("k", "v", F.lit(0).alias("y")), "y", web, ("k", "v"))
    u = gathered(rows.join(F.broadcast(ids), ["k", "v"], "left_semi").dropDuplicates(["k", "v"]).select("k", "text"))
    return fit_statistics(p, u)


def _predict(batches: Iterator[pa.RecordBatch], model: QualityModel | None):
    for part in slices(batches, 1 << 21):
        score = model.score(features(part)) if model else np.zeros(part.num_rows)
        yield pa.RecordBatch.from_arrays([part.column("k"), pa.array(score)], names=["k", "score"])


def predict(docs: DataFrame, model: QualityModel | None, id_col="doc_id", text_col="text",
            threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) per row.  Null and empty texts are scored
    by the statistics of the empty text; without a model (no positives)
    every score is 0; null ids stay null; repeated rows come back each;
    texts are read whole."""
    return (keyed_text(docs, id_col, text_col)
            .mapInArrow(lambda it: _predict(it, model), "k long, score double")
            .select(unkey(F.col("k")).alias("doc_id"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"), "k"))
