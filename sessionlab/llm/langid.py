"""Language ID with blended-spectrum presence kernels and Nystrom landmarks.

A text is the set of its byte n-grams (n = 1, 2, 3 over letters; everything
else is one space), hashed into BINS; k(x, z) = |x & z| / sqrt(|x| |z|).
Landmarks are documents of the training sample; K_mm^(-1/2) maps kernel
values to features, and one ridge regression per language (one against the
rest) is solved on them.  Scoring multiplies batches of presence rows with
the landmarks, then with the folded coefficients.

Fitting reads at most ``per_language`` documents of each language (hashed
choice, documented bound); only their presence bits reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlab.llm.common import hashed_sample, has_letter, judged, key, col, keyed_text, slices, unkey, utf8

BINS = 1 << 13
PER_LANGUAGE = 400
LANDMARKS = 128
UNDETERMINED = "und"

_FOLD = np.full(256, 32, dtype=np.uint32)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def presence(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, BINS) of 0 / 1 for texts given as bytes and offsets."""
    c = _FOLD[raw]
    codes = [c + np.uint32(1 << 24)]
    two = (c[:-1] << np.uint32(8) | c[1:]) + np.uint32(2 << 24) if len(c) > 1 else c[:0]
    codes.append(two)
    three = (c[:-2] << np.uint32(16) | c[1:-1] << np.uint32(8) | c[2:]) ^ np.uint32(3 << 24) if len(c) > 2 else c[:0]
    codes.append(three)
    bins = [((x * np.uint32(2654435761)) >> np.uint32(19)).astype(np.int64) for x in codes]
    out = np.zeros((len(offsets) - 1, BINS), dtype=np.float32)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        row = out[i]
        for n, at in enumerate(bins):
            if b - n > a:
                row[at[a:b - n]] = 1
    return out


@dataclass
class LanguageModel:
    languages: list[str]
    landmarks: np.ndarray        # (m, BINS), rows of unit length
    alpha: np.ndarray            # (m, languages)

    def scores(self, x: np.ndarray) -> np.ndarray:
        norm = np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
        return (x @ self.landmarks.T / norm) @ self.alpha


def fit_kernel_ridge(x: np.ndarray, y: list[str], landmarks: int, ridge: float) -> LanguageModel:
    languages = sorted(set(y))
    unit = x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
    # landmarks: evenly from each language's rows, which come in hashed order
    label = np.array(y)
    rank = np.zeros(len(y), dtype=np.int64)
    for lang in languages:
        at = np.flatnonzero(label == lang)
        rank[at] = np.arange(len(at))
    z = unit[np.argsort(rank, kind="stable")[:landmarks]]
    w, v = np.linalg.eigh((z @ z.T).astype(np.float64))
    keep = w > 1e-6 * w.max(initial=1e-12)
    root = v[:, keep] / np.sqrt(w[keep])
    phi = (unit @ z.T).astype(np.float64) @ root
    target = np.where(label[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    beta = np.linalg.solve(phi.T @ phi + ridge * np.eye(phi.shape[1]), phi.T @ target)
    return LanguageModel(languages, z.astype(np.float32), (root @ beta).astype(np.float32))


def fit(docs: DataFrame, lang_col="lang", id_col="doc_id", text_col="text", per_language: int = PER_LANGUAGE,
        landmarks: int = LANDMARKS, ridge: float = 1e-2) -> LanguageModel | None:
    """Model from rows with a language and a letter; None if there are none."""
    rows = docs.select(key(docs, id_col).alias("k"), col(docs, text_col).cast("string").alias("text"),
                       col(docs, lang_col).cast("string").alias("lang")).where("lang is not null and text is not null")
    rows = rows.withColumn("v", F.xxhash64("text"))
    # ids first: a sample bounds rows, not the bytes of their texts; id and
    # text together, as many rows may lack an id
    chosen = hashed_sample(rows.select("k", "v", "lang"), "lang", per_language, ("k", "v"))
    rows = rows.join(F.broadcast(chosen), ["k", "v", "lang"], "left_semi").dropDuplicates(["k", "v", "lang"])

    def bits(batches):
        for part in slices(batches, 1 << 21):
            raw, at = utf8(part.column("text"))
            packed = np.packbits(presence(raw, at).astype(bool), axis=1)
            yield pa.RecordBatch.from_arrays(
                [part.column("lang"), pa.array([r.tobytes() for r in packed], pa.binary())], names=["lang", "bits"])

    got = rows.mapInArrow(bits, "lang string, bits binary").collect()
    got = [r for r in got if any(r.bits)]
    if not got:
        return None
    x = np.unpackbits(np.frombuffer(b"".join(r.bits for r in got), np.uint8).reshape(len(got), -1), axis=1)
    return fit_kernel_ridge(x.astype(np.float32), [r.lang for r in got], landmarks, ridge)


def _predict(batches: Iterator[pa.RecordBatch], model: LanguageModel | None):
    for big in slices(batches, 1 << 21):
        for s in range(0, big.num_rows, 256):
            part = big.slice(s, 256)
            lang = np.full(part.num_rows, UNDETERMINED, dtype=object)
            score = np.zeros(part.num_rows)
            raw, at = utf8(part.column("text"))
            # a text is undetermined without a letter of any script
            letters = np.array([has_letter(t) for t in part.column("text").to_pylist()], dtype=bool)
            if model is not None:
                f = model.scores(presence(raw, at)).astype(np.float64)
                p = np.exp(4 * (f - f.max(axis=1, keepdims=True)))
                best = f.argmax(axis=1)
                lang[letters] = np.array(model.languages, dtype=object)[best[letters]]
                score[letters] = (1 / p.sum(axis=1))[letters]
            yield pa.RecordBatch.from_arrays(
                [part.column("k"), pa.array(lang, pa.string()), pa.array(score)], names=["k", "lang_pred", "score"])


def predict(docs: DataFrame, model: LanguageModel | None, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, lang_pred, score) per row.  Null, empty and letterless texts
    (and every text when nothing was learned) are ``und`` with score 0; null
    ids stay null; repeated rows come back each; texts are read whole."""
    return (keyed_text(docs, id_col, text_col)
            .mapInArrow(lambda it: _predict(it, model), "k long, lang_pred string, score double")
            .select(unkey(F.col("k")).alias("doc_id"), "lang_pred", "score", "k"))


def determined(docs: DataFrame, model, text_col="text") -> DataFrame:
    """Rows of ``docs`` (all columns) whose language is not ``und``; a row
    travels with its prediction, so nothing is joined."""
    at = docs.columns.index(text_col)

    def good(probe):
        return [v != UNDETERMINED for b in _predict([probe], model) for v in b.column("lang_pred").to_pylist()]

    return docs.mapInArrow(lambda it: judged(it, at, 1 << 21, good), T.StructType(docs.schema.fields))
