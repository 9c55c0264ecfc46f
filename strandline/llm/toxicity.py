"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the hashed byte n-grams (``SIZES``) of the lower-cased text, any run of other characters a single border.  A
feature's value is 1 + ln of its count in the document, scaled by the log ratio of its smoothed document frequencies in toxic and
clean labelled documents.  Features whose frequencies differ by fewer than ``LEAST_Z`` standard errors, or that are in fewer than
``LEAST_DOCS`` labelled documents, say nothing and are left out; a logistic regression with an L2 penalty is fitted on the others.

Defined cases: null and empty texts get the score of a text without features; without labels of both classes every
score is the share of toxic labels (0 without any); repeated rows are scored alike; columns other than doc_id and text
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import LETTER_LUT, byte_chunks
from .labelled import adam, labelled_sample, prior_shift, score_texts, sigmoid

SIZES = (4, 5, 6)
BITS = 20
ROWS = 1 << 11
THRESHOLD = 0.5
LEAST_Z = 2.0
LEAST_DOCS = 5  # these three were chosen on one fold of the training rows (see README)
PENALTY = 1e-2


def ngram_features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, hashed n-gram) of a chunk, with 1 + ln of the count."""
    norm = LETTER_LUT[data]
    keep = np.ones(len(norm), bool)
    keep[1:] = (norm[1:] != 0) | (norm[:-1] != 0)  # one border for a run of other characters
    firsts = offs[:-1][offs[:-1] < len(norm)]
    keep[firsts] = True
    doc = np.repeat(np.arange(len(offs) - 1, dtype=np.uint32), np.diff(offs))[keep]
    norm = norm[keep].astype(np.uint32)
    docs, feats = [], []
    for n in SIZES:
        if len(norm) < n:
            continue
        h = np.full(len(norm) - n + 1, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for i in range(n):
            h *= np.uint32(0x01000193)
            h ^= norm[i : len(norm) - n + 1 + i]
            h += h << np.uint32(7)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        same = doc[: len(h)] == doc[n - 1 :]
        docs.append(doc[: len(h)][same])
        feats.append((h >> np.uint32(32 - BITS))[same])
    if not docs:
        return np.zeros(0, np.uint32), np.zeros(0, np.uint32), np.zeros(0, np.float32)
    key = np.sort(np.concatenate(docs) << np.uint32(BITS) | np.concatenate(feats))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    times = np.diff(np.append(first, len(key)))
    key = key[first]
    return key >> np.uint32(BITS), key & np.uint32((1 << BITS) - 1), 1 + np.log(times).astype(np.float32)


def fit(texts: list[str], y: np.ndarray, counts: dict[int, int], penalty: float = PENALTY, steps: int = 100) -> tuple[np.ndarray, float]:
    """Weights of the hashed n-grams and the intercept."""
    size = 1 << BITS
    if not len(y) or y.min() == y.max():
        share = counts.get(1, 0) / max(1, sum(counts.values()))
        return np.zeros(size, np.float32), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    column = pa.array(texts, pa.large_string())
    toxic, clean = np.ones(size, np.int32), np.ones(size, np.int32)
    for lo, _, data, offs in byte_chunks(column, rows=ROWS):
        doc, feat, _ = ngram_features(data, offs)
        bad = y[doc.astype(np.int64) + lo] == 1
        toxic += np.bincount(feat[bad], minlength=size).astype(np.int32)
        clean += np.bincount(feat[~bad], minlength=size).astype(np.int32)
    ratio = np.log((toxic / (y.sum() + 2)) / (clean / ((1 - y).sum() + 2))).astype(np.float32)
    both = toxic + clean - 1
    share = np.minimum(both / len(y), 1 - 1e-9)
    error = np.sqrt(share * (1 - share) * (1 / y.sum() + 1 / (1 - y).sum()))
    useful = (np.abs(toxic / (y.sum() + 2) - clean / ((1 - y).sum() + 2)) >= LEAST_Z * error) & (both > LEAST_DOCS)
    docs, feats, values = [], [], []  # the second pass keeps useful features only, so the driver holds little
    for lo, _, data, offs in byte_chunks(column, rows=ROWS):
        doc, feat, value = ngram_features(data, offs)
        keep = useful[feat]
        docs.append(doc[keep].astype(np.int32) + lo)
        feats.append(feat[keep])
        values.append(value[keep])
    cols = np.flatnonzero(useful)
    place = np.zeros(size, np.int32)
    place[cols] = np.arange(len(cols))
    doc, feat = np.concatenate(docs), place[np.concatenate(feats)]
    x = ratio[cols][feat] * np.concatenate(values)
    del docs, feats, values
    w, b = np.zeros(len(cols)), np.zeros(1)

    def gradient(params, _):
        w, b = params
        z = np.bincount(doc, x * w.astype(np.float32)[feat], len(y)) + b[0]
        e = sigmoid(z) - y
        return [np.bincount(feat, x * e.astype(np.float32)[doc], len(cols)) / len(y) + penalty * w, np.array([e.mean()])]

    adam([w, b], gradient, steps, 0.02)
    out = np.zeros(size, np.float32)
    out[cols] = w * ratio[cols]
    return out, float(b[0] + prior_shift(y, counts))


def scorer(weights: np.ndarray, bias: float):
    def score(data, offs, _):
        doc, feat, value = ngram_features(data, offs)
        return sigmoid(np.bincount(doc, weights[feat] * value, len(offs) - 1) + bias)

    return score


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    rows, counts = labelled_sample(docs, labels, "toxic", ["text"])
    weights, bias = fit([r[0] for r in rows], np.array([r[1] for r in rows], np.float64), counts)
    model = docs.sparkSession.sparkContext.broadcast((weights, bias))  # 2^BITS floats
    return score_texts(docs, lambda: scorer(*model.value), threshold, [], ROWS)
