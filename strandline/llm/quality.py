"""Quality: a factorisation machine over hashed words, structure statistics and metadata.

A document's features are its distinct hashed words (each with weight 1 / sqrt(number of distinct words)), one bin of each
structure statistic and one bin of each metadata value (the stated n_chars, and whether it agrees with the text).  The score
is a logistic function of  b + sum(w x) + pairs(<v_i, v_j> x_i x_j), where the pairwise sum is computed in linear time as
half of  (sum v x)^2 - sum (v x)^2  per factor.

Defined cases: null and empty texts have only the bins of empty texts; null metadata has a bin of its own; without labels
of both classes every score is the share of label 1 (0 without any); repeated rows are scored alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import WORD_LUT, byte_chunks, word_hashes, words_of
from .labelled import adam, labelled_sample, prior_shift, score_texts, sigmoid, unique_features

BITS = 18
FACTORS = 4
BINS = 16
ROWS = 1 << 13
THRESHOLD = 0.3
STATISTICS = ("length", "words", "mean word", "distinct words", "upper case", "digits", "marks", "other marks", "blanks", "line length", "non-ASCII", "stated length", "agreement")
N_FEATURES = (1 << BITS) + BINS * len(STATISTICS)


def _counts(flag: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
    return (total[offs[1:]] - total[offs[:-1]]).astype(np.float64)


_UPPER, _DIGIT, _MARK, _OTHER, _BLANK = (np.zeros(256, bool) for _ in range(5))
_UPPER[65:91] = _DIGIT[48:58] = True
_MARK[[ord(c) for c in ".,;:!?'\"()-"]] = True
_BLANK[[9, 10, 13, 32]] = True
_OTHER[33:127] = True
_OTHER[65:91] = _OTHER[97:123] = False
_OTHER &= ~_MARK & ~_DIGIT


def statistics(data, offs, n_words, n_distinct, stated) -> np.ndarray:
    """[documents, statistics] of bins 0 .. BINS - 1."""
    size = np.diff(offs).astype(np.float64)
    some, words = np.maximum(size, 1), np.maximum(n_words, 1)
    upper, marks = _counts(_UPPER[data], offs), _counts(_MARK[data], offs)
    lines = _counts(data == 10, offs) + 1
    known = ~np.isnan(stated)
    agree = np.where(known, 1 + (np.abs(np.nan_to_num(stated) - size) > 0.2 * some), 0)
    raw = [
        np.log2(size + 1),
        np.log2(n_words + 1),
        2 * (size / words - 2),
        BINS * n_distinct / words,
        BINS * np.sqrt(upper / some),
        BINS * np.sqrt(_counts(_DIGIT[data], offs) / some),
        BINS * np.sqrt(marks / some),
        BINS * np.sqrt(_counts(_OTHER[data], offs) / some),
        2 * BINS * _counts(_BLANK[data], offs) / some,
        np.log2(size / lines + 1),
        BINS * np.sqrt(_counts(data >= 128, offs) / some),
        np.where(known, 1 + np.log2(np.maximum(np.nan_to_num(stated), 0) + 1), 0),
        agree,
    ]
    return np.clip(np.array(raw).T, 0, BINS - 1).astype(np.int64)


def features(data, offs, stated) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, value) of a chunk, by document."""
    n = len(offs) - 1
    starts, ends, doc, norm = words_of(data, offs, WORD_LUT)
    h = word_hashes(norm, starts, ends)
    d, f = unique_features(doc, h >> np.uint64(64 - BITS), BITS)
    distinct = np.bincount(d, minlength=n).astype(np.float64)
    bins = statistics(data, offs, np.bincount(doc, minlength=n).astype(np.float64), distinct, stated)
    placed = bins + (1 << BITS) + BINS * np.arange(len(STATISTICS))
    doc = np.concatenate([d.astype(np.int64), np.repeat(np.arange(n), len(STATISTICS))])
    value = np.concatenate([1 / np.sqrt(distinct[d]), np.ones(placed.size)])
    return doc, np.concatenate([f.astype(np.int64), placed.ravel()]), value


def logit(doc, feat, x, n, w, v, b) -> tuple[np.ndarray, list]:
    """Scores of n documents and the factor sums, in time linear in the number of features."""
    z, sums = np.bincount(doc, x * w[feat], n) + b, []
    for k in range(v.shape[1]):
        t = x * v[feat, k]
        s = np.bincount(doc, t, n)
        z += 0.5 * (s * s - np.bincount(doc, t * t, n))
        sums.append((t, s))
    return z, sums


def fit(rows: list, counts: dict[int, int], penalty: float = 1e-4, steps: int = 120, seed: int = 5):
    """(w, v, b) from (text, n_chars, label) rows."""
    w, v = np.zeros(N_FEATURES), np.zeros((N_FEATURES, FACTORS))
    y = np.array([r[2] for r in rows], np.float64)
    if not len(y) or y.min() == y.max():
        share = counts.get(1, 0) / max(1, sum(counts.values()))
        return w, v, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    stated = np.array([np.nan if r[1] is None else float(r[1]) for r in rows])
    parts = []
    for lo, hi, data, offs in byte_chunks(pa.array([r[0] for r in rows], pa.large_string()), rows=ROWS):
        d, f, x = features(data, offs, stated[lo:hi])
        parts.append((d + lo, f, x))
    doc, feat, x = (np.concatenate(p) for p in zip(*parts))
    common = np.bincount(feat, minlength=N_FEATURES) >= 3
    keep = common[feat]
    doc, x = doc[keep], x[keep]
    cols, feat = np.unique(feat[keep], return_inverse=True)
    a, c = np.zeros(len(cols)), np.random.default_rng(seed).normal(0, 0.05, (len(cols), FACTORS))
    b = np.zeros(1)

    def gradient(params, _):
        a, c, b = params
        z, sums = logit(doc, feat, x, len(y), a, c, b[0])
        e = (sigmoid(z) - y) / len(y)
        ex = x * e[doc]
        back = np.stack([np.bincount(feat, ex * (s[doc] - t), len(cols)) for t, s in sums], axis=1)
        return [np.bincount(feat, ex, len(cols)) + penalty * a, back + penalty * c, np.array([e.sum()])]

    adam([a, c, b], gradient, steps, 0.05)
    w[cols], v[cols] = a, c
    return w, v, float(b[0] + prior_shift(y, counts))


def scorer(w, v, b):
    def score(data, offs, columns):
        stated = columns[0].to_numpy(zero_copy_only=False).astype(np.float64)
        doc, feat, x = features(data, offs, stated)
        return sigmoid(logit(doc, feat, x, len(offs) - 1, w, v, b)[0])

    return score


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted.  docs without a column n_chars count as rows whose n_chars is null."""
    from pyspark.sql import functions as F

    docs = docs.select("doc_id", "text", F.col("n_chars").cast("double").alias("n_chars") if "n_chars" in docs.columns else F.lit(None).cast("double").alias("n_chars"))
    rows, counts = labelled_sample(docs, labels, "quality", ["text", "n_chars"])
    w, v, b = fit(rows, counts)
    model = docs.sparkSession.sparkContext.broadcast((w.astype(np.float32), v.astype(np.float32), b))  # N_FEATURES rows
    return score_texts(docs, lambda: scorer(*model.value), threshold, ["n_chars"], ROWS)
