"""Language identification by multilingual mixture inference.

Language models are hashed character-trigram tables (words with their borders, so that each word's likelihood is the
product over its trigrams), fitted on a bounded sample of labelled texts per language.  Each document is a mixture: every
word comes from one of the languages, and expectation-maximisation estimates the document's proportions from the words'
likelihoods.  The set of languages is chosen among the nested sets by estimated share, by likelihood minus a penalty per
language; proportions of the chosen set are then estimated anew.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; without learned languages every text is;
languages with fewer texts than the sample size use all they have; ties go to the language that sorts first; repeated rows
are judged alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LETTER_LUT, byte_chunks, fold, small_batches, words_of
from .labelled import rows_within

BITS = 16
#: Texts a language model is fitted on, per language, and bytes of them, per language.
SAMPLE_PER_LANGUAGE = 600
SAMPLE_BYTES = 1 << 24
STEPS = 8
ROWS = 1 << 13
#: Cost of a language in the set, in units of log(number of words); and its least share.
PENALTY = 2.0
LEAST_SHARE = 0.05
HELD_OUT = 2
FOLDS = 4
LETTER = regex.compile(r"\p{L}")


def trigram_words(data: np.ndarray, offs: np.ndarray):
    """Hashed trigrams of each word with its borders: (first trigram of each word, document of each word, trigrams)."""
    starts, ends, doc, norm = words_of(data, offs, LETTER_LUT)
    if not len(starts):
        return np.zeros(0, np.int64), doc, np.zeros(0, np.int64)
    size = ends - starts
    first = np.cumsum(size) - size
    inside = norm != 0
    at = np.flatnonzero(inside)
    cur = norm[at].astype(np.uint32)
    before, after = np.zeros_like(cur), np.zeros_like(cur)
    before[1:], after[:-1] = cur[:-1], cur[1:]
    before[first] = 0
    after[first + size - 1] = 0
    h = (before << np.uint32(16) | cur << np.uint32(8) | after) * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    return first, doc, (h >> np.uint32(32 - BITS)).astype(np.int64)


def fit(texts: list[str], langs: list[str]) -> tuple[list[str], np.ndarray]:
    """Languages in order, and log-likelihoods [bucket, language] with add-half smoothing."""
    names = sorted(set(langs))
    at = {n: i for i, n in enumerate(names)}
    counts = np.full((1 << BITS, len(names)), 0.5)
    own = np.array([at[x] for x in langs], np.int64)
    for lo, hi, data, offs in byte_chunks(pa.array(texts, pa.large_string()), rows=ROWS):
        first, doc, tri = trigram_words(data, offs)
        if len(first):
            lang = np.repeat(own[lo:hi][doc], np.diff(np.append(first, len(tri))))
            counts += np.bincount(tri * len(names) + lang, minlength=counts.size).reshape(counts.shape)
    return names, np.log(counts / counts.sum(axis=0)).astype(np.float32)


def mixtures(data: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(proportions [document, language], words [document]); a language outside the chosen set has proportion 0."""
    n, k = len(offs) - 1, table.shape[1]
    first, doc, tri = trigram_words(data, offs)
    words = np.bincount(doc, minlength=n)
    shares = np.zeros((n, k))
    has = np.flatnonzero(words)
    if not len(has) or not k:
        return shares, words
    logs = np.add.reduceat(table[tri], first, axis=0)
    logs -= logs.max(axis=1, keepdims=True)
    like = np.exp(np.maximum(logs, -60)).astype(np.float32)
    begin = (np.cumsum(words) - words)[has]
    row = np.repeat(np.arange(len(has)), words[has])
    m = words[has].astype(np.float32)

    def estimate(pi: np.ndarray, steps: int) -> np.ndarray:
        for _ in range(steps):
            r = like * pi[row]
            r /= r.sum(axis=1, keepdims=True) + np.float32(1e-30)
            pi = np.add.reduceat(r, begin, axis=0) / m[:, None]
        return pi

    pi = estimate(np.full((len(has), k), 1 / k, np.float32), STEPS)
    order = np.argsort(-pi, axis=1, kind="stable")
    ranked = np.take_along_axis(pi, order, axis=1)
    best, chosen = np.full(len(has), -np.inf), np.ones(len(has), np.int64)
    for size in range(1, min(k, int(1 / LEAST_SHARE)) + 1):  # nested sets by share; none has more than 1 / LEAST_SHARE members
        open_ = ranked[:, size - 1] >= (LEAST_SHARE if size > 1 else 0)  # shares only fall: who is out stays out
        if not open_.any():
            break
        inside = np.zeros_like(pi[open_])
        np.put_along_axis(inside, order[open_, :size], ranked[open_, :size], axis=1)
        inside /= inside.sum(axis=1, keepdims=True) + np.float32(1e-30)
        size_of, used = words[has][open_], open_[row]
        at = np.repeat(np.arange(len(size_of)), size_of)
        seen = np.add.reduceat(np.log((like[used] * inside[at]).sum(axis=1) + np.float32(1e-26)), np.cumsum(size_of) - size_of)
        value = np.full(len(has), -np.inf)
        value[open_] = seen - PENALTY * size * np.log(m[open_] + 1)
        better = value > best
        best, chosen = np.where(better, value, best), np.where(better, size, chosen)
    keep = np.zeros_like(pi)
    np.put_along_axis(keep, order, (np.arange(k) < chosen[:, None]).astype(np.float32), axis=1)
    pi = pi * keep
    pi /= pi.sum(axis=1, keepdims=True)
    if (chosen > 1).any():
        pi = estimate(pi, 3)
    shares[has] = pi
    return shares, words


def language_sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, most_bytes: int = SAMPLE_BYTES) -> tuple[list[str], list[str]]:
    """Texts and languages of the training folds: the smallest hashes of the id in each language, per_language documents and
    most_bytes of text at most, texts of any length among them (see rows_within)."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", FOLDS) != HELD_OUT)).select("doc_id", "lang", F.xxhash64("doc_id").alias("__h"))
    counts = {r["lang"]: max(1, r["n"]) for r in known.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).collect()}
    if not counts:
        return [], []
    # a hash range that holds twice the sample's ids on average, then the smallest: no language is gathered whole, and an id
    # counts once, however many rows repeat it
    rate = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, (2.0 * per_language + 50) / n))])
    close = known.where((F.col("__h") / F.lit(2.0**64) + 0.5) < F.element_at(rate, F.col("lang"))).distinct()
    turn = Window.partitionBy("lang").orderBy("__h", "doc_id")
    picked = close.withColumn("__n", F.row_number().over(turn)).where(F.col("__n") <= per_language).select("doc_id", "lang")
    picked = picked.withColumnRenamed("lang", "__lang")
    got = rows_within(docs.select("doc_id", "text", "lang").where("text is not null"), picked, ["text", "lang"], "__lang", most_bytes)
    got = sorted((lang, text) for text, lang, own in got if lang == own)
    return [t for _, t in got], [g for g, _ in got]


def judged(docs: DataFrame, names: list[str], table: np.ndarray, columns: list[str]) -> DataFrame:
    """columns of docs with __lang, __score (share of the leading language) and __shares (language to share)."""
    model = docs.sparkSession.sparkContext.broadcast((names, table))  # 2^BITS rows of one float a language

    def run(batches):
        names, table = model.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for lo, hi, data, offs in byte_chunks(texts, rows=ROWS):
                shares, words = mixtures(data, offs, table)
                known = words > 0
                for i in np.flatnonzero(known):  # words of other marks or of letters? only rare texts are looked at
                    part = data[offs[i] : offs[i + 1]]
                    if not (((part | 32) >= 97) & ((part | 32) <= 122)).any():
                        known[i] = LETTER.search(part.tobytes().decode("utf-8", "ignore")) is not None
                lead = shares.argmax(axis=1) if len(names) else np.zeros(hi - lo, int)
                known &= len(names) > 0
                lang = [names[j] if ok else "und" for j, ok in zip(lead, known)]
                score = np.where(known, shares.max(axis=1) if len(names) else 0.0, 0.0)
                maps = [[(names[j], float(s[j])) for j in np.flatnonzero(s)] if ok else [] for s, ok in zip(shares, known)]
                kept = [batch.column(batch.schema.get_field_index(c)).slice(lo, hi - lo) for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(lang, pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(maps, pa.map_(pa.string(), pa.float64()))], [*columns, "__lang", "__score", "__shares"]
                )

    types = dict(docs.dtypes)
    shape = ", ".join(f"`{c}` {types[c]}" for c in columns) + ", __lang string, __score double, __shares map<string,double>"
    return small_batches(docs).select(*dict.fromkeys([*columns, "text"])).mapInArrow(run, shape)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, shares."""
    names, table = fit(*language_sample(docs))
    out = judged(docs, names, table, ["doc_id"])
    return out.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"), F.col("__shares").alias("shares"))


def keep_identified(docs: DataFrame, least: float = 0.4) -> DataFrame:
    """The documents with a leading language of at least that share; columns unchanged."""
    names, table = fit(*language_sample(docs))
    out = judged(docs, names, table, docs.columns)
    return out.where((F.col("__lang") != "und") & (F.col("__score") >= least)).select(*docs.columns)

