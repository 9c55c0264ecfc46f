"""What the two text classifiers share: a bounded labelled sample, and scoring of every whole text by chunks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_chunks, fold, small_batches

#: Labelled documents a model is fitted on, per class, and bytes of their texts, per class: bounds the driver's memory.
SAMPLE_PER_CLASS = 2000
SAMPLE_BYTES = 1 << 25
FOLDS = 5


def fitting(sizes: list[tuple], most_bytes: int) -> list[tuple]:
    """Of (group, order, bytes, ...) the rows that are taken in order while their group's bytes stay within most_bytes.

    A row that doesn't fit is passed over and counts nothing, so one long text keeps no other one out.
    """
    left: dict = {}
    out = []
    for row in sorted(sizes, key=lambda r: (str(r[0]), r[1])):
        if row[2] <= left.setdefault(row[0], most_bytes):
            left[row[0]] -= row[2]
            out.append(row)
    return out


def rows_within(docs: DataFrame, picked: DataFrame, columns: list[str], group: str, most_bytes: int) -> list:
    """Rows (*columns, group) of docs for picked (doc_id, group; a bounded table), with whole texts, in order of their id's hash
    as long as a group's texts have most_bytes together; a text that doesn't fit is passed over.

    One row stands for a repeated id: that with the smallest hash.  Sizes (a number for each picked document) are looked at before
    any text is gathered.
    """
    rows = docs.join(F.broadcast(picked.withColumnRenamed(group, "__group")), "doc_id").withColumn("__h", F.xxhash64(*columns))
    sizes = rows.groupBy("doc_id", "__group").agg(F.min_by(F.coalesce(F.octet_length("text"), F.lit(0)), "__h").alias("bytes"), F.min("__h").alias("__h"))
    known = sizes.select("doc_id", "__group", "__h", "bytes", F.xxhash64("doc_id").alias("turn"))
    chosen = fitting([(r["__group"], (r["turn"], r["doc_id"]), r["bytes"], r["doc_id"], r["__h"]) for r in known.collect()], most_bytes)
    if not chosen:
        return []
    shape = known.select("doc_id", "__group", "__h").schema
    chosen = F.broadcast(docs.sparkSession.createDataFrame([(r[3], r[0], r[4]) for r in chosen], shape))
    got = rows.join(chosen, ["doc_id", "__group", "__h"]).select("doc_id", "__h", *columns, "__group").dropDuplicates(["doc_id", "__h", "__group"]).collect()
    return [tuple(r)[2:] for r in sorted(got, key=lambda r: (r["doc_id"], r["__h"], str(r["__group"])))]


def labelled_ids(labels: DataFrame, label: str, per_class: int) -> tuple[DataFrame | None, dict[int, int]]:
    """doc_id, __y of the per_class smallest hashes of the id in each class of the training fold (None without labels), and the
    number of labelled documents per class.

    Contradicting repeated labels of one document count once, by the larger; null labels and labels other than 0 and 1 are left out.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (fold("doc_id", FOLDS) != 0)).groupBy("doc_id").agg(F.max(label).alias("__y"))
    counts = {int(r["__y"]): r["n"] for r in known.groupBy("__y").agg(F.count("*").alias("n")).collect()}
    picked = None
    for y in sorted(counts):
        part = known.where(F.col("__y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    return picked, counts


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, columns: list[str], per_class: int = SAMPLE_PER_CLASS, most_bytes: int = SAMPLE_BYTES) -> tuple[list, dict[int, int]]:
    """Rows (*columns, label) of a bounded sample of the training fold, and the number of labelled documents per class.

    The sample takes the smallest hashes of the id in each class, so it is the same in every run: per_class documents and
    most_bytes of text at most, texts of any length among them (one that no longer fits is passed over, the next are not).
    """
    picked, counts = labelled_ids(labels, label, per_class)
    if picked is None:
        return [], {}
    return rows_within(docs.where("text is not null"), picked, columns, "__y", most_bytes), counts


def prior_shift(y: np.ndarray, counts: dict[int, int]) -> float:
    """What to add to a logit fitted on the sample so that it speaks of all labelled documents."""
    ones, zeros = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    return float(np.log(max(1, counts.get(1, 0)) / max(1, counts.get(0, 0))) - np.log(ones / zeros))


def unique_features(doc: np.ndarray, feature: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, feature) pairs, sorted; documents of a chunk number fewer than 2^(32 - bits)."""
    key = np.sort((doc.astype(np.uint32) << np.uint32(bits)) | feature.astype(np.uint32))
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    return key >> np.uint32(bits), key & np.uint32((1 << bits) - 1)


def score_texts(docs: DataFrame, scorer: Callable[[], Callable], threshold: float, extra: list[str], rows: int) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    scorer() makes a function (bytes, offsets, columns) -> scores of the documents of one chunk.
    """

    def run(batches):
        score = scorer()
        for batch in batches:
            for lo, hi, data, offs in byte_chunks(batch.column(1), rows=rows):
                s = score(data, offs, [batch.column(2 + i).slice(lo, hi - lo) for i in range(len(extra))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(s, pa.float64())], ["doc_id", "score"])

    wanted = small_batches(docs).select("doc_id", "text", *extra)
    scored = wanted.mapInArrow(run, f"doc_id {dict(wanted.dtypes)['doc_id']}, score double")
    return scored.select("doc_id", (fold("doc_id", FOLDS) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def adam(params: list[np.ndarray], gradient: Callable, steps: int, rate: float) -> None:
    """In-place Adam; gradient(params) gives one array per parameter."""
    m = [np.zeros_like(p) for p in params]
    v = [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        for p, g, a, b in zip(params, gradient(params, step), m, v):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
