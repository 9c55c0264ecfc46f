"""Benchmark decontamination with one Aho-Corasick automaton over normalised benchmark windows.

A window is ``window`` consecutive words of an item (a shorter item that has words is one window).  Texts are lower-cased
(A-Z) and reduced to words of ASCII letters, digits and all non-ASCII characters.  Each document is scanned once; every
match is mapped to the words it covers and to the byte offsets of the original text.

Defined cases: a null or empty text has no words and no hits; an empty benchmark hits nothing; repeated items count by
their distinct item_id; null item_ids are left out of the id list but their windows hit.  The automaton holds the windows of
``GROUP_WORDS`` benchmark words; Spark cuts a larger benchmark into segments (with an overlap, so every window is whole in one)
and deals these into groups.  Only one group at a time is on the driver; each is broadcast and scanned over the documents in turn,
and the hits are united, so nothing is dropped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_LUT, materialise, small_batches

WINDOW = 13
#: Benchmark words of one automaton (some 150 MB a worker at most), and of one segment of an item.
GROUP_WORDS = 40_000
SEGMENT_WORDS = 4_000
#: Groups that are scanned in one pass over the documents, each by Python workers of its own.
CHAIN = 4
WORDS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

_TABLE = bytes(int(b) or 32 for b in WORD_LUT)
_built: dict[str, object] = {}


def normal_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


def windows_of(text: str, window: int = WINDOW) -> list[bytes]:
    words = normal_words(text)
    if not words:
        return []
    n = max(1, len(words) - window + 1)
    return [b" " + b" ".join(words[i : i + window]) + b" " for i in range(n)]


def automaton(items: list, window: int):
    """(automaton, number of words of each pattern is in its value); kept per worker."""
    import ahocorasick

    stamp = hashlib.sha256(repr((window, items)).encode()).hexdigest()
    if stamp not in _built:
        owners: dict[bytes, set] = {}
        for item, text in items:
            for w in windows_of(text or "", window):
                owners.setdefault(w, set()).add(item)
        a = ahocorasick.Automaton()
        for w, own in owners.items():
            a.add_word(w.decode("latin-1"), (w.count(b" ") - 1, len(w), tuple(own)))
        if owners:
            a.make_automaton()
        _built.clear()
        _built[stamp] = a if owners else None
    return _built[stamp]


def scan(text: str | None, found) -> tuple[int, list[tuple[int, int]], set]:
    """Words of the text, hit word ranges [from, to) in order of their end, items with occurring windows."""
    words = normal_words(text or "")
    if not words or found is None:
        return len(words), [], set()
    norm = b" " + b" ".join(words) + b" "
    spans, items = [], set()
    matches = list(found.iter(norm.decode("latin-1")))
    if matches:
        blanks = np.cumsum(np.frombuffer(norm, np.uint8) == 32)
        for end, (n, _, own) in matches:
            last = int(blanks[end]) - 1  # words that end before this blank
            spans.append((last - n, last))
            items.update(own)
    return len(words), spans, items


def word_offsets(text: str) -> list[tuple[int, int]]:
    """Byte range in the original UTF-8 text of each normalised word."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_TABLE), np.uint8)
    inside = np.concatenate([[False], raw != 32, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def segments(benchmark: DataFrame, window: int = WINDOW, length: int | None = None) -> DataFrame:
    """item_id, text (normalised words), n_words of overlapping segments: each window of an item is whole in one of them."""
    length = max(window, length or SEGMENT_WORDS)
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = benchmark.select("item_id", F.regexp_extract_all(low, F.lit(WORDS), F.lit(0)).alias("w")).where(F.size("w") > 0).distinct()
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window + 1), F.lit(length - window + 1)))
    cut = words.select("item_id", "w", at.alias("at")).select("item_id", F.expr(f"slice(w, at, {length})").alias("w"))
    return cut.select("item_id", F.array_join("w", " ").alias("text"), F.size("w").alias("n_words"))


def grouped(parts: DataFrame) -> tuple[DataFrame, int]:
    """Segments with the number of their group, and the number of groups: at most about GROUP_WORDS words each."""
    total = parts.agg(F.sum("n_words")).first()[0] or 0
    n = max(1, -(-int(total) * 3 // (GROUP_WORDS * 2))) if total > GROUP_WORDS else 1
    return parts.withColumn("group", F.pmod(F.xxhash64("item_id", "text"), F.lit(n))), n


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (byte offsets of the hits).

    ``contaminated``: n_hit > 0 and share * n_hit >= n_words.
    """
    return judged(hits(docs.select("doc_id", "text"), benchmark, window, "doc_id"), share)


def hits(docs: DataFrame, benchmark: DataFrame, window: int, keep: str) -> DataFrame:
    """docs with __n_words, __n_hit (words), __items and __spans (byte ranges) for each row."""
    names = [c for c in docs.columns if c != "text" or keep == "*"]
    rows = small_batches(docs if keep == "*" else docs.select(*dict.fromkeys([*names, "text"])))
    types, carried = dict(rows.dtypes), list(rows.columns)
    places = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    parts, n = grouped(segments(benchmark, window))
    parts = materialise(parts, "segments") if n > 1 else parts
    context = docs.sparkSession.sparkContext

    def of(batch: pa.RecordBatch, name: str) -> pa.Array:
        return batch.column(batch.schema.get_field_index(name))

    def scanner(model, first: bool, last: bool):
        """One pass of one group: adds its hit word ranges (flat: from, to, ...) and items to those of the groups before."""

        def run(batches):
            automaton_ = automaton(model.value, window)
            for batch in batches:
                texts = of(batch, "text").to_pylist()
                words, items, size = [], [], []
                for t in texts:
                    n_words, spans, own = scan(t, automaton_)
                    size.append(n_words)
                    words.append([x for s in merged(spans) for x in s])
                    items.append({str(x) for x in own if x is not None})
                if not first:
                    for got, old in zip(words, of(batch, "__words").to_pylist()):
                        got.extend(old)
                    for got, old in zip(items, of(batch, "__items").to_pylist()):
                        got.update(old)
                held = [pa.array([sorted(x) for x in items], pa.list_(pa.string()))]
                if not last:
                    kept = [of(batch, c) for c in carried]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(words, pa.list_(pa.int64())), *held], [*carried, "__words", "__items"])
                    continue
                runs = [merged(list(zip(w[::2], w[1::2]))) for w in words]
                where = [[{"a": o[a][0], "b": o[b - 1][1]} for a, b in r] if r and (o := word_offsets(t)) else [] for r, t in zip(runs, texts)]
                added = [pa.array(size, pa.int64()), pa.array([sum(b - a for a, b in r) for r in runs], pa.int64()), *held, pa.array(where, places)]
                yield pa.RecordBatch.from_arrays([*[of(batch, c) for c in names], *added], [*names, "__n_words", "__n_hit", "__items", "__spans"])

        return run

    between = ", ".join(f"`{c}` {types[c]}" for c in carried) + ", __words array<long>, __items array<string>"
    final = ", ".join(f"`{c}` {types[c]}" for c in names) + ", __n_words long, __n_hit long, __items array<string>, __spans array<struct<a:long,b:long>>"
    for g in range(n):
        own = parts.where(F.col("group") == g).select("item_id", "text").collect()  # about GROUP_WORDS words
        model = context.broadcast(sorted(((r["item_id"], r["text"]) for r in own), key=str))
        rows = rows.mapInArrow(scanner(model, g == 0, g == n - 1), final if g == n - 1 else between)
        if g % CHAIN == CHAIN - 1 and g < n - 1:
            rows = materialise(rows, "scanned")
    return rows


def judged(found: DataFrame, share: int) -> DataFrame:
    return found.select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        F.col("__n_hit").alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
        ((F.col("__n_hit") > 0) & (F.col("__n_hit") * share >= F.col("__n_words"))).alias("contaminated"),
        F.col("__spans").alias("spans"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """The documents that are not contaminated, columns unchanged."""
    found = hits(docs, benchmark, window, "*")
    return found.where(~((F.col("__n_hit") > 0) & (F.col("__n_hit") * share >= F.col("__n_words")))).select(*docs.columns)

