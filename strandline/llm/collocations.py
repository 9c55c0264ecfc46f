"""Phrase collocations by SON partitioning.

Phrases are contiguous words inside a piece of text.  The input is split into ``SHARDS`` shards (each a set of partitions, so a
shard is as many tasks as it needs).  A phrase that occurs ``support`` times in all occurs support / SHARDS times in some shard,
whatever the split; so each shard is mined completely at that lower support, level by level: words first, then phrases of two words that
are both frequent, then phrases whose both shorter parts are.  The union of what is frequent in some shard is a superset of the
frequent phrases; in a last pass over the texts these are counted exactly, by their words, and judged by the global support.

Inside a task words are exact numbers (equal bytes, equal number), counted chunk by chunk.  Between tasks the mining passes only
exchange 64-bit hashes and counts: phrases that share a hash can only make the superset larger.  The superset reaches the tasks
as a bitmap of 8 bits or more a hash and ``MAX_BITS`` at most (64 MB): beyond that it passes more phrases on, and none is lost, since the
last pass counts by words.  Longer phrases are only counted where their parts are frequent, so what is exchanged follows the
frequent phrases.

A phrase's score is the least, over its cuts in two, of floor(10^6 a^2 / (l r)), in exact decimals.  A phrase inside a longer one
that has half of its occurrences is dropped.  The first ``top`` phrases of a language are found in two steps, the first spread over
tasks, so one common language is no large task.

Defined cases: a null text has no words; a null lang is ``und``, and so is the lang ``und``; repeated rows count as often as they stand; very
long words and texts are taken whole; ties are in byte order of the phrase; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_chunks, materialise, mix64, small_batches, split_join, word_hashes
from .exact_words import byte_set, gathered, interned, numbered, runs

SUPPORT = 10
SHARDS = 4
LONGEST = 3
TOP = 2000
#: A phrase is dropped if a longer one around it has this percentage of its occurrences.
INSIDE = 50
MIN_BITS, MAX_BITS = 20, 29
CHUNK = 1 << 22
SEGMENT_BITS = 19
_U = np.uint64
_BREAK = byte_set(b".,;:!?\n\x0b\x0c\r")
_WORD = ~(_BREAK | byte_set(b" \t"))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Bitmap:
    """A set of 64-bit hashes by their leading bits; it may hold more than was put in, never less."""

    def __init__(self, data: np.ndarray, bits: int):
        self.data, self.shift = data, _U(64 - bits)

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h >> self.shift
        return (self.data[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8) & 1).astype(bool)


def bitmap(hashes: DataFrame) -> Bitmap:
    """The bitmap of a table of hashes (h): at most 2^MAX_BITS bits reach the driver, in segments that tasks put together."""
    n = hashes.count()
    bits = min(MAX_BITS, max(MIN_BITS, math.ceil(math.log2(8 * n + 1))))
    rest, size = bits - SEGMENT_BITS, 1 << SEGMENT_BITS

    def build(batches):
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column(1).to_numpy().view(_U) >> _U(64 - bits)
            for s in np.unique(at >> _U(SEGMENT_BITS)):
                own = at[at >> _U(SEGMENT_BITS) == s] & _U(size - 1)
                parts.setdefault(int(s), np.zeros(size, bool))[own.astype(np.int64)] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int64()), pa.array([np.packbits(p, bitorder="little").tobytes() for p in parts.values()], pa.binary())], ["segment", "bits"])

    segment = F.shiftrightunsigned("h", 64 - rest).alias("segment")
    rows = hashes.select(segment, "h").repartition(min(1 << rest, 64), "segment").mapInArrow(build, "segment long, bits binary").collect()
    data = np.zeros(1 << (bits - 3), np.uint8)
    for r in rows:
        data[r["segment"] * size // 8 : (r["segment"] + 1) * size // 8] = np.frombuffer(r["bits"], np.uint8)
    return Bitmap(data, bits)


class Chunk:
    """The words of a chunk of texts: piece by piece, as exact numbers of (language, word)."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, langs: pa.Array):
        starts, ends, doc = runs(_WORD[data], offs)
        brk = np.cumsum(_BREAK[data], dtype=np.int64)
        self.piece = brk[starts] + doc * (int(brk[-1]) + 1 if len(brk) else 1)
        word, self.words = interned(_LOWER[data], starts, ends)
        coded = langs.dictionary_encode()
        self.langs = coded.dictionary
        lang = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[doc]
        self.word = word
        size = max(1, len(self.words))
        self.code, both = numbered(lang * size + word)
        self.lang_of, self.word_of = both // size, both % size  # of each number

    def hashes(self) -> np.ndarray:
        """A hash of each (language, word)."""

        def of(column: pa.Array) -> np.ndarray:
            _, offs, data = column.buffers()
            offs = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
            some = np.flatnonzero(np.diff(offs))
            out = np.full(len(column), 0x5851F42D4C957F2D, _U)
            if len(some):
                out[some] = word_hashes(np.frombuffer(data, np.uint8)[offs[0] : offs[-1]], offs[some] - offs[0], offs[some + 1] - offs[0])
            return out

        langs = of(self.langs.cast(pa.large_binary()))
        return mix64(of(self.words)[self.word_of] ^ (langs[self.lang_of] * _U(0x9E3779B97F4A7C15)))

    def levels(self, maps: list[Bitmap], longest: int):
        """For k = 2..longest: places of phrases of k words whose shorter parts may be frequent, the number of each, first places of
        the numbers, their hashes and counts.  maps: by length, as far as they are known."""
        n, single = len(self.code), self.hashes()
        hashed, code = single, self.code
        ok = maps[0].has(single)[code] if len(code) else np.zeros(0, bool)
        for k in range(2, longest + 1):
            at = np.flatnonzero(ok[:-1] & ok[1:]) if n > 1 else np.zeros(0, np.int64)  # a phrase starts here, and one at the next word
            at = at[at + k <= n]
            at = at[self.piece[at] == self.piece[at + k - 1]]
            size = len(single) + 1
            number, both = numbered(code[at] * size + self.code[at + k - 1])
            hashed = mix64(hashed[both // size] * _U(31) + single[both % size] + _U(k))
            first = np.full(len(both), -1, np.int64)
            first[number[::-1]] = at[::-1]
            yield k, first, hashed, np.bincount(number, minlength=len(both))
            if k == longest:
                return
            code, ok = np.zeros(n, np.int64), np.zeros(n, bool)
            code[at] = number
            ok[at] = maps[k - 1].has(hashed)[number]

    def text(self, first: np.ndarray, k: int) -> pa.Array:
        """The phrases of k words that start at these words."""
        parts = [self.words.take(pa.array(self.word[first + i])) for i in range(k)]
        return pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))

    def lang(self, first: np.ndarray) -> pa.Array:
        return self.langs.take(pa.array(self.lang_of[self.code[first]]))


def chunks(batches):
    """Chunks of batches (lang, text)."""
    for batch in gathered(batches, 1, CHUNK):
        langs = batch.column(0)
        for lo, hi, data, offs in byte_chunks(batch.column(1), CHUNK):
            yield Chunk(data, offs, langs.slice(lo, hi - lo))


def word_counts(texts: DataFrame) -> DataFrame:
    """lang, phrase, f, h (hash) of every word."""

    def run(batches):
        for c in chunks(batches):
            count = np.bincount(c.code, minlength=len(c.word_of))
            columns = [c.langs.take(pa.array(c.lang_of)), c.words.take(pa.array(c.word_of)).cast(pa.large_string()), pa.array(c.hashes().view(np.int64)), pa.array(count)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "h", "f"])

    rows = texts.mapInArrow(run, "lang string, phrase string, h long, f long")
    return rows.groupBy("lang", "phrase").agg(F.sum("f").alias("f"), F.min("h").alias("h"))


def locally_frequent(texts: DataFrame, maps: list[Bitmap], k: int, support: int, shards: int) -> DataFrame:
    """Hashes of phrases of k words that are frequent in some shard at the shard's support."""
    known = texts.sparkSession.sparkContext.broadcast(maps)  # 2^MAX_BITS bits a level at most

    def run(batches):
        shard = TaskContext.get().partitionId() % shards
        for c in chunks(batches):
            for level, _, hashed, count in c.levels(known.value, k):
                if level == k:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hashed), shard, np.int32)), pa.array(hashed.view(np.int64)), pa.array(count)], ["shard", "h", "f"])

    rows = texts.mapInArrow(run, "shard int, h long, f long")
    local = math.ceil(support / shards)
    return rows.groupBy("shard", "h").agg(F.sum("f").alias("f")).where(F.col("f") >= local).select("h").distinct()


def exact_counts(texts: DataFrame, maps: list[Bitmap], support: int, longest: int) -> DataFrame:
    """lang, phrase, k, f of every phrase of 2 words or more that has the support, counted by its words over all texts."""
    known = texts.sparkSession.sparkContext.broadcast(maps)

    def run(batches):
        for c in chunks(batches):
            for k, first, hashed, count in c.levels(known.value, longest):
                keep = known.value[k - 1].has(hashed)
                first, count = first[keep], count[keep]
                columns = [c.lang(first), c.text(first, k).cast(pa.large_string()), pa.array(np.full(len(first), k, np.int32)), pa.array(count)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "k", "f"])

    rows = texts.mapInArrow(run, "lang string, phrase string, k int, f long")
    return rows.groupBy("lang", "phrase", "k").agg(F.sum("f").alias("f")).where(F.col("f") >= support)


def scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """phrases (lang, phrase, k, f; a table) with l, r and score of their lowest-scoring cut."""
    known = phrases.select(F.struct("lang", "phrase").alias("key"), "f").unionByName(words.select(F.struct("lang", "phrase").alias("key"), "f"))
    known = materialise(known, "known")
    w = F.split("phrase", " ", -1)
    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    part = lambda at, size: F.struct("lang", F.array_join(F.slice(w, at, size), " ").alias("phrase"))
    cuts = materialise(cuts.select("lang", "phrase", "f", "cut", part(F.lit(1), F.col("cut")).alias("head"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("key")), "cuts")
    cuts = split_join(cuts, known.withColumnRenamed("f", "r"), "key").drop("key").withColumnRenamed("head", "key")
    cuts = split_join(materialise(cuts, "cuts"), known.withColumnRenamed("f", "l"), "key").drop("key")
    big = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumns({"over": (big("f") * big("f")) * F.lit(1_000_000).cast("decimal(7,0)"), "under": big("l") * big("r")})
    cuts = cuts.withColumn("score", F.expr("cast(over div under as long)"))
    least = F.min(F.struct("score", "cut", "l", "r")).alias("least")
    return cuts.groupBy("lang", "phrase", "f").agg(least).select("lang", "phrase", "f", "least.l", "least.r", "least.score")


def inside_longer(phrases: DataFrame, longest: int) -> DataFrame:
    """lang, phrase, around: the largest count of a longer phrase of the table around each phrase that is part of one."""
    w = F.split("phrase", " ", -1)
    long = phrases.where("k > 2").withColumn("w", w)
    sizes = long.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
    parts = sizes.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
    parts = parts.select("lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase"), "f")
    return parts.groupBy("lang", "phrase").agg(F.max("f").alias("around"))


def collocations(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, top: int = TOP, shards: int = SHARDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first phrases."""
    texts = small_batches(docs).select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    every = materialise(word_counts(texts), "words")
    total = every.groupBy("lang").agg(F.sum("f").alias("n"))
    words = every.where(F.col("f") >= support)
    maps = [bitmap(words.select("h"))]
    for k in range(2, longest + 1):
        maps.append(bitmap(materialise(locally_frequent(texts, maps, k, support, shards), "frequent")))
    phrases = materialise(exact_counts(texts, maps, support, longest), "phrases")
    found = scored(phrases, words).join(inside_longer(phrases, longest), ["lang", "phrase"], "left")
    found = materialise(found.where(F.col("around").isNull() | (100 * F.col("around") < INSIDE * F.col("f"))).drop("around"), "scored")
    order = [F.col("score").desc(), F.col("f").desc(), F.col("phrase")]
    parts = max(1, math.isqrt(found.count() // top))  # both steps then have about as many rows in a task
    first = Window.partitionBy("lang", "part").orderBy(*order)
    few = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts))).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    best = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    out = best.join(total, "lang")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("f").alias("a"), "l", "r", "n", "score")
