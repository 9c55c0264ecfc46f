"""Line deduplication by a deletion-neighbourhood join (DataFrame functions only).

A line is its lower-cased blank-separated words.  A line is dropped if an earlier line - by document id, then place - has
the same words, or is within one word edit of it (a word inserted, deleted or changed) that leaves ``SIMILARITY`` of the words: both
lines then have ``MIN_WORDS`` words or more.

1. Equal lines meet by a fingerprint; only the earliest of each goes on.
2. Two lines within one edit share the words of their first or of their last half, so only lines that share such a half with
   another line (found by an aggregation of hashed halves) can have a neighbour.
3. Those lines emit their whole deletion neighbourhood as hashed keys: the line, and the line without each of its words.
   Keys for changed words also hold the place, so all lines of such a bucket are neighbours; a bucket of deletions holds one
   shorter line and the longer ones around it.  The earliest line of each bucket is therefore enough, found by an aggregation,
   and no bucket is expanded into pairs.
4. Each candidate pair is verified word by word.

A variant's hash is the exclusive or of 64-bit hashes of its words with their places, so it depends on the order of the
words, and all variants of a line cost one pass over it.

Defined cases: null and empty texts have no lines to drop; blank lines are never dropped; rows that repeat a doc_id count as
one document (equal lines at the same place of them are one line, different lines at one place are each compared with earlier
places, and each row loses the lines that it shares with an earlier place); a null doc_id sorts first; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, materialise

#: Near lines keep at least this share of their words.
SIMILARITY = 0.8
#: One word is less than the rest of the share from here on; in shorter lines one edit changes more, so they only match as equals.
MIN_WORDS = round(1 / (1 - SIMILARITY))
#: What a variant is: the whole line, the line short of a word, the line with a word left open.
WHOLE, SHORT, OPEN = 0, 1, 2


def words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), "[ \\t\\r\\f\\x0B]+"), lambda x: x != "")


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, line of every line; texts that are null give one row without a line."""
    rows = docs.select("doc_id", F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line"))
    return rows.select("doc_id", F.coalesce("line_no", F.lit(-1)).alias("line_no"), F.coalesce("line", F.lit("")).alias("line"))


def half_keys(w: Column) -> Column:
    """Hashes of both halves, cut as for the line's own length and for one word less."""

    def halves(c: Column) -> list[Column]:
        h = F.floor(c / 2).cast("int")
        return [
            F.xxhash64(F.lit("front"), c, F.slice(w, F.lit(1), h)),
            F.xxhash64(F.lit("back"), c, F.slice(w, F.size(w) - (c - h) + 1, c - h)),
        ]

    n = F.size(w)
    both = F.array(*halves(n), *halves(n - 1))
    return F.when(n > MIN_WORDS, both).when(n == MIN_WORDS, F.array(*halves(n))).otherwise(F.array().cast("array<bigint>"))


def marked_lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, f1, f2 (fingerprint; null if blank), halves."""
    w = F.col("w")
    some = F.size(w) > 0
    return lines_of(docs).select("doc_id", "line_no", words(F.col("line")).alias("w")).select(
        "doc_id",
        "line_no",
        F.when(some, F.xxhash64(w)).alias("f1"),
        F.when(some, F.hash(w)).alias("f2"),
        half_keys(w).alias("halves"),
    )


def variants_of(lines: DataFrame) -> DataFrame:
    """(o, key, role) of each line (o, w): the line whole, the line without one word, the line with one word left open.

    A word is hashed with its place, and with the place before it, where it stands once an earlier word is gone.  One row per
    place is made first, so the keys are plain expressions over numbers.
    """
    either = lambda a, b: a.bitwiseXOR(b)
    none = F.lit(0).cast("long")
    rows = lines.select("o", F.size("w").alias("n"), F.transform("w", lambda x: F.xxhash64(x)).alias("p"))
    rows = rows.withColumns({"a": F.transform("p", lambda x, i: F.xxhash64(x, i)), "b": F.transform("p", lambda x, i: F.xxhash64(x, i - 1))})
    rows = rows.withColumn("t", F.aggregate("a", none, either))
    # c[i]: hashes of the words before place i under both places, from nothing before the first word to all words
    before = F.aggregate(F.zip_with("a", "b", either), F.array(none), lambda c, x: F.concat(c, F.array(either(F.element_at(c, -1), x))))
    rows = rows.withColumn("c", before)
    own = rows.select("o", F.xxhash64(F.lit("d"), "n", "t").alias("key"), F.lit(WHOLE).alias("role"))
    moved = either(F.col("t"), F.element_at("c", -1)).alias("tb")  # all words at the place before theirs
    places = rows.select("o", "n", "t", moved, F.posexplode(F.arrays_zip("a", "b", F.slice("c", F.lit(1), F.col("n")).alias("c"))).alias("i", "at"))
    open_ = places.select("o", F.xxhash64(F.lit("s"), "n", "i", either(F.col("t"), F.col("at.a"))).alias("key"), F.lit(OPEN).alias("role"))
    gone = either(either(F.col("tb"), F.col("at.c")), F.col("at.b"))
    less = places.where(F.col("n") > MIN_WORDS).select("o", F.xxhash64(F.lit("d"), F.col("n") - 1, gone).alias("key"), F.lit(SHORT).alias("role"))
    return own.unionByName(open_).unionByName(less)


def within_one_edit(a: Column, b: Column) -> Column:
    """Word edit distance at most one."""
    n, m = F.size(a), F.size(b)
    changed = F.size(F.filter(F.zip_with(a, b, lambda x, y: x != y), lambda z: z)) <= 1

    def inserted(long: Column, short: Column) -> Column:
        k = F.size(short)
        same = F.zip_with(F.slice(long, F.lit(1), k), short, lambda x, y: x == y)
        first = F.array_position(same, False).cast("int")
        p = F.when(first == 0, k + 1).otherwise(first)
        return F.slice(long, p + 1, F.size(long)) == F.slice(short, p, F.greatest(k, F.lit(1)))

    return F.when(n == m, changed).when(n == m + 1, inserted(a, b)).when(m == n + 1, inserted(b, a)).otherwise(F.lit(False))


def near_lines(docs: DataFrame, first: DataFrame) -> DataFrame:
    """Fingerprints f1, f2 of first lines that have a line of an earlier place within one edit.

    first: f1, f2, o (place: doc_id, line_no), halves - one row per distinct line.  A line is known by its place and f1, since rows
    that repeat an id may have several lines at one place; of those none is earlier than another.
    """
    halves = first.where(F.size("halves") > 0).select("f1", "f2", "o", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.min("f1").alias("lo"), F.max("f1").alias("hi")).where("lo < hi").select("half")
    chosen = materialise(halves.join(shared, "half").select("o.doc_id", "o.line_no", "f1", "f2").distinct(), "lines")
    few = chosen.count() <= BROADCAST_IDS
    ids = chosen.select("doc_id").distinct()
    docs = docs.join(F.broadcast(ids) if few else ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")
    chosen = chosen.select(F.coalesce("doc_id", F.lit(0)).alias("d"), F.col("doc_id").isNull().alias("no_id"), "line_no", "f1", "f2")
    texts = lines_of(docs).withColumns({"d": F.coalesce("doc_id", F.lit(0)), "no_id": F.col("doc_id").isNull()})
    texts = texts.join(F.broadcast(chosen) if few else chosen, ["d", "no_id", "line_no"]).withColumn("w", words(F.col("line")))
    texts = texts.where((F.xxhash64("w") == F.col("f1")) & (F.hash("w") == F.col("f2"))).dropDuplicates(["f1", "f2"])
    texts = materialise(texts.select(F.struct("doc_id", "line_no", "f1").alias("o"), "f2", "w"), "candidates")
    variants = materialise(variants_of(texts), "variants")
    least = lambda role: F.min(F.when(F.col("role") == role, F.col("o"))).alias(f"o{role}")
    buckets = variants.groupBy("key").agg(*[least(r) for r in (WHOLE, SHORT, OPEN)], F.count("*").alias("n")).where("n > 1").drop("n")
    earlier = F.when(F.col("role") == WHOLE, F.col(f"o{SHORT}")).when(F.col("role") == SHORT, F.col(f"o{WHOLE}")).otherwise(F.col(f"o{OPEN}"))
    place = lambda c: F.struct(F.col(c)["doc_id"], F.col(c)["line_no"])
    pairs = variants.join(buckets, "key").select("o", earlier.alias("m")).where(place("m") < place("o")).distinct()
    pairs = materialise(pairs, "pairs")
    a, b = texts.select("o", "f2", F.col("w").alias("wa")), texts.select(F.col("o").alias("m"), F.col("w").alias("wb"))
    return pairs.join(a, "o").join(b, "m").where(within_one_edit(F.col("wa"), F.col("wb"))).select("o.f1", "f2").distinct()


def dropped_lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, f1 (null if blank), exact, near: every line and why it is dropped, if it is."""
    docs = docs.select("doc_id", "text")
    lines = materialise(marked_lines(docs), "marked")
    first = lines.where("f1 is not null").groupBy("f1", "f2").agg(F.min(F.struct("doc_id", "line_no")).alias("o"), F.min("halves").alias("halves"))
    first = materialise(first, "first")
    near = near_lines(docs, first).withColumn("near", F.lit(True))
    known = first.select("f1", "f2", "o").join(near, ["f1", "f2"], "left").select("f1", "f2", "o", F.coalesce("near", F.lit(False)).alias("near"))
    own = F.struct("doc_id", "line_no")
    out = lines.select("doc_id", "line_no", "f1", "f2").join(materialise(known, "known"), ["f1", "f2"], "left")
    exact = F.coalesce(~own.eqNullSafe(F.col("o")) & F.col("o").isNotNull(), F.lit(False))
    return out.select("doc_id", "line_no", "f1", exact.alias("exact"), (F.coalesce("near", F.lit(False)) & ~exact).alias("near"))


def line_dedup(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_lines, n_blank, n_exact, n_near and the numbers of the dropped lines."""
    gone = F.col("exact") | F.col("near")
    return dropped_lines(docs).groupBy("doc_id").agg(
        F.count_if(F.col("line_no") >= 0).alias("n_lines"),
        F.count_if((F.col("line_no") >= 0) & F.col("f1").isNull()).alias("n_blank"),
        F.count_if("exact").alias("n_exact"),
        F.count_if("near").alias("n_near"),
        F.sort_array(F.collect_list(F.when(gone, F.col("line_no")))).alias("dropped"),
    )


def drop_lines(docs: DataFrame) -> DataFrame:
    """docs with the kept lines of each text; columns unchanged.

    A dropped line is known by its document, place and words, so rows that repeat a doc_id with other texts keep their own lines.
    """
    gone = dropped_lines(docs).where("exact or near").groupBy(F.col("doc_id").alias("__id")).agg(F.collect_set(F.struct(F.col("line_no").alias("i"), "f1")).alias("dropped"))
    same = lambda x, i: F.array_contains(F.col("dropped"), F.struct(i.alias("i"), F.xxhash64(words(x)).alias("f1")))
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~same(x, i))
    joined = docs.join(gone, docs["doc_id"].eqNullSafe(F.col("__id")), "left")
    text = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[text.alias("text") if c == "text" else docs[c] for c in docs.columns])
