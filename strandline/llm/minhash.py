"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

A document is a weighted set of shingles of five words.  A shingle weighs its count times the mean inverse document
frequency of its words; document frequencies of all documents are added up in a hashed table of 2^DF_BITS counters (of words
and not of shingles: a large group of copies would otherwise lower the weight of just what it shares).  Improved
consistent weighted sampling draws ``BANDS * BAND_ROWS`` samples from each set; two sets agree in a sample with probability
equal to their weighted Jaccard similarity.  Samples are banded, documents of a band's bucket are candidates, and a link
needs an exact weighted Jaccard similarity of ``SIMILARITY`` or more.

Buckets are never expanded into their pairs.  Equal word sequences are one class from the start.  Then each member of a
bucket is compared with the bucket's first document; members still apart, with three more leaders.  The documents of
buckets that then still hold several components are searched exactly, by weighted prefixes: a document's shingles are ordered from
the rarest on, and two documents of the similarity share a shingle in the short part of that order beyond which too little weight
is left.  Only pairs of different components whose remaining weights at a shared shingle still allow the similarity are
compared.  That bound holds for every pair, so no link between components of a bucket is lost, whatever the bucket's size.

Defined cases: a text of one to four words is a single shingle; a null text or one without words is alone in its class; a null
doc_id is kept and alone; repeated rows of one document are copies of each other; rows of different texts under one id are judged by
their texts, each in its own class; the document with the smallest id of a class stays; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, HOT_ROWS, WORD_LUT, anti_by_id, byte_chunks, components, discard, materialise, mix64, renamed, semi_by_id, small_batches, split_join, word_hashes, words_of
from .labelled import unique_features

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 14
BAND_ROWS = 5
DF_BITS = 18
SEGMENT = 4096
ROWS = 1 << 13
LEADERS = 3
#: Relative room for the rounding of weights and their sums.
SLACK = 1e-5
_U = np.uint64
_LOW = _U((1 << 48) - 1)
_TURNS = [_U(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents per word bucket over all documents, and the number of documents: 2^DF_BITS numbers reach the driver."""

    def count(batches):
        total, n = np.zeros(1 << DF_BITS, np.int64), 0
        for batch in batches:
            for lo, hi, data, offs in byte_chunks(batch.column(0), rows=ROWS):
                starts, ends, doc, norm = words_of(data, offs, WORD_LUT)
                _, f = unique_features(doc, word_hashes(norm, starts, ends) >> _U(64 - DF_BITS), DF_BITS)
                total += np.bincount(f, minlength=len(total))
                n += hi - lo
        parts = total.reshape(-1, SEGMENT)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts))), pa.array([p.tobytes() for p in parts], pa.binary()), pa.array(np.where(np.arange(len(parts)) == 0, n, 0))], ["segment", "counts", "n"])

    def add(batches):
        sums: dict[int, list] = {}
        for batch in batches:
            for s, c, n in zip(*(col.to_pylist() for col in batch.columns)):
                held = sums.setdefault(s, [np.zeros(SEGMENT, np.int64), 0])
                held[0] += np.frombuffer(c, np.int64)
                held[1] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([h[0].tobytes() for h in sums.values()], pa.binary()), pa.array([h[1] for h in sums.values()], pa.int64())], ["segment", "counts", "n"])

    shape = "segment long, counts binary, n long"
    rows = small_batches(docs).select("text").mapInArrow(count, shape).repartition((1 << DF_BITS) // SEGMENT, "segment").mapInArrow(add, shape).collect()
    out, n = np.zeros((1 << DF_BITS) // SEGMENT * SEGMENT, np.int64), 0
    for r in rows:
        out[r["segment"] * SEGMENT : (r["segment"] + 1) * SEGMENT] += np.frombuffer(r["counts"], np.int64)
        n += r["n"]
    return out, n


def inverse_frequencies(df: np.ndarray, n: int) -> np.ndarray:
    return (np.log((n + 1) / (df + 1)) + 1).astype(np.float32)


def weighted_sets(data: np.ndarray, offs: np.ndarray, idf: np.ndarray):
    """Shingles of the documents of a chunk: (document << 48 | hash, sorted and distinct; weight; words and their documents)."""
    starts, ends, doc, norm = words_of(data, offs, WORD_LUT)
    h = word_hashes(norm, starts, ends)
    n = len(h)
    own = idf[(h >> _U(64 - DF_BITS)).astype(np.int64)]
    mixed, weight, size = np.zeros(n, _U), np.zeros(n, np.float32), np.zeros(n, np.int8)
    for j in range(SHINGLE):
        if n <= j:
            break
        same = doc[j:] == doc[: n - j]
        mixed[: n - j] += np.where(same, h[j:] * _TURNS[j], _U(0))
        weight[: n - j] += np.where(same, own[j:], np.float32(0))
        size[: n - j] += same
    first = np.ones(n, bool)
    first[1:] = doc[1:] != doc[:-1]
    use = np.flatnonzero((size == SHINGLE) | first)
    key = (doc[use].astype(_U) << _U(48)) | (mix64(mixed[use] + size[use].astype(_U)) >> _U(16))
    order = np.argsort(key)
    key, weight = key[order], (weight[use] / size[use])[order]
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    times = np.diff(np.append(begin, len(key)))
    return key[begin], weight[begin] * times.astype(np.float32), h, doc


def sampling_tables(seed: int = 11) -> tuple[np.ndarray, ...]:
    """Random numbers of the sampler, r and 1 / r by 16 bits of a turned hash, beta and ln c by 16 others."""
    rng = np.random.default_rng(seed)
    r, c, beta = rng.gamma(2.0, 1.0, 1 << 16), rng.gamma(2.0, 1.0, 1 << 16), rng.random(1 << 16)
    return tuple(x.astype(np.float32) for x in (r, 1 / r, beta, np.log(c)))


def samples(key: np.ndarray, weight: np.ndarray, n_samples: int, tables, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Documents that have shingles, and their samples [document, n_samples]."""
    doc = (key >> _U(48)).astype(np.int64)
    begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    size = np.diff(np.append(begin, len(key)))
    h, logs = key & _LOW, np.log(weight)
    r_, inv_, beta_, c_ = tables
    turns = np.random.default_rng([seed, 1]).integers(0, 1 << 63, n_samples, dtype=np.uint64) * _U(2) + _U(1)
    row = np.repeat(np.arange(len(begin)), size)
    out = np.empty((len(begin), n_samples), _U)
    for k in range(n_samples):
        turned = h * turns[k]
        at, by = (turned >> _U(48)).astype(np.intp), (turned >> _U(32) & _U(0xFFFF)).astype(np.intp)
        r, beta = r_.take(at), beta_.take(by)
        t = np.floor(logs * inv_.take(at) + beta)
        a = c_.take(by) - r * (t - beta + np.float32(1))
        low = np.flatnonzero(a == np.repeat(np.minimum.reduceat(a, begin), size))
        if len(low) != len(begin):
            low = low[np.searchsorted(row[low], np.arange(len(begin)))]
        out[:, k] = mix64(h[low] ^ (t[low].astype(np.int64).view(_U) << _U(48)) ^ _U(k))
    return doc[begin], out


def signatures(docs: DataFrame, idf: np.ndarray, bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """id, t (hash of the whole text), f1, f2 (fingerprint of the word sequence; null without words), bands (one key per band)."""
    model = docs.sparkSession.sparkContext.broadcast(idf)  # 2^DF_BITS floats

    def run(batches):
        tables, names = sampling_tables(), ["id", "t", "f1", "f2", "bands"]
        for batch in batches:
            for lo, hi, data, offs in byte_chunks(batch.column(2), rows=ROWS):
                key, weight, h, doc = weighted_sets(data, offs, model.value)
                ids = [batch.column(i).slice(lo, hi - lo) for i in (0, 1)]
                if not len(key):
                    none = pa.nulls(hi - lo, pa.int64())
                    yield pa.RecordBatch.from_arrays([*ids, none, none, pa.nulls(hi - lo, pa.list_(pa.int64()))], names)
                    continue
                have, s = samples(key, weight, bands * rows, tables)
                key_of = np.zeros((len(have), bands), _U)
                for b in range(bands):
                    for i in range(rows):
                        key_of[:, b] = mix64(key_of[:, b] * _U(31) + s[:, b * rows + i] + _U(b))
                first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
                place = np.arange(len(doc)) - np.repeat(first, np.diff(np.append(first, len(doc))))
                prints = [np.add.reduceat(mix64(h + (place.astype(_U) + _U(1)) * turn), first) for turn in _TURNS[:2]]
                at = np.full(hi - lo, -1, np.int64)
                at[have] = np.arange(len(have))
                take = pa.array(np.maximum(at, 0), mask=at < 0)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(have) + 1, dtype=np.int32) * bands), pa.array(key_of.ravel().view(np.int64)))
                first_two = [pa.array(p.view(np.int64)).take(take) for p in prints]
                yield pa.RecordBatch.from_arrays([*ids, *first_two, lists.take(take)], names)

    return docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("t"), "text").mapInArrow(run, "id long, t long, f1 long, f2 long, bands array<long>")


def similarities(a: pa.Array, b: pa.Array, idf: np.ndarray) -> np.ndarray:
    """Exact weighted Jaccard similarity of the texts of each row."""
    out = np.zeros(len(a))
    size = np.cumsum(np.asarray(pc.add(pc.binary_length(a), pc.binary_length(b)), np.int64))
    lo = 0
    while lo < len(a):
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + (1 << 21), "right")))
        hi = min(hi, lo + 4096, len(a))
        sets = []
        for column in (a, b):
            parts = [(s + (_U(base) << _U(48)), w) for base, _, data, offs in byte_chunks(column.slice(lo, hi - lo), 1 << 40, 1 << 15) for s, w in [weighted_sets(data, offs, idf)[:2]]]
            sets.append(tuple(np.concatenate(x) for x in zip(*parts)))
        (ka, wa), (kb, wb) = sets
        at = np.minimum(np.searchsorted(kb, ka), max(0, len(kb) - 1))
        hit = kb[at] == ka if len(kb) else np.zeros(len(ka), bool)
        of = lambda k: (k >> _U(48)).astype(np.int64)
        n = hi - lo
        both = np.bincount(of(ka[hit]), np.minimum(wa[hit], wb[at[hit]]), n)
        all_ = np.bincount(of(ka), wa, n) + np.bincount(of(kb), wb, n) - both
        out[lo:hi] = both / np.maximum(all_, 1e-30)
        lo = hi
    return out


def verified(pairs: DataFrame, texts_of: Callable[[DataFrame], DataFrame], idf: np.ndarray, similarity: float) -> DataFrame:
    """Pairs (a, b, further columns) whose texts have the similarity or more, as a table.  pairs should be a table of numbers; texts_of
    gives (id, text) for ids."""
    names = pairs.columns
    model = pairs.sparkSession.sparkContext.broadcast(idf)
    ids = materialise(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct(), "ids")
    texts = small_batches(texts_of(ids))

    def run(batches):
        for batch in batches:
            keep = pa.array(similarities(batch.column(0), batch.column(1), model.value) >= similarity)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in range(2, 2 + len(names))], names)

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    with_a = split_join(pairs, left, "a")
    hot_b = pairs.groupBy("b").agg(F.count("*").alias("n")).where(F.col("n") > HOT_ROWS)
    if hot_b.isEmpty():
        joined = with_a.join(right, "b")
    else:  # few texts are compared with very many on this side too
        joined = split_join(materialise(with_a, "with_text"), right, "b")
    out = materialise(joined.select("ta", "tb", *names).mapInArrow(run, pairs.schema), "verified")
    discard(ids)
    return out


def shingle_rows(texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """x, t (the text), total (its weight), tokens (array of shingle hash and weight) of each text (id, text) with words."""
    model = texts.sparkSession.sparkContext.broadcast(idf)
    names = ["x", "t", "total", "tokens"]

    def run(batches):
        for batch in batches:
            for lo, hi, data, offs in byte_chunks(batch.column(2), rows=ROWS):
                key, weight, _, _ = weighted_sets(data, offs, model.value)
                if not len(key):
                    continue
                have, begin, size = np.unique((key >> _U(48)).astype(np.int64), return_index=True, return_counts=True)
                both = pa.StructArray.from_arrays([pa.array((key & _LOW).astype(np.int64)), pa.array(weight.astype(np.float64))], ["token", "w"])
                lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(key)).astype(np.int32)), both)
                total = pa.array(np.add.reduceat(weight.astype(np.float64), begin))
                own = [batch.column(i).slice(lo, hi - lo).take(pa.array(have)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*own, total, lists], names)

    rows = small_batches(texts).select("id", F.xxhash64("text").alias("t"), "text")
    return rows.mapInArrow(run, "x long, t long, total double, tokens array<struct<token:long,w:double>>")


def component_pairs(apart: DataFrame, texts: DataFrame, idf: np.ndarray, similarity: float) -> DataFrame:
    """Pairs (a, b, their components of_a, of_b) of documents of apart (x, c: document and its component; one row each) in different
    components that a bound doesn't rule out.  texts: (id, text) of those documents.

    Shingles that only one of the documents has come first in the order and are left out, since nothing is shared there.
    ``rest`` is a document's weight from a shingle on.  Two documents of similarity s share s / (1 + s) of their summed
    weights, so at their first common shingle both have that much left; the lighter one then has 2 s / (1 + s) of its own
    weight left, the other one s.  Pairs inside the most frequent component of a shingle are not even looked at.
    """
    shingles = materialise(shingle_rows(texts, idf), "shingles")
    rows = shingles.join(apart, "x").select("x", "t", "c", "total", F.explode("tokens").alias("s")).select("x", "t", "c", "total", "s.token", "s.w")
    shared = rows.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    onwards = Window.partitionBy("x", "t").orderBy(F.col("n").desc(), "token").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(shared, "token").withColumn("rest", F.sum("w").over(onwards) * (1 + SLACK))
    prefixes = materialise(rows.where(F.col("rest") >= similarity * F.col("total")).select("token", "x", "c", "total", "rest"), "prefixes")
    discard(shingles)
    per = prefixes.groupBy("token", "c").agg(F.count("*").alias("n"))
    per = per.groupBy("token").agg(F.max_by("c", F.struct("n", "c")).alias("top"), F.count("*").alias("several")).where("several > 1")
    rows = materialise(prefixes.join(per.select("token", "top"), "token"), "prefixes")
    discard(prefixes)
    light = rows.where(F.col("rest") >= 2 * similarity / (1 + similarity) * F.col("total"))
    heavy = rows.select("token", *[F.col(c).alias(f"{c}_") for c in ("x", "c", "total", "rest", "top")])
    enough = F.least("rest", "rest_") >= similarity / (1 + similarity) * (F.col("total") + F.col("total_"))
    possible = (F.col("c") != F.col("c_")) & (F.col("total") <= F.col("total_")) & enough
    found = [
        one.join(other, "token").where(possible).select("x", "c", F.col("x_").alias("y"), F.col("c_").alias("d"))
        for one, other in ((light.where("c != top"), heavy), (light.where("c = top"), heavy.where("c_ != top_")))
    ]
    out = materialise(_ordered(found[0].union(found[1])), "pairs")
    discard(rows)
    return out


def prefix_pairs(apart: DataFrame, texts: DataFrame, idf: np.ndarray, similarity: float) -> DataFrame:
    """The pairs of component_pairs as (x, y)."""
    return component_pairs(apart, texts, idf, similarity).select(F.col("a").alias("x"), F.col("b").alias("y"))


def _ordered(pairs: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of pairs (x, y); of (x, c, y, d) with the components of both, of_a and of_b."""
    if "c" not in pairs.columns:
        return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a < b").distinct()
    turn = [F.when(F.col("x") < F.col("y"), F.col(p)).otherwise(F.col(q)).alias(name) for p, q, name in (("x", "y", "a"), ("y", "x", "b"), ("c", "d", "of_a"), ("d", "c", "of_b"))]
    return pairs.where("x != y").select(*turn).distinct()


def _lone(joins: list[DataFrame], comp: DataFrame) -> DataFrame:
    """Nodes of joins that are in no component of comp, each its own component."""
    nodes = reduce(DataFrame.union, [j.select("node") for j in joins]).distinct()
    return nodes.join(comp, "node", "left_anti").select("node", F.col("node").alias("component"))


def _joined(links: DataFrame) -> DataFrame:
    """(node, component) of the components that further links (of_a, of_b) join, as a table."""
    return materialise(components(links.select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))), "joined")


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, t (hash of the text), class_id (smallest doc_id of its class), class_key (the class's own name), kept - for every row
    with an id and words; others are absent.

    Equal word sequences are one node, numbered once and for all in a table: an id that rows with different texts repeat is in the
    class of each of its texts, and joins no classes.
    """
    idf = inverse_frequencies(*document_frequencies(docs))
    marks = materialise(signatures(docs, idf), "signatures").where("id is not null and f1 is not null")
    row = F.struct("id", "t")
    copies = marks.groupBy("f1", "f2").agg(F.min(row).alias("lead"), F.min_by("bands", row).alias("bands"))
    copies = materialise(copies.withColumn("rep", F.monotonically_increasing_id()), "copies")
    repeated = marks.select("id", "t").count() != marks.select("id", "t").distinct().count()
    rows = docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("t"), "text")

    def texts_of(ids: DataFrame) -> DataFrame:
        """(id, text) of the nodes in ids."""
        at = copies.select(F.col("rep").alias("id"), F.col("lead.id").alias("d"), F.col("lead.t").alias("t"))
        at = materialise(semi_by_id(at, ids, "id"), "wanted")
        few = at.count() <= BROADCAST_IDS
        found = rows.join(F.broadcast(at) if few else at, ["d", "t"]).select("id", "text")
        return found.dropDuplicates(["id"]) if repeated else found

    buckets = copies.select("rep", F.posexplode("bands").alias("band", "value"))
    rows_of = materialise(buckets.select(F.xxhash64("band", "value").alias("key"), F.col("rep").alias("x")), "buckets")
    lead = materialise(rows_of.groupBy("key").agg(F.min("x").alias("y"), F.max("x").alias("z")).where("y < z").select("key", "y"), "leads")
    buckets = materialise(split_join(rows_of, lead, "key"), "buckets")  # of two documents or more, with the first one
    discard(rows_of)
    discard(lead)
    pairs = materialise(_ordered(buckets), "pairs")
    links = verified(pairs, texts_of, idf, similarity)

    def apart(placed: DataFrame) -> DataFrame:
        """Rows (key, x, c) of placed in buckets that hold more than one component; placed is removed."""
        several = placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key")
        out = materialise(split_join(placed, several, "key"), "apart")
        discard(placed)
        return out

    comp = materialise(components(links), "components")
    placed = buckets.join(comp.withColumnRenamed("node", "x"), "x", "left").select("key", "x", F.coalesce("component", "x").alias("c"))
    rest, joins = apart(materialise(placed, "placed")), []
    firsts = rest.groupBy("key").agg(*[F.min_by(F.struct(F.col("x").alias("y"), F.col("c").alias("d")), F.xxhash64(F.lit(i), "x")).alias(f"l{i}") for i in range(LEADERS)])
    firsts = materialise(firsts.select("key", F.array(*[f"l{i}" for i in range(LEADERS)]).alias("leads")), "leads")
    near = split_join(rest, firsts, "key").select("x", "c", F.explode("leads").alias("l")).where("c != l.d").select("x", "c", "l.y", "l.d")
    more = materialise(_ordered(near).join(pairs, ["a", "b"], "left_anti"), "pairs")
    discard(pairs)
    if not more.isEmpty():
        joins.append(_joined(verified(more, texts_of, idf, similarity)))
        placed = materialise(renamed(rest, "c", joins[-1]), "placed")
        discard(rest)
        rest = apart(placed)
    open_ = materialise(rest.select("x", "c").distinct(), "open")
    discard(rest)
    if not open_.isEmpty():
        pairs = component_pairs(open_, texts_of(open_.select(F.col("x").alias("id"))), idf, similarity)
        joins.append(_joined(verified(pairs, texts_of, idf, similarity)))
    comp = materialise(comp.union(_lone(joins, comp)), "components") if joins else comp
    for j in joins:
        comp = materialise(renamed(comp, "component", j), "components")
    comp = comp.withColumnRenamed("node", "rep")
    linked = materialise(comp.join(copies.select("rep", "f1", "f2", "lead"), "rep"), "linked")
    lead = linked.groupBy("component").agg(F.min("lead").alias("first"), F.min_by(F.struct("f1", "f2"), "lead").alias("key"))
    linked = split_join(linked.select("component", "rep"), lead, "component").drop("component")
    of_copies = copies.select("f1", "f2", "rep", "lead").join(linked, "rep", "left").select(
        "f1", "f2", F.coalesce("first", "lead").alias("first"), F.coalesce("key", F.struct("f1", "f2")).alias("key")
    )
    key = F.lower(F.concat(F.lpad(F.hex("key.f1"), 16, "0"), F.lpad(F.hex("key.f2"), 16, "0")))
    kept = (F.col("id") == F.col("first.id")) & (F.col("t") == F.col("first.t"))
    out = marks.select("id", "t", "f1", "f2").join(of_copies, ["f1", "f2"])
    return out.select(F.col("id").alias("doc_id"), "t", F.col("first.id").alias("class_id"), key.alias("class_key"), kept.alias("kept"))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of docs: doc_id, class_id, kept, class_key.

    class_id is the smallest id of the class and kept marks that document's rows.  Where rows of different texts repeat an id, two
    classes may have the same smallest id: class_key tells them apart (null for rows without an id or words, each alone).
    """
    grouped = classes(docs.select("doc_id", "text"), similarity).drop("t")
    rest = docs.where(F.col("doc_id").isNull() | F.col("text").isNull() | ~has_words())
    rest = rest.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(None).cast("string").alias("class_key"), F.lit(True).alias("kept"))
    return grouped.unionByName(rest).select("doc_id", "class_id", "kept", "class_key")


def has_words():
    return F.col("text").rlike("[0-9A-Za-z\\x{80}-\\x{10FFFF}]")


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents that stay; columns unchanged.

    A class keeps the text with the smallest id (of one id's texts in a class, that with the smallest hash), so each text of a
    repeated id is judged by its own class.  Of repeated rows of that text one stays: the first by all its columns as JSON.
    """
    found = materialise(classes(docs.select("doc_id", "text"), similarity), "classes")
    key, t = ["doc_id", "__near_text"], F.col("t").alias("__near_text")
    gone = materialise(found.where("not kept").select("doc_id", t).distinct(), "gone")
    kept = anti_by_id(docs.withColumn("__near_text", F.xxhash64("text")), gone, key)
    many = materialise(found.where("kept").groupBy("doc_id", t).agg(F.count("*").alias("n")).where("n > 1").drop("n"), "repeated")
    if many.isEmpty():
        return kept.select(*docs.columns)
    every = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = semi_by_id(kept, many, key).groupBy(*key).agg(F.min_by(every, F.to_json(every)).alias("__row")).select("__row.*")
    return anti_by_id(kept, many, key).select(*docs.columns).union(one)
