"""Shared pieces of the training-data operators: tables, scratch folder, text as byte arrays, components.

Every operator works on Spark partitions.  Python code inside a task sees one Arrow batch at a time and cuts it into
chunks of a few megabytes, so memory depends on the longest single text and never on a table or a group.
"""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ready

CHUNK_BYTES = 1 << 20
#: Rows of an Arrow batch: a few megabytes of usual texts, so that a worker and its JVM hold little at a time.
BATCH_ROWS = 500
#: Ids that may be broadcast (8 MB of longs); larger sets take a shuffled join.
BROADCAST_IDS = 1_000_000
#: A join key with more rows than this, and more than 1 / HOT_PARTS of all rows, is dealt over several tasks.
HOT_ROWS = 1000
HOT_PARTS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share (``spark.checkpoint.dir``).

    Only where driver and executors are one process (tests on one machine) may the session name none: a temporary folder
    is then taken.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or getattr(spark, "_strandline_scratch", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":  # local-cluster has executors of its own
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="strandline-")
        spark._strandline_scratch = base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Cut the lineage: write to the shared scratch folder and read back."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Remove a table of materialise() that nothing reads any more."""
    spark = table.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(df: DataFrame) -> DataFrame:
    """Have Spark pass rows to Python in small Arrow batches (a setting of the session; Spark only bounds batches by rows)."""
    ready(df.sparkSession).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df


def fold(column: str, parts: int):
    """crc32 of the id as text, modulo parts; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % parts, F.lit(0))


def semi_by_id(df: DataFrame, ids: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of df whose key is in ids (distinct).  Few ids are broadcast after counting them, more are shuffled."""
    small = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if small else ids, key, "left_semi")


def anti_by_id(df: DataFrame, ids: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of df whose key is not in ids (distinct), null keys included; see semi_by_id."""
    small = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if small else ids, key, "left_anti")


def split_join(rows: DataFrame, ones: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """rows joined with ones (one row per key), where no key's rows land in one task whole.

    A key is hot if it has more than 1 / HOT_PARTS of all rows (and over HOT_ROWS), so there are fewer than HOT_PARTS hot keys at
    any size, and these may be broadcast.  The rows of a hot key are dealt over parts by the hash of all their columns, its one
    row is repeated for each part.  rows should be a table: it is read twice.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") > HOT_ROWS)
    hot = materialise(counts, "hot")
    found = hot.agg(F.count("*"), F.max("__n")).first()
    if not found[0]:
        return rows.join(ones, key, how)
    limit = max(HOT_ROWS, rows.count() // HOT_PARTS)
    hot = hot.where(F.col("__n") > limit).select(key, F.ceil(F.col("__n") / limit).cast("int").alias("__parts"))
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn("__part", F.coalesce(F.pmod(F.xxhash64(*rows.columns), F.col("__parts")), F.lit(0)).cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))
    repeated = ones.join(F.broadcast(hot), key, "left").withColumn("__part", each)
    return dealt.drop("__parts").join(repeated.drop("__parts"), [key, "__part"], how).drop("__part")


# ---------------------------------------------------------------- texts as bytes


def byte_chunks(column: pa.Array, limit: int = CHUNK_BYTES, rows: int = 1 << 14):
    """Yield (first row, last row + 1, bytes as uint8, offsets) over a string column; null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), lo + rows, n)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def _lut(keep) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    for b in range(256):
        low = b + 32 if 65 <= b <= 90 else b
        out[b] = low if keep(low) else 0
    return out


#: Lower-cased letters, digits and all non-ASCII bytes; 0 elsewhere.
WORD_LUT = _lut(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
#: Lower-cased letters and all non-ASCII bytes; 0 elsewhere.
LETTER_LUT = _lut(lambda b: 97 <= b <= 122 or b >= 128)

_POWERS = np.ones(256, np.uint64)
for _i in range(1, 256):
    _POWERS[_i] = (int(_POWERS[_i - 1]) * 0x9E3779B97F4A7C15 + 2 * _i) & 0xFFFFFFFFFFFFFFFF | 1


#: What a byte counts in a word's hash; borders count nothing.
_VALUES = np.arange(7, 263, dtype=np.uint64)
_VALUES[0] = 0


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def words_of(data: np.ndarray, offs: np.ndarray, lut: np.ndarray):
    """Words of a chunk: (first byte, end byte, document index in the chunk, normalised bytes).

    A word is a run of bytes that the table keeps; runs end at the border of a document.
    """
    norm = lut[data]
    inside = norm != 0
    if not len(data):
        e = np.zeros(0, np.int64)
        return e, e, e, norm
    edge = np.empty(len(data), bool)
    edge[0] = True
    edge[1:] = ~inside[:-1]
    cuts = offs[1:-1]
    edge[cuts[cuts < len(data)]] = True
    starts = np.flatnonzero(inside & edge)
    last = np.empty(len(data), bool)
    last[-1] = True
    last[:-1] = ~inside[1:]
    ends = cuts[(cuts > 0) & (cuts <= len(data))] - 1
    last[ends] = True
    ends = np.flatnonzero(inside & last) + 1
    doc = np.searchsorted(offs, starts, "right") - 1
    return starts, ends, doc, norm


def word_hashes(norm: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes and length."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    low = int(starts[0])
    body = norm[low:]
    place = np.arange(len(body), dtype=np.int64) - np.repeat(starts - low, np.diff(np.append(starts, len(norm))))
    terms = _POWERS.take(place & 255)
    terms *= _VALUES.take(body)
    sizes = ends - starts
    if int(sizes.max()) > 256:  # places beyond the table of powers also count their round
        terms += np.where(body != 0, place >> 8, 0).astype(np.uint64)
    return mix64(np.add.reduceat(terms, starts - low) + sizes.astype(np.uint64))


# ---------------------------------------------------------------- connected components


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected links (a, b): columns node, component (the smallest node).

    Alternates the two star operations on the link table until it is a forest of stars around smallest nodes, however many rounds
    that takes (their number grows with the logarithm of the links).  The state is a table in the shared scratch folder; a count
    reaches the driver, and a table is removed once the next one is written.  Nodes without links are absent.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    e = materialise(e, "links")
    while not _stars(e):
        old, both = e, e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        step = large.join(low, "u").select("u", "v", "m")
        small = step.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m")).distinct()
        e = materialise(small, "links")
        discard(old)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())


def _stars(links: DataFrame) -> bool:
    """Whether links (u > v, distinct) are stars: each u has one v, and no v is a u."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("lower")).union(links.select("v", F.lit(0)))
    more = ends.groupBy("node").agg(F.sum("lower").alias("n"), F.min("lower").alias("least")).where("n > 1 or n = 1 and least = 0")
    return not more.agg(F.count("*")).first()[0]


def renamed(rows: DataFrame, column: str, comp: DataFrame) -> DataFrame:
    """rows, a table, with the names in column replaced by their component in comp (node, component), where they have one."""
    now = comp.select(F.col("node").alias(column), F.col("component").alias("__now"))
    out = split_join(rows, now, column, "left")
    return out.select(*[F.coalesce("__now", c).alias(c) if c == column else c for c in rows.columns])
