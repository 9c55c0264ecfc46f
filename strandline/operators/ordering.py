"""Windows, ordered prefixes, top-k, sorts and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import chrom_key, normal_quantile, severity
from .identity import DECLARED, both_ways
from .scan import STRETCH_ROWS, running
from .skew import BUCKET_ROWS, Save, join_one, ordered_counts


def row_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key in an order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__n") <= n).drop("__n")


def latest(runs: DataFrame, keys: Sequence[str], status: str | None = None, order: Sequence[str] = ("attempt", "run_id")) -> DataFrame:
    """The newest (successful) run per key; nulls in the order come last."""
    rows = runs.where(F.col("status") == status) if status else runs
    return row_first(rows, keys, [F.col(c).desc_nulls_last() for c in order])


def next_attempt(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    return runs.groupBy(*keys).agg((F.max("attempt") + 1).cast("long").alias("next_attempt"))


def closest(pairs: DataFrame, hubs: DataFrame | None = None, value: str = "relatedness") -> DataFrame:
    """Each member's closest relative: pairs are read both ways; the first by value, then by id.

    With hubs (sample_id), also the closest where neither is one: clean_relative, clean_relatedness and clean_ibs0; null for hubs and members
    that only hubs are listed with.
    """
    extra = [] if hubs is None else ["ibs0", "clear"]
    if hubs is not None:
        known = F.broadcast(hubs) if hubs.count() <= DECLARED else hubs  # counted; the pairs are not exchanged for them
        gone = lambda side: known.select(F.col("sample_id").alias(f"sample_{side}"), F.lit(True).alias(f"hub_{side}"))
        pairs = pairs.join(gone("a"), "sample_a", "left").join(gone("b"), "sample_b", "left").withColumn("clear", F.col("hub_a").isNull() & F.col("hub_b").isNull())
    both = both_ways(pairs, "sample_id", "relative", value, *extra)
    order = F.struct(F.col(value), -F.col("relative"))
    found = [F.max_by(F.struct("relative", value), order).alias("best")]
    named = ["best.*"]
    if hubs is not None:
        row = F.struct(F.col("relative").alias("clean_relative"), F.col(value).alias(f"clean_{value}"), F.col("ibs0").alias("clean_ibs0"))
        found.append(F.max_by(row, F.when(F.col("clear"), order)).alias("clean"))
        named.append("clean.*")
    return both.where(F.col(value).isNotNull()).groupBy("sample_id").agg(*found).select("sample_id", *named)


def lead_rows(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The first row of each group and the group's size."""
    size = F.count("*").over(Window.partitionBy(key)).alias("n_rows")
    return row_first(df.select("*", size), [key], order)


def bh(df: DataFrame, p: str = "p", save: Save | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Benjamini-Hochberg q-values over a whole table (null p: null q).

    q is the smallest p * m / rank among the same and larger p.  Equal p are one counted row, so a large group of ties is no
    large task; counts and running minima are windows inside ordered buckets, and one number per bucket is carried on.
    """
    rows = df.where(F.col(p).isNotNull()).withColumn("__p", F.col(p))
    counted = ordered_counts(rows.groupBy("__p").agg(F.count("*").alias("n")), [], "__p", save, bucket_rows)
    counted = save(counted, "ranked") if save else counted
    total, buckets = counted.agg(F.sum("n"), F.max("bucket")).first()
    down = Window.partitionBy("bucket").orderBy(F.col("__p").desc()).rowsBetween(Window.unboundedPreceding, 0)
    counted = counted.withColumn("raw", F.col("__p") * F.lit(total) / (F.col("before") + F.col("n")))
    counted = counted.withColumn("q", F.least(F.min("raw").over(down), F.lit(1.0)))
    if buckets:
        beyond = Window.partitionBy(F.lit(0)).orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
        lows = counted.groupBy("bucket").agg(F.min("raw").alias("low"))  # one row a bucket
        counted = counted.join(lows.select("bucket", F.min("low").over(beyond).alias("later")), "bucket").withColumn("q", F.least("q", "later"))
    q = counted.select("__p", "q")
    rest = df.where(F.col(p).isNull()).withColumn("q", F.lit(None).cast("double"))
    return join_one(rows, q, ["__p"], counted.select("__p", "n"), total or 0).drop("__p").unionByName(rest)


def mean_rank(df: DataFrame, group: str, value: str, save: Save | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Ranks with ties at their mean, and the number of the group's rows with a value (null value: null rank).

    Ranks are counts of distinct values in ordered buckets of a group, so a group of very many rows is no single task.
    """
    rows = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    counted = ordered_counts(rows.groupBy(group, value).agg(F.count("*").alias("n")), [group], value, save, bucket_rows)
    sizes = rows.groupBy(group).agg(F.count("*").alias("group_size"))
    ranks = counted.select(group, value, (F.col("before") + (F.col("n") + 1) / 2).alias("mean_rank"))
    ranked = join_one(rows, ranks, [group, value], counted.select(group, value, "n"), rows.count())
    ranked = ranked.join(sizes, group).select(*df.columns, "mean_rank", "group_size")
    rest = df.where(F.col(value).isNull() | F.col(group).isNull())
    return ranked.unionByName(rest.withColumns({"mean_rank": F.lit(None).cast("double"), "group_size": F.lit(None).cast("long")}))


def rank_normal(df: DataFrame, group: str, value: str) -> DataFrame:
    """mean_rank and the inverse-normal score of (rank - 1/2) / n."""
    ranked = mean_rank(df, group, value)
    return ranked.withColumn("z", normal_quantile((F.col("mean_rank") - 0.5) / F.col("group_size")))


def cumulative(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, save: Save | None = None, stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """Running sum and running share of the group's total."""
    rows = running(df, keys, order, value, "running", save=save, stretch_rows=stretch_rows)
    total = df.groupBy(*keys).agg(F.sum(value).alias("__total"))
    same = [F.col(f"__{k}").eqNullSafe(rows[k]) for k in keys]
    total = total.select(*[F.col(k).alias(f"__{k}") for k in keys], "__total")
    return rows.join(total, same).select(*df.columns, "running", F.try_divide("running", "__total").alias("share"))


def carried_forward(values: DataFrame, keys: DataFrame, positions: DataFrame, key: str, position: str, value: str) -> DataFrame:
    """Dense grid of key x position; a missing position keeps the last value (0 before the first); summed over keys.

    keys and positions are dimension tables (contigs and members): the grid is as large as the result needs.
    """
    grid = keys.crossJoin(positions).join(values, [key, position], "left")
    last = F.last(value, ignorenulls=True).over(Window.partitionBy(key).orderBy(position).rowsBetween(Window.unboundedPreceding, 0))
    return grid.select(position, F.coalesce(last, F.lit(0)).alias("v")).groupBy(position).agg(F.sum("v").cast("long").alias("total"))


def concurrency(df: DataFrame, key: str, start: str, end: str, save: Save | None = None, stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """In-flight intervals over time per key: the step series; a start counts before an end at the same time.

    A busy key's series is cut into stretches of time and the number in flight is carried on (scan.running).
    """
    steps = df.select(key, F.col(start).alias("t"), F.lit(1).alias("d")).unionByName(df.select(key, F.col(end).alias("t"), F.lit(-1).alias("d")))
    steps = steps.groupBy(key, "t", "d").agg(F.sum("d").alias("n"))  # one row per change, whatever the number of intervals
    steps = running(steps.withColumn("__turn", -F.col("d")), [key], ["t", "__turn"], "n", "in_flight", save=save, stretch_rows=stretch_rows)
    return steps.select(key, "t", "d", F.col("in_flight").cast("long").alias("in_flight"))


def peak(series: DataFrame, key: str) -> DataFrame:
    return series.groupBy(key).agg(F.max("in_flight").alias("peak"))


def downsample(df: DataFrame, pixel: Column, t: str, value: str, tie: str) -> DataFrame:
    """First, least, largest and last value per pixel column."""
    order = F.struct(t, tie)
    return df.groupBy(pixel.alias("pixel")).agg(
        F.min_by(value, order).alias("first"), F.min(value).alias("least"), F.max(value).alias("largest"), F.max_by(value, order).alias("last")
    )


def recent_median(df: DataFrame, key: str, order: Sequence[Column], value: str, k: int) -> DataFrame:
    """Median of the k newest rows per key."""
    return row_first(df, [key], order, k).groupBy(key).agg(F.median(value).alias("median"), F.count("*").alias("n"))


def emit_prefix(ranked: DataFrame, keep: Column, k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of a saved order that pass, numbered: prefixes of different k are nested."""
    passing = ranked.where(keep).orderBy(rank).limit(k)
    return passing.withColumn("position", F.row_number().over(Window.orderBy(rank)).cast("long"))  # k rows


def restore_order(df: DataFrame, order: DataFrame, key: str) -> DataFrame:
    """Rows in the order of a table of keys and positions."""
    return df.join(order, key).orderBy("position")


def genome_sort(df: DataFrame, chrom: str, *columns: str) -> DataFrame:
    """Range-partitioned sort by contig in natural order, then by the columns."""
    keyed = df.withColumn("__k", chrom_key(F.col(chrom)))
    return keyed.orderBy("__k", *columns).drop("__k")


def sort_events(df: DataFrame, gene: str, *columns: str) -> DataFrame:
    """By gene, rows without one last."""
    missing = F.col(gene).isNull() | (F.col(gene) == "")
    return df.orderBy(missing, gene, *columns)


def sort_findings(df: DataFrame, level: str, *columns: str) -> DataFrame:
    return df.orderBy(severity(F.col(level)).desc(), *columns)


def worst(df: DataFrame, key: str, level: str) -> DataFrame:
    return df.groupBy(key).agg(F.max_by(level, severity(F.col(level))).alias("worst"))


def topk(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


# ---------------------------------------------------------------- sets


def gather(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of shard tables; all must have the same columns in the same order."""
    first = parts[0]
    for p in parts[1:]:
        if p.columns != first.columns:
            raise ValueError(f"columns differ: {p.columns} and {first.columns}")
    out = first
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def merge_duplicate_alleles(gt: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of the same allele and sample as one: called is the largest, alt the sum up to called."""
    called = F.max("called")
    return gt.groupBy(*key).agg(called.alias("called"), F.least(called, F.sum(F.coalesce("alt", F.lit(0)))).cast("int").alias("alt"))


def set_diff(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Ids of one side only, with the side."""
    only_a = a.select(key).distinct().join(b.select(key).distinct(), key, "left_anti").withColumn("only_in", F.lit("a"))
    only_b = b.select(key).distinct().join(a.select(key).distinct(), key, "left_anti").withColumn("only_in", F.lit("b"))
    return only_a.unionByName(only_b)


def freeze(ids: DataFrame, group: str, key: str, position: str) -> DataFrame:
    """Per list: length, number of repeated ids and the SHA-256 of the ids in order, one per line."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col(key).cast("string").alias("k")))), lambda s: s["k"])
    return ids.groupBy(group).agg(
        F.count("*").alias("n"), (F.count("*") - F.count_distinct(key)).alias("repeated"), F.sha2(F.array_join(ordered, "\n"), 256).alias("sha256")
    )


def is_prefix(a: DataFrame, b: DataFrame, key: str, position: str = "position") -> DataFrame:
    """One row: is list a the beginning of list b?"""
    joined = a.select(position, F.col(key).alias("x")).join(b.select(position, F.col(key).alias("y")), position, "left")
    return joined.agg(F.coalesce(F.bool_and(F.col("x").eqNullSafe(F.col("y"))), F.lit(True)).alias("is_prefix"), F.count("*").alias("n"))
