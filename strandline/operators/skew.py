"""Joins and ordered counts that hold when one key or one stretch of values has very many rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A key with more rows is dealt over several tasks.
HOT_ROWS = 100_000
#: Hot keys hold more than 1 / HOT_PARTS of all rows each, so fewer than this are ever broadcast.
HOT_PARTS = 100_000
#: Distinct values of one ordered bucket.
BUCKET_ROWS = 1_000_000

Save = Callable[[DataFrame, str], DataFrame]


def join_one(rows: DataFrame, ones: DataFrame, keys: Sequence[str], counts: DataFrame, total: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """rows joined with ones (one row per keys): the rows of a hot key are dealt over parts, its one row is repeated for each.

    counts: keys and n, the number of rows of the keys; total: of all rows.
    """
    limit = max(hot_rows, total // HOT_PARTS)
    if total <= limit:
        return rows.join(ones, list(keys))
    hot = counts.where(F.col("n") > limit).select(*keys, F.ceil(F.col("n") / limit).cast("int").alias("__parts"))
    dealt = rows.join(F.broadcast(hot), list(keys), "left")
    dealt = dealt.withColumn("__part", F.coalesce(F.pmod(F.xxhash64(*rows.columns), F.col("__parts")), F.lit(0)).cast("int")).drop("__parts")
    each = F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))
    repeated = ones.join(F.broadcast(hot), list(keys), "left").withColumn("__part", each).drop("__parts")
    return dealt.join(repeated, [*keys, "__part"]).drop("__part")


def ordered_counts(counted: DataFrame, keys: Sequence[str], value: str, save: Save | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """counted (keys, value, n; one row per keys and value) with ``before``: the sum of n of smaller values of the same keys,
    and ``bucket``: the ordered bucket of the value.

    Values are cut into ordered buckets of about bucket_rows rows, running sums stay inside a bucket, and one number per keys
    and bucket is carried on.  save keeps the counted table, which is read several times.
    """
    counted = save(counted, "counted") if save else counted
    buckets = -(-counted.count() // bucket_rows)
    if buckets <= 1:
        rows = counted.withColumn("bucket", F.lit(0))
    else:
        bounds = sorted(set(counted.approxQuantile(value, [i / buckets for i in range(1, buckets)], 0.2 / buckets)))
        rows = counted.withColumn("bucket", F.size(F.filter(F.array(*[F.lit(x) for x in bounds]), lambda x: x <= F.col(value))))
    inside = Window.partitionBy(*keys, "bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    if buckets <= 1:
        return rows
    across = Window.partitionBy(*keys or [F.lit(0)]).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*keys, "bucket").agg(F.sum("n").alias("__n"))  # one row per keys and bucket
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(across), F.lit(0))).drop("__n")
    return rows.join(sizes, [*keys, "bucket"]).withColumn("before", F.col("before") + F.col("__before")).drop("__before")


def quantiles(rows: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float], save: Save | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """keys, n (values that are not null) and a column for each share: the exact quantile, interpolated between its two neighbours.

    Equal values are counted once and numbered over ordered buckets (see ordered_counts); a quantile then lies on the one or two values
    whose numbers hold its place.  No task has all values of a key.
    """
    return _placed(rows, keys, value, shares, save, bucket_rows, True)


def order_statistics(rows: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float], save: Save | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """As quantiles, without interpolation: the first value with at least the share of all values at or below it."""
    return _placed(rows, keys, value, shares, save, bucket_rows, False)


def _placed(rows: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float], save: Save | None, bucket_rows: int, between: bool) -> DataFrame:
    counted = rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("__v")).agg(F.count("*").alias("n"))
    return _quantiles_of(counted, keys, shares, save, bucket_rows, between)


def _quantiles_of(counted: DataFrame, keys: Sequence[str], shares: dict[str, float], save: Save | None, bucket_rows: int, between: bool) -> DataFrame:
    """Quantiles of counted values (keys, __v, n)."""
    counted = save(counted, "counted") if save else counted
    ranked = ordered_counts(counted, keys, "__v", None, bucket_rows)
    total = counted.groupBy(*keys).agg(F.sum("n").alias("__total"))
    at = ranked.join(total, list(keys)) if keys else ranked.crossJoin(F.broadcast(total))  # one row
    found = []
    for name, p in shares.items():
        place = F.lit(p) * (F.col("__total") - 1) if between else F.greatest(F.ceil(F.lit(p) * F.col("__total")) - 1, F.lit(0))
        low = F.floor(place)
        holds = lambda k: (F.col("before") <= k) & (k < F.col("before") + F.col("n"))
        under, over = (F.max(F.when(holds(k), F.col("__v"))) for k in (low, F.ceil(place)))
        found += [under.alias(f"__low_{name}"), over.alias(f"__high_{name}"), F.max(place - low).alias(f"__part_{name}")]
    out = at.groupBy(*keys).agg(F.max("__total").alias("n"), *found)
    if not keys:
        out = out.where("n is not null")
    step = lambda c: F.col(f"__low_{c}") + (F.col(f"__high_{c}") - F.col(f"__low_{c}")) * F.col(f"__part_{c}") if between else F.col(f"__low_{c}")
    return out.select(*keys, "n", *[step(c).alias(c) for c in shares])


def spreads(rows: DataFrame, keys: Sequence[str], value: str, save: Save | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """keys, n, median and mad (the median distance from the median) of the values that are not null."""
    rows = rows.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("__x"))
    middle = quantiles(rows, keys, "__x", {"median": 0.5}, save, bucket_rows)
    middle = save(middle, "middle") if save else middle
    counted = rows.groupBy(*keys, "__x").agg(F.count("*").alias("__w"))
    beside = counted.join(middle, list(keys)) if keys else counted.crossJoin(F.broadcast(middle))  # one row
    away = beside.groupBy(*keys, F.abs(F.col("__x") - F.col("median")).alias("__v")).agg(F.sum("__w").alias("n"))
    spread = _quantiles_of(away, keys, {"mad": 0.5}, save, bucket_rows, True)
    spread = spread.drop("n")
    return middle.join(spread, list(keys)) if keys else middle.crossJoin(F.broadcast(spread))
