"""Interval joins and coverage on binned contigs.

Intervals are half-open [start, end).  Both sides are expanded to fixed-width bins and joined on (contig, bin); the exact
test follows, and a pair is kept only in the first bin both sides share, so nothing has to be made distinct afterwards.
A width near the usual interval length keeps the expansion small; it is a parameter of every join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scan import STRETCH_ROWS, running
from .skew import Save, ordered_counts

BIN = 4096


def bins(start: Column, end: Column, width: int = BIN) -> Column:
    """Numbers of the bins that [start, end) touches; an empty interval touches the bin of its start."""
    first = F.floor(start / width)
    return F.sequence(first, F.greatest(first, F.floor((end - 1) / width)))


def overlap_join(a: DataFrame, b: DataFrame, width: int = BIN, how: str = "inner") -> DataFrame:
    """Pairs of overlapping intervals with overlap_bp.

    a: chrom, a_start, a_end, ...; b: chrom, b_start, b_end, ...; other columns must differ in name.  how: inner or left.
    """
    x = a.withColumn("__bin", F.explode(bins(F.col("a_start"), F.col("a_end"), width)))
    y = b.withColumn("__bin", F.explode(bins(F.col("b_start"), F.col("b_end"), width))).withColumnRenamed("chrom", "__chrom")
    low, high = F.greatest("a_start", "b_start"), F.least("a_end", "b_end")
    found = x.join(y.withColumnRenamed("__bin", "__bin_b"), (x["chrom"] == F.col("__chrom")) & (x["__bin"] == F.col("__bin_b")) & (low < high) & (F.floor(low / width) == x["__bin"]))
    found = found.withColumn("overlap_bp", (high - low).cast("long")).drop("__bin", "__bin_b", "__chrom")
    if how == "inner":
        return found
    # whether a row has an overlap depends on its place alone; numbers given to rows would differ from one evaluation to the next
    place = ["chrom", "a_start", "a_end"]
    hit = found.select(*[F.col(c).alias(f"__{c}") for c in place]).distinct()
    alone = a.join(hit, reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in place]), "left_anti")
    return found.unionByName(alone, allowMissingColumns=True)


def point_join(points: DataFrame, regions: DataFrame, width: int = BIN) -> DataFrame:
    """Points (chrom, pos, ...) with every region (chrom, b_start, b_end, ...) that holds them."""
    p = points.withColumn("__bin", F.floor(F.col("pos") / width))
    r = regions.withColumn("__bin", F.explode(bins(F.col("b_start"), F.col("b_end"), width)))
    return p.join(r, ["chrom", "__bin"]).where("pos >= b_start and pos < b_end").drop("__bin")


def in_regions(points: DataFrame, regions: DataFrame, flag: str, key: str, width: int = BIN) -> DataFrame:
    """points with a flag: inside any region?  Nested and overlapping regions count once."""
    inside = point_join(points.select(key, "chrom", "pos"), regions.select("chrom", "b_start", "b_end"), width).select(key).distinct()
    return points.join(inside.withColumn(flag, F.lit(True)), key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def soft_filter(records: DataFrame, regions: DataFrame, name: str, key: str) -> DataFrame:
    """records (chrom, a_start, a_end, filters) with a filter name added to those outside every region."""
    inside = overlap_join(records.select(key, "chrom", "a_start", "a_end"), regions.select("chrom", "b_start", "b_end")).select(key).distinct()
    flagged = records.join(inside.withColumn("__in", F.lit(True)), key, "left")
    added = F.array_union(F.filter("filters", lambda x: x != "PASS"), F.array(F.lit(name)))
    return flagged.withColumn("filters", F.when(F.col("__in").isNull(), added).otherwise(F.col("filters"))).drop("__in")


def near_join(regions: DataFrame, genes: DataFrame, window: int, width: int = BIN * 4) -> DataFrame:
    """Genes whose start lies within a window of a region or whose body overlaps it, with the distance of the start.

    regions: chrom, a_start, a_end, ...; genes: chrom, b_start, b_end, tss, ....
    """
    wide = genes.withColumns({"g_start": F.col("b_start"), "g_end": F.col("b_end")}).withColumns(
        {"b_start": F.least("g_start", F.col("tss") - window), "b_end": F.greatest("g_end", F.col("tss") + window + 1)}
    )
    found = overlap_join(regions, wide, width)
    distance = F.when(F.col("tss") < F.col("a_start"), F.col("a_start") - F.col("tss")).when(F.col("tss") >= F.col("a_end"), F.col("tss") - F.col("a_end") + 1).otherwise(0)
    body = (F.col("g_start") < F.col("a_end")) & (F.col("g_end") > F.col("a_start"))
    return found.withColumns({"distance": distance.cast("long"), "in_body": body}).where((F.col("distance") <= window) | F.col("in_body"))


def region_genes(near: DataFrame, key: str, promoter: int, imprinted: Column) -> DataFrame:
    """Per region: its genes by distance then symbol, and its type: imprinted, promoter, gene_body or intergenic."""
    genes = F.array_sort(F.collect_set(F.struct("distance", "gene")))
    kind = F.when(F.max(imprinted.cast("int")) == 1, "imprinted").when(F.min("distance") <= promoter, "promoter").when(F.max(F.col("in_body").cast("int")) == 1, "gene_body").otherwise("intergenic")
    return near.groupBy(key).agg(F.array_join(F.array_distinct(F.transform(genes, lambda g: g["gene"])), ";").alias("genes"), kind.alias("region_type"))


def cis_pairs(islands: DataFrame, variants: DataFrame, window: int, width: int = BIN * 8) -> DataFrame:
    """(island, variant) within a window on the same contig, with the signed gap: negative before, positive after, 0 inside.

    islands: chrom, a_start, a_end, ...; variants: chrom, pos, ....
    """
    wide = islands.withColumns({"b_start": F.col("a_start") - window, "b_end": F.col("a_end") + window})
    gap = F.when(F.col("pos") < F.col("a_start"), F.col("pos") - F.col("a_start")).when(F.col("pos") >= F.col("a_end"), F.col("pos") - F.col("a_end") + 1).otherwise(0)
    return point_join(variants, wide, width).withColumn("distance", gap.cast("long")).drop("b_start", "b_end")


def far_pairs(islands: DataFrame, variants: DataFrame, far_bp: int, k: int, seed: int, island: str, variant: str, save: Save | None = None) -> DataFrame:
    """k variants per island at least far_bp away on the same contig (all, if there are fewer), drawn at random by the seed.

    The far variants of an island are two runs of the contig's variants in order.  They are cut into k strata of equal size, and
    one place of each is drawn by a hash of seed, island and stratum; the place is then looked up by its number.  Nothing is
    joined by contig alone, so the work grows with islands and variants, not with their product.
    """
    ends = islands.select("chrom", F.explode(F.array(F.col("a_start") - far_bp + 1, F.col("a_end") + far_bp - 1)).alias("pos"))
    known = variants.groupBy("chrom", "pos").agg(F.count("*").alias("n"))
    both = known.unionByName(ends.select("chrom", "pos", F.lit(0).cast("long").alias("n")))
    placed = ordered_counts(both.groupBy("chrom", "pos").agg(F.sum("n").alias("n")), ["chrom"], "pos", save)
    placed = (save(placed, "placed") if save else placed).select("chrom", "pos", "before")
    same = Window.partitionBy("chrom", "pos").orderBy(variant)
    numbered = variants.join(placed, ["chrom", "pos"]).withColumn("__no", F.col("before") + F.row_number().over(same) - 1)
    at = lambda name, pos: placed.select("chrom", F.col("pos").alias(pos), F.col("before").alias(name))
    rows = islands.withColumns({"__left": F.col("a_start") - far_bp + 1, "__right": F.col("a_end") + far_bp - 1})
    rows = rows.join(at("__below", "__left"), ["chrom", "__left"]).join(at("__until", "__right"), ["chrom", "__right"])
    rows = rows.join(variants.groupBy("chrom").agg(F.count("*").alias("__all")), "chrom").withColumn("__far", F.col("__below") + F.col("__all") - F.col("__until"))
    rows = rows.withColumn("__j", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    start = lambda j: F.floor(F.col("__far") * j / F.lit(k))
    draw = F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(seed).cast("string"), F.col(island).cast("string"), F.col("__j").cast("string"))), 1, 8), 16, 10).cast("long")
    rows = rows.withColumns({"__from": start(F.col("__j")), "__size": start(F.col("__j") + 1) - start(F.col("__j"))}).where("__size > 0")
    place = F.col("__from") + F.pmod(draw, F.col("__size"))
    rows = rows.withColumn("__no", F.when(place < F.col("__below"), place).otherwise(place - F.col("__below") + F.col("__until")).cast("long"))
    found = rows.select(*islands.columns, "__no").join(numbered.select("chrom", "__no", *[c for c in variants.columns if c != "chrom"]), ["chrom", "__no"])
    return found.drop("__no")


def merge_intervals(df: DataFrame, keys: Sequence[str] = ("chrom",), save: Save | None = None, stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """Union of overlapping or touching intervals: keys, start, end and the number of intervals in it.

    Intervals of one start are one row; the furthest end so far is carried from stretch to stretch of the starts (scan.running), so a contig
    with most of the intervals is cut as well.
    """
    rows = df.groupBy(*keys, "start").agg(F.max("end").alias("end"), F.count("*").alias("n"))
    rows = running(rows, keys, ["start"], "end", "__reach", "max", own=False, save=save, stretch_rows=stretch_rows)
    new = F.when(F.col("__reach").isNull() | (F.col("start") > F.col("__reach")), 1).otherwise(0)
    rows = running(rows, keys, ["start"], new, "__island", save=save, stretch_rows=stretch_rows)
    return rows.groupBy(*keys, "__island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n")).drop("__island")


def _unions(a: DataFrame, b: DataFrame, save: Save | None, stretch_rows: int) -> list[DataFrame]:
    named = lambda df, s: merge_intervals(df, save=save, stretch_rows=stretch_rows).select("chrom", F.col("start").alias(f"{s}_start"), F.col("end").alias(f"{s}_end"))
    return [named(a, "a"), named(b, "b")]


def intersect_intervals(a: DataFrame, b: DataFrame, width: int = BIN, save: Save | None = None, stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """Parts of a that b's union covers: chrom, start, end."""
    return overlap_join(*_unions(a, b, save, stretch_rows), width).select("chrom", F.greatest("a_start", "b_start").alias("start"), F.least("a_end", "b_end").alias("end"))


def subtract_intervals(a: DataFrame, b: DataFrame, width: int = BIN, save: Save | None = None, stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """Parts of a's union outside b's: what of each interval of a precedes a part of b starts where the part before it ended.

    An interval of a may meet very many of b's: the part before is found by a running maximum over the starts, not by a window that holds
    them all.
    """
    x, y = _unions(a, b, save, stretch_rows)
    found = overlap_join(x, y, width, "left")
    found = running(found, ["chrom", "a_start"], ["b_start"], "b_end", "__before", "max", own=False, save=save, stretch_rows=stretch_rows)
    parts = found.select("chrom", F.coalesce("__before", "a_start").alias("start"), F.coalesce("b_start", "a_end").alias("end"))
    tails = found.groupBy("chrom", "a_start").agg(F.max("b_end").alias("start"), F.max("a_end").alias("end")).where("start is not null")
    return parts.unionByName(tails.select("chrom", "start", "end")).where("start < end")


def twin_of(overlaps: DataFrame, ordinary: str, named: str) -> DataFrame:
    """The first named locus of each ordinary one: the largest overlap, then the smallest id."""
    return overlaps.groupBy(ordinary).agg(F.max_by(named, F.struct("overlap_bp", -F.col(named))).alias("twin"))


def bin_mean(df: DataFrame, lengths: DataFrame, width: int) -> DataFrame:
    """Mean signal per fixed bin of every contig; bins without values are null.  df: chrom, pos, value; lengths: chrom, length."""
    means = df.groupBy("chrom", F.floor(F.col("pos") / width).alias("bin")).agg(F.avg("value").alias("mean"))
    grid = lengths.select("chrom", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / width))).alias("bin"))
    return grid.join(means, ["chrom", "bin"], "left")


def bin_coverage(df: DataFrame, lengths: DataFrame, width: int, save: Save | None = None) -> DataFrame:
    """Covered bases and fraction per fixed bin; intervals are cut at bin borders, the last bin is scaled by its length."""
    cut = merge_intervals(df, save=save).withColumn("bin", F.explode(bins(F.col("start"), F.col("end"), width)))
    part = F.least("end", (F.col("bin") + 1) * width) - F.greatest("start", F.col("bin") * width)
    covered = cut.groupBy("chrom", "bin").agg(F.sum(part).alias("bp"))
    grid = lengths.select("chrom", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / width))).alias("bin"))
    size = F.least(F.lit(width), F.col("length") - F.col("bin") * width)
    bp = F.coalesce("bp", F.lit(0)).cast("long")
    return grid.join(covered, ["chrom", "bin"], "left").select("chrom", "bin", bp.alias("bp"), (bp / size).alias("fraction"))


def tiles(lengths: DataFrame, chunk: int, keep: Column | None = None) -> DataFrame:
    """Shards of fixed chunks of the kept contigs; the others together are the shard `rest`."""
    keep = F.lit(True) if keep is None else keep
    cut = lengths.where(keep).withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(chunk).cast("long"))))
    number = (F.floor(F.col("start") / chunk) + 1).cast("string")
    own = cut.select(F.concat_ws("_", "chrom", F.lpad(number, 3, "0")).alias("shard"), "chrom", "start", F.least(F.col("start") + chunk, F.col("length")).alias("end"))
    rest = lengths.where(~keep).select(F.lit("rest").alias("shard"), "chrom", F.lit(0).cast("long").alias("start"), F.col("length").alias("end"))
    return own.unionByName(rest)
