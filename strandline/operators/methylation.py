"""Methylation profiles: background, scores, comparisons, events, imprinting and cell composition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import Save, quantiles, spreads


def background(profiles: DataFrame, leave_one_out: bool = False) -> DataFrame:
    """Per region and label: datasets, mean and standard deviation of the value (and per member without itself).

    The leave-one-out moments follow from n, the sum and the sum of squares; nothing is recomputed per member.
    """
    n, s, q = F.count("value"), F.sum("value"), F.sum(F.col("value") * F.col("value"))
    if not leave_one_out:
        return profiles.groupBy("region_label", "label").agg(n.alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("stdev"))
    sums = profiles.groupBy("region_label", "label").agg(n.alias("n"), s.alias("s"), q.alias("q"))
    rows = profiles.join(sums, ["region_label", "label"])
    m, left, square = F.col("n") - 1, F.col("s") - F.col("value"), F.col("q") - F.col("value") * F.col("value")
    var = F.try_divide(square - F.try_divide(left * left, m), m - 1)
    return rows.select("sample_id", "region_label", "label", m.alias("n"), F.try_divide(left, m).alias("mean"), F.sqrt(F.greatest(var, F.lit(0.0))).alias("stdev"))


def score(values: DataFrame, bg: DataFrame, z_min: float, d_min: float, n_min: int) -> DataFrame:
    """z and delta against the background of the value's label, and a category.

    InsufficientData below n_min datasets; Hyper or Hypo if both |z| and |delta| reach their bounds; else Uncategorized.
    """
    rows = values.join(bg, ["region_label", "label"], "left")
    delta = F.col("value") - F.col("mean")
    z = F.try_divide(delta, F.col("stdev"))
    far = (F.abs(z) >= z_min) & (F.abs(delta) >= d_min)
    kind = F.when(F.col("n").isNull() | (F.col("n") < n_min), "InsufficientData").when(far & (delta > 0), "HyperMethylated").when(far, "HypoMethylated").otherwise("Uncategorized")
    return rows.withColumns({"delta": delta, "z": z, "category": kind})


def compare(bg: DataFrame, a: str, b: str, z_min: float, d_min: float, n_min: int) -> DataFrame:
    """Two labels per region: delta of means, z, category; a missing side gives nulls and a note."""
    side = lambda label, t: bg.where(F.col("label") == label).select("region_label", F.col("n").alias(f"n_{t}"), F.col("mean").alias(f"mean_{t}"), F.col("stdev").alias(f"sd_{t}"))
    rows = side(a, "a").join(side(b, "b"), "region_label", "full_outer")
    delta = F.col("mean_a") - F.col("mean_b")
    error = F.sqrt(F.col("sd_a") * F.col("sd_a") / F.col("n_a") + F.col("sd_b") * F.col("sd_b") / F.col("n_b"))
    z = F.try_divide(delta, error)
    missing = F.col("n_a").isNull() | F.col("n_b").isNull()
    far = (F.abs(z) >= z_min) & (F.abs(delta) >= d_min)
    kind = F.when(missing | (F.col("n_a") < n_min) | (F.col("n_b") < n_min), "InsufficientData").when(far & (delta > 0), "Hyper").when(far, "Hypo").otherwise("Uncategorized")
    return rows.withColumns({"delta": delta, "z": z, "comparison": kind, "note": F.when(missing, "missing side").otherwise("")})


def event_counts(events: DataFrame, genes: str = "genes") -> DataFrame:
    """Rows (metric, key, value): events per region and type, per gene, and members per gene (genes joined by ;)."""
    marks = F.concat(
        F.array(F.struct(F.lit("events_per_region").alias("metric"), F.col("region_label").alias("key")), F.struct(F.lit("events_per_type").alias("metric"), F.col("category").alias("key"))),
        F.transform(F.filter(F.split(genes, ";"), lambda g: g != ""), lambda g: F.struct(F.lit("per_gene").alias("metric"), g.alias("key"))),
    )
    long = events.select("sample_id", F.explode(marks).alias("m")).select("sample_id", "m.metric", "m.key")
    counts = long.groupBy(F.when(F.col("metric") == "per_gene", "events_per_gene").otherwise(F.col("metric")).alias("metric"), "key").agg(F.count("*").alias("value"))
    members = long.where("metric = 'per_gene'").groupBy("key").agg(F.count_distinct("sample_id").alias("value")).select(F.lit("members_per_gene").alias("metric"), "key", "value")
    return counts.unionByName(members)


def pivot_counts(df: DataFrame, key: str, column: str, values: Sequence[str], prefix: str = "n_") -> DataFrame:
    """Counts of the known values of a column as columns, and of all rows."""
    return df.groupBy(key).agg(*[F.count_if(F.col(column) == v).alias(f"{prefix}{v}") for v in values], F.count("*").alias(f"{prefix}all"))


def region_table(bg: DataFrame, events: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Background of the label ALL with event counts per category (0 where a region has none)."""
    counts = pivot_counts(events, "region_label", "category", categories)
    names = [c for c in counts.columns if c != "region_label"]
    return bg.join(counts, "region_label", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in names})


def where_labels_lie(cmp: DataFrame, contig: Column, label: str) -> DataFrame:
    """Counts per label and contig group (autosomal, chrX, chrY)."""
    group = F.when(contig.isin("chrX", "chrY"), contig).otherwise("autosomal")
    return cmp.groupBy(label, group.alias("contig_group")).agg(F.count("*").alias("count"))


def annotate_regions(df: DataFrame, regions: DataFrame, key: str, defaults: dict[str, str]) -> DataFrame:
    """Attributes of a region map by key; defaults where the map has no row.  Spark broadcasts the map if it is small."""
    return df.join(regions, key, "left").withColumns({c: F.coalesce(c, F.lit(d)) for c, d in defaults.items()})


# ---------------------------------------------------------------- cell composition


def composition_stats(fractions: DataFrame, weighted) -> DataFrame:
    """Per cell type: median, nearest-rank p5 and p95, maximum and members with at least 5 %."""
    counts = fractions.groupBy("cell", "fraction").agg(F.count("*").alias("w"))
    q = weighted(counts, "cell", "fraction", "w", {"p5": 0.05, "p95": 0.95}).select("cell", "median", "p5", "p95")
    return fractions.groupBy("cell").agg(F.max("fraction").alias("max"), F.count_if(F.col("fraction") >= 0.05).alias("n_5pct")).join(q, "cell")


def lineage_sums(fractions: DataFrame, lineages: dict[int, str]) -> DataFrame:
    """Fractions per member and lineage; unknown cell types are `other`."""
    table = F.create_map(*[F.lit(x) for kv in lineages.items() for x in kv])
    return fractions.groupBy("sample_id", F.coalesce(F.try_element_at(table, F.col("cell").cast("int")), F.lit("other")).alias("lineage")).agg(F.sum("fraction").alias("fraction"))


def composition_table(fractions: DataFrame, cells: Sequence[int] | None = None) -> DataFrame:
    """One row per member: the largest cell type, its fraction, the sum of all, and one column per type.

    cells: the types that get a column; all types of the table without it (a dimension: as many as there are columns to make).
    """
    if cells is None:
        cells = sorted(r["cell"] for r in fractions.select("cell").distinct().collect())
    columns = [F.max(F.when(F.col("cell") == c, F.col("fraction"))).alias(f"cell_{c}") for c in cells]
    top = F.max_by("cell", F.struct("fraction", -F.col("cell"))).alias("top_cell")
    return fractions.groupBy("sample_id").agg(top, F.max("fraction").alias("top_fraction"), F.sum("fraction").alias("fraction_sum"), *columns)


def composition_outliers(fractions: DataFrame, floor: float, k: float, save: Save | None = None) -> DataFrame:
    """Members whose composition is far from the cohort's: half the summed absolute differences from the medians.

    The limit is the larger of a floor and median + k * 1.4826 * MAD of the distances; the three most different types are listed.
    Medians are found by their place among counted values; they are one row a cell type, and one row for the distances.
    """
    middle = quantiles(fractions, ["cell"], "fraction", {"median": 0.5}, save).drop("n")
    rows = fractions.join(middle, "cell").withColumn("gap", F.abs(F.col("fraction") - F.col("median")))
    order = Window.partitionBy("sample_id").orderBy(F.col("gap").desc(), "cell")
    ranked = rows.withColumn("n", F.row_number().over(order))
    top = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("n") <= 3, F.struct("n", "cell")))), lambda s: s["cell"].cast("string")), ",")
    far = ranked.groupBy("sample_id").agg((F.sum("gap") / 2).alias("distance"), top.alias("top_cells"))
    far = save(far, "distances") if save else far
    spread = spreads(far, [], "distance", save).select("median", "mad")
    limit = F.greatest(F.lit(floor), F.col("median") + k * 1.4826 * F.col("mad"))
    return far.crossJoin(F.broadcast(spread)).withColumn("limit", limit).where(F.col("distance") > F.col("limit")).select("sample_id", "distance", "limit", "top_cells")
