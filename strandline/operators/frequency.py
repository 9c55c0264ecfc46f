"""Cohort frequencies: stratified allele counts, value tables, summaries and support bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import bin_label, binned, contig_class

STRATA = ("", "XX", "XY")


def _count(x: Column) -> Column:
    return F.coalesce(F.sum(x), F.lit(0)).cast("long")


def allele_freq(gt: DataFrame, members: DataFrame, key: str = "site_id", missing_is_ref: bool = False) -> DataFrame:
    """Counts per site, overall and by sex; members of unknown sex are in the overall ones only.

    gt: key, sample_id, alt, called (0, 1 or 2 alleles; half calls count under Hemi).  Members without a row, and those
    whose row is a no-call, count as two reference alleles if missing_is_ref, else not at all.
    """
    rows = gt.join(members.select("sample_id", "sex"), "sample_id")
    called = F.when(F.col("called") == 0, 2).otherwise(F.col("called")) if missing_is_ref else F.col("called")
    alt = F.coalesce("alt", F.lit(0))
    aggs = []
    for s in STRATA:
        inside = F.col("sex") == s if s else F.lit(True)
        tail = f"_{s}" if s else ""
        aggs += [
            _count(F.when(inside, alt)).alias(f"AC{tail}"),
            _count(F.when(inside, called)).alias(f"AN{tail}"),
            _count(F.when(inside & (called > 0), 1)).alias(f"NS{tail}"),
            _count(F.when(inside & (called == 2) & (alt == 2), 2)).alias(f"AC_Hom{tail}"),
            _count(F.when(inside & (called == 2) & (alt == 1), 1)).alias(f"AC_Het{tail}"),
            _count(F.when(inside & (called == 1), alt)).alias(f"AC_Hemi{tail}"),
            F.count_if(inside).alias(f"seen{tail}"),
        ]
    out = rows.groupBy(key).agg(*aggs)
    if missing_is_ref:
        sizes = members.agg(*[(F.count_if(F.col("sex") == s) if s else F.count("*")).alias(f"size_{s}") for s in STRATA])
        out = out.crossJoin(F.broadcast(sizes))  # one row
        for s in STRATA:
            tail = f"_{s}" if s else ""
            absent = F.col(f"size_{s}") - F.col(f"seen{tail}")
            out = out.withColumns({f"AN{tail}": F.col(f"AN{tail}") + 2 * absent, f"NS{tail}": F.col(f"NS{tail}") + absent})
    for s in STRATA:
        tail = f"_{s}" if s else ""
        out = out.withColumn(f"AF{tail}", F.round(F.try_divide(F.col(f"AC{tail}"), F.col(f"AN{tail}")), 6))
    return out.select(key, *[f"{m}{'_' + s if s else ''}" for s in STRATA for m in ("AC", "AN", "AF", "NS", "AC_Hom", "AC_Het", "AC_Hemi")])


def carrier_freq(gt: DataFrame, n: int | Column, key: str = "site_id") -> DataFrame:
    """SUPP (members with an alternate allele) and CF = SUPP / n per site."""
    n = F.lit(n) if isinstance(n, int) else n
    carriers = gt.where("alt > 0").groupBy(key).agg(F.count_distinct("sample_id").alias("SUPP"))
    return carriers.select(key, "SUPP", F.round(F.col("SUPP") / n, 6).alias("CF"))


def eav(df: DataFrame, metric: str, keys: Column, value: Column | None = None) -> DataFrame:
    """Counts (or sums) per key as rows metric, key, value."""
    agg = F.count("*") if value is None else _count(value)
    return df.groupBy(keys.alias("key")).agg(agg.cast("long").alias("value")).select(F.lit(metric).alias("metric"), "key", "value")


def one_value(df: DataFrame, metric: str, value: Column) -> DataFrame:
    return df.agg(value.alias("value")).select(F.lit(metric).alias("metric"), F.lit("all").alias("key"), F.col("value").cast("long").alias("value"))


def united(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def freq_summary(sites: DataFrame, n_members: int | Column, low_call: float = 0.9) -> DataFrame:
    """Long summary of site counts: type, contig class, filter, AF bin, carried, singletons and low call rates.

    sites: svtype, chrom, filter, AC, AF, NS, AC_XX, AC_XY.  AF bins hold records with AC > 0.  The statistics of a record
    are expanded into (metric, key) pairs and counted in one aggregation.
    """
    n = F.lit(n_members) if isinstance(n_members, int) else n_members
    pair = lambda metric, key, when=None: F.when(F.lit(True) if when is None else when, F.struct(F.lit(metric).alias("metric"), key.alias("key")))
    marks = F.array_compact(
        F.array(
            pair("by_type", F.col("svtype")),
            pair("by_class", contig_class(F.col("chrom"))),
            pair("by_filter", F.col("filter")),
            pair("by_af", binned(F.col("AF"), "af"), F.col("AC") > 0),
            pair("carried", F.lit("all"), F.col("AC") > 0),
            pair("carried", F.lit("XX"), F.col("AC_XX") > 0),
            pair("carried", F.lit("XY"), F.col("AC_XY") > 0),
            pair("singletons", F.lit("all"), F.col("AC") == 1),
            pair("low_call_rate", F.lit("all"), F.col("NS") < low_call * n),
        )
    )
    return sites.select(F.explode(marks).alias("m")).groupBy("m.metric", "m.key").agg(F.count("*").alias("value"))


def freq_table(rows: DataFrame, key: str, strata: dict[str, str], by: list[str]) -> DataFrame:
    """Value frequencies per group x stratum: count, fraction, n_called and n_members (called or not).

    rows: sample_id, key (null: not called), the columns of by and of strata (kind of stratum to its column).
    """
    kinds = F.array(F.struct(F.lit("all").alias("kind"), F.lit("all").alias("stratum")), *[F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("stratum")) for k, c in strata.items()])
    long = rows.select("sample_id", F.col(key).alias("value"), *by, F.explode(kinds).alias("s")).select("sample_id", "value", *by, "s.kind", "s.stratum")
    groups = [*by, "kind", "stratum"]
    members = long.groupBy(*groups).agg(F.count_distinct("sample_id").alias("n_members"))
    counts = long.where("value is not null").groupBy(*groups, "value").agg(F.count("*").alias("count"))
    called = F.sum("count").over(Window.partitionBy(*groups))
    counts = counts.select(*groups, "value", "count", F.round(F.col("count") / called, 4).alias("fraction"), called.alias("n_called"))
    return counts.join(members, groups)


def sv_summary(sites: DataFrame) -> DataFrame:
    """Rows (metric, key, value) by type, size bin, filter and support."""
    marks = F.array(
        F.struct(F.lit("type").alias("metric"), F.col("svtype").alias("key")),
        F.struct(F.lit("size").alias("metric"), binned(F.col("svlen"), "sv_size").alias("key")),
        F.struct(F.lit("filter").alias("metric"), F.col("filter").alias("key")),
        F.struct(F.lit("support").alias("metric"), F.col("SUPP").cast("string").alias("key")),
    )
    return sites.select(F.explode(marks).alias("m")).groupBy("m.metric", "m.key").agg(F.count("*").alias("value"))


def support_edges(n: int) -> list[int]:
    """Upper ends of the support bins of a cohort of n: 1, 2, 5, 10, then shares, then all but one; degenerate ones left out."""
    out: list[int] = []
    for e in [1, 2, 5, 10, *(int(n * f) for f in (0.01, 0.05, 0.10, 0.50)), n - 1]:
        if 1 <= e < n and (not out or e > out[-1]):
            out.append(e)
    return out


def supp_bins(supp: DataFrame, n: int) -> DataFrame:
    """Records by bins of their support (column SUPP), low end to high end."""
    highs = support_edges(n)
    lows = [1, *(h + 1 for h in highs)]
    labels = [str(a) if a == b else f"{a}-{b}" for a, b in zip(lows, highs)] + [f"all {n}"]
    label = bin_label(F.col("SUPP"), [h + 1 for h in highs], labels)
    return supp.where("SUPP >= 1").groupBy(label.alias("bin")).agg(F.count("*").alias("records"))


def call_spectra(sites: DataFrame) -> DataFrame:
    """Counts by caller, filter class, kind, size bin and contig class (columns of these names)."""
    keys = ["caller", "filter_class", "kind", "size_bin", "contig_class"]
    return sites.groupBy(*keys).agg(F.count("*").alias("count"))


def hist(df: DataFrame, column: str, width: float, top: float | None = None) -> DataFrame:
    """Histogram in bins of a width: values below 0 together, and those at or above top in its bin."""
    low = F.floor(F.col(column) / width) * width
    low = F.least(low, F.lit(top)) if top is not None else low
    label = F.when(F.col(column) < 0, "<0").otherwise(F.format_string("%.2f", low.cast("double")))
    return df.where(F.col(column).isNotNull()).groupBy(label.alias("bin")).agg(F.count("*").alias("count"))


def cohort_counts(members: DataFrame, columns: list[str]) -> DataFrame:
    """Members per value of each column."""
    marks = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("key")) for c in columns])
    return members.select(F.explode(marks).alias("m")).groupBy("m.metric", "m.key").agg(F.count("*").alias("value"))


def member_counts(gt: DataFrame, by: str = "svtype") -> DataFrame:
    """Per member and type: called, missing, hom_ref, het, hom_alt, depth sum; then call rate and mean depth over types."""
    alt, called = F.coalesce("alt", F.lit(0)), F.col("called")
    return gt.groupBy("sample_id", by).agg(
        F.count_if(called > 0).alias("called"),
        F.count_if(called == 0).alias("missing"),
        F.count_if((called > 0) & (alt == 0)).alias("hom_ref"),
        F.count_if((called > 0) & (alt > 0) & (alt < called)).alias("het"),
        F.count_if((called > 0) & (alt >= called)).alias("hom_alt"),
        _count(F.col("dp")).alias("depth_sum"),
    )


def member_totals(counts: DataFrame) -> DataFrame:
    """Final rows from member_counts: call rate, carried sites and mean depth."""
    s = {c: F.sum(c) for c in ("called", "missing", "hom_ref", "het", "hom_alt", "depth_sum")}
    seen = s["called"] + s["missing"]
    return counts.groupBy("sample_id").agg(
        s["called"].alias("called"),
        s["missing"].alias("missing"),
        F.round(F.try_divide(s["called"], seen), 6).alias("call_rate"),
        (s["het"] + s["hom_alt"]).alias("carried"),
        F.round(F.try_divide(s["depth_sum"], seen), 6).alias("mean_depth"),
    )


def gathered(parts: DataFrame, constant: list[str], flags: list[str]) -> DataFrame:
    """Shard tables (metric, key, value) to one: sums, or the one value of constant metrics, or presence of flags."""
    value = F.when(F.col("metric").isin(*constant), F.max("value")).when(F.col("metric").isin(*flags), F.max(F.least("value", F.lit(1)))).otherwise(F.sum("value"))
    return parts.groupBy("metric", "key").agg(value.cast("long").alias("value"))


def totals_by_sets(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Sums over every combination of the keys, left-out keys shown as ALL."""
    named = df.cube(*keys).agg(*[F.sum(v).cast("long").alias(v) for v in values], *[F.grouping(k).alias(f"__{k}") for k in keys])
    return named.select(*[F.when(F.col(f"__{k}") == 1, "ALL").otherwise(F.col(k).cast("string")).alias(k) for k in keys], *values)


def rolled_up(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Sums over (k1, k2, ...), (k1, ..., ALL), ..., (ALL, ALL)."""
    named = df.rollup(*keys).agg(*[F.sum(v).cast("long").alias(v) for v in values], *[F.grouping(k).alias(f"__{k}") for k in keys])
    return named.select(*[F.when(F.col(f"__{k}") == 1, "ALL").otherwise(F.col(k).cast("string")).alias(k) for k in keys], *values)
