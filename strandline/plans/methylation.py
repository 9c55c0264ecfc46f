"""Queries of the methylation family."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expressions import contig_class
from ..operators import identity, methylation as op, repeats
from .bindings import Bound, query
from .saving import saver


def _r(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


_BG = "SELECT region_label, label, count(value) AS n, avg(value) AS mean, stddev_samp(value) AS stdev FROM {profiles} GROUP BY 1, 2"


@query("agg25", f"SELECT region_label, label, n, round(mean, 6) AS mean, round(stdev, 6) AS stdev FROM ({_BG}) t")
def agg25(b: Bound):
    return _r(op.background(b.profiles), "mean", "stdev")


@query("agg25_loo", """SELECT a.sample_id, a.region_label, a.label, count(p.value) AS n, round(avg(p.value), 9) AS mean, round(coalesce(stddev_samp(p.value), CASE WHEN count(p.value) > 1 THEN 0 END), 4) AS stdev
 FROM (SELECT * FROM {profiles} WHERE value IS NOT NULL) a LEFT JOIN {profiles} p ON p.region_label = a.region_label AND p.label = a.label AND p.sample_id <> a.sample_id GROUP BY 1, 2, 3""")
def agg25_loo(b: Bound):
    return op.background(b.profiles, True).withColumns({"mean": F.round("mean", 9), "stdev": F.round("stdev", 4)})


_SCORE = f"""SELECT p.*, n, value - mean AS delta, (value - mean) / nullif(stdev, 0) AS z, CASE WHEN n < 5 THEN 'InsufficientData' WHEN abs((value - mean) / nullif(stdev, 0)) >= 1.5 AND abs(value - mean) >= 0.01 THEN
 CASE WHEN value > mean THEN 'HyperMethylated' ELSE 'HypoMethylated' END ELSE 'Uncategorized' END AS category FROM {{profiles}} p JOIN ({_BG}) b USING (region_label, label)"""


def _scored(b: Bound):
    return op.score(b.profiles, op.background(b.profiles), 1.5, 0.01, 5)


@query("sta22", f"SELECT sample_id, region_label, label, round(delta, 6) AS delta, round(z, 6) AS z, category FROM ({_SCORE}) t")
def sta22(b: Bound):
    return _r(_scored(b), "delta", "z").select("sample_id", "region_label", "label", "delta", "z", "category")


@query("sta23", f"""WITH b AS ({_BG}), x AS (SELECT * FROM b WHERE label = 'BUILDING'), y AS (SELECT * FROM b WHERE label = 'FURNITURE'),
 j AS (SELECT coalesce(x.region_label, y.region_label) AS region_label, x.n AS na, y.n AS nb, x.mean - y.mean AS delta, (x.mean - y.mean) / nullif(sqrt(x.stdev * x.stdev / x.n + y.stdev * y.stdev / y.n), 0) AS z FROM x FULL JOIN y USING (region_label))
 SELECT region_label, round(delta, 6) AS delta, round(z, 5) AS z, CASE WHEN na IS NULL OR nb IS NULL OR na < 5 OR nb < 5 THEN 'InsufficientData' WHEN abs(z) >= 1 AND abs(delta) >= 0.0005 THEN CASE WHEN delta > 0 THEN 'Hyper' ELSE 'Hypo' END ELSE 'Uncategorized' END AS comparison,
 CASE WHEN na IS NULL OR nb IS NULL THEN 'missing side' ELSE '' END AS note FROM j""")
def sta23(b: Bound):
    out = op.compare(op.background(b.profiles), "BUILDING", "FURNITURE", 1.0, 0.0005, 5)
    return out.select("region_label", F.round("delta", 6).alias("delta"), F.round("z", 5).alias("z"), "comparison", "note")


_EV = f"SELECT sample_id, region_label, category, CASE WHEN sample_id % 2 = 0 THEN region_label ELSE concat(region_label, ';G', sample_id % 9) END AS genes FROM ({_SCORE}) t WHERE category LIKE 'Hyp%'"


def _events(b: Bound):
    genes = F.when(F.col("sample_id") % 2 == 0, F.col("region_label")).otherwise(F.concat("region_label", F.lit(";G"), (F.col("sample_id") % 9).cast("string")))
    return _scored(b).where("category like 'Hyp%'").select("sample_id", "region_label", "category", genes.alias("genes"))


@query("agg24", f"""WITH e AS ({_EV}), g AS (SELECT sample_id, unnest(string_split(genes, ';')) AS gene FROM e) SELECT 'events_per_region' AS metric, region_label AS key, count(*) AS value FROM e GROUP BY 2
 UNION ALL SELECT 'events_per_type', category, count(*) FROM e GROUP BY 2 UNION ALL SELECT 'events_per_gene', gene, count(*) FROM g GROUP BY 2 UNION ALL SELECT 'members_per_gene', gene, count(DISTINCT sample_id) FROM g GROUP BY 2""")
def agg24(b: Bound):
    return op.event_counts(_events(b))


_CATS = ("HyperMethylated", "HypoMethylated", "Uncategorized", "InsufficientData")
_COUNTS = ", ".join(f"count(CASE WHEN category = '{c}' THEN 1 END) AS n_{c}" for c in _CATS) + ", count(*) AS n_all"


@query("agg26", f"SELECT sample_id, {_COUNTS} FROM ({_SCORE}) t GROUP BY 1")
def agg26(b: Bound):
    return op.pivot_counts(_scored(b), "sample_id", "category", _CATS)


@query("agg27", f"""WITH e AS ({_EV}), c AS (SELECT region_label, count(CASE WHEN category = 'HyperMethylated' THEN 1 END) AS a, count(CASE WHEN category = 'HypoMethylated' THEN 1 END) AS b, count(*) AS n FROM e GROUP BY 1)
 SELECT region_label, label, b.n AS n, round(mean, 6) AS mean, round(stdev, 6) AS stdev, coalesce(a, 0) AS n_HyperMethylated, coalesce(c.b, 0) AS n_HypoMethylated, coalesce(c.n, 0) AS n_all FROM ({_BG}) b LEFT JOIN c USING (region_label) WHERE label = 'BUILDING'""")
def agg27(b: Bound):
    bg = op.background(b.profiles).where("label = 'BUILDING'")
    return _r(op.region_table(bg, _events(b), _CATS[:2]), "mean", "stdev")


@query("agg28", "SELECT island AS region, count(CASE WHEN s = 'normal' THEN 1 END) AS n_normal, count(CASE WHEN s = 'anomalous' THEN 1 END) AS n_anomalous, count(CASE WHEN s = 'low_coverage' THEN 1 END) AS n_low_coverage, count(*) AS n_all FROM (SELECT island, CASE WHEN cov < 8 THEN 'low_coverage' WHEN value > 60 THEN 'anomalous' ELSE 'normal' END AS s FROM {methyl}) t GROUP BY 1")
def agg28(b: Bound):
    report = b.methyl.withColumn("s", F.when(F.col("cov") < 8, "low_coverage").when(F.col("value") > 60, "anomalous").otherwise("normal"))
    return op.pivot_counts(report.withColumnRenamed("island", "region"), "region", "s", ("normal", "anomalous", "low_coverage"))


@query("agg29", "SELECT svtype, CASE WHEN chrom IN ('chrX', 'chrY') THEN chrom ELSE 'autosomal' END AS contig_group, count(*) AS count FROM {sites} GROUP BY 1, 2")
def agg29(b: Bound):
    return op.where_labels_lie(b.sites, contig_class(F.col("chrom")), "svtype")


@query("agg54", f"""WITH a AS (SELECT sample_id, {_COUNTS} FROM ({_SCORE}) t GROUP BY 1), f AS (SELECT user_id AS sample_id, count(CASE WHEN event_type = 'error' THEN 1 END) AS n_anomalous FROM {{events}} GROUP BY 1)
 SELECT sample_id, n_HyperMethylated + n_HypoMethylated AS n_events, n_InsufficientData AS n_insufficient, n_all AS n_regions, coalesce(n_anomalous, 0) AS n_anomalous FROM a LEFT JOIN f USING (sample_id)""")
def agg54(b: Bound):
    counts = op.pivot_counts(_scored(b), "sample_id", "category", _CATS)
    odd = b.events.groupBy(F.col("user_id").alias("sample_id")).agg(F.count_if(F.col("event_type") == "error").alias("n_anomalous"))
    events = (F.col("n_HyperMethylated") + F.col("n_HypoMethylated")).alias("n_events")
    return counts.join(odd, "sample_id", "left").select("sample_id", events, F.col("n_InsufficientData").alias("n_insufficient"), F.col("n_all").alias("n_regions"), F.coalesce("n_anomalous", F.lit(0)).alias("n_anomalous"))


@query("jon04", "SELECT site_id, coalesce(r.r_name, 'intergenic') AS region_type FROM {sites} s LEFT JOIN (SELECT DISTINCT p_brand AS region_label, r_name FROM {part} JOIN {region} ON r_regionkey = CAST(substr(p_brand, 7) AS BIGINT) % 9) r USING (region_label)")
def jon04(b: Bound):
    key = F.substring("p_brand", 7, 9).try_cast("long") % 9
    named = b.part.join(F.broadcast(b.region), F.col("r_regionkey") == key).select(F.col("p_brand").alias("region_label"), F.col("r_name").alias("region_type")).distinct()
    return op.annotate_regions(b.sites, named, "region_label", {"region_type": "intergenic"}).select("site_id", "region_type")


@query("jon16", "SELECT sample_id, label FROM (SELECT sample_id, unnest(CASE WHEN sample_id % 3 = 0 THEN ['ALL', ancestry, sex] ELSE ['ALL', ancestry] END) AS label FROM {members}) t WHERE label <> ''")
def jon16(b: Bound):
    m = b.members.withColumn("labels", F.when(F.col("sample_id") % 3 == 0, F.concat_ws(";", "ancestry", "sex")).otherwise(F.col("ancestry")))
    return identity.explode_labels(m, "labels")


@query("agg40", """WITH q AS (SELECT cell, list(fraction ORDER BY fraction) AS v, count(*) AS n, median(fraction) AS median, max(fraction) AS max, count(CASE WHEN fraction >= 0.05 THEN 1 END) AS n_5pct FROM {fractions} GROUP BY 1)
 SELECT cell, round(median, 6) AS median, round(v[greatest(1, CAST(ceil(0.05 * n) AS BIGINT))], 6) AS p5, round(v[greatest(1, CAST(ceil(0.95 * n) AS BIGINT))], 6) AS p95, round(max, 6) AS max, n_5pct FROM q""")
def agg40(b: Bound):
    return _r(op.composition_stats(b.fractions, repeats.wquantiles), "median", "p5", "p95", "max")


@query("agg40_lineage", "SELECT sample_id, CASE WHEN cell < 3 THEN 'blood' WHEN cell < 6 THEN 'epithelial' ELSE 'other' END AS lineage, round(sum(fraction), 6) AS fraction FROM {fractions} GROUP BY 1, 2")
def agg40_lineage(b: Bound):
    return _r(op.lineage_sums(b.fractions, {0: "blood", 1: "blood", 2: "blood", 3: "epithelial", 4: "epithelial", 5: "epithelial"}), "fraction")


@query("agg53", "SELECT sample_id, arg_max(cell, fraction) AS top_cell, round(max(fraction), 6) AS top_fraction, round(sum(fraction), 6) AS fraction_sum, " + ", ".join(f"round(max(CASE WHEN cell = {i} THEN fraction END), 6) AS cell_{i}" for i in range(64)) + " FROM {fractions} GROUP BY 1")
def agg53(b: Bound):
    out = op.composition_table(b.fractions)
    return _r(out, *[c for c in out.columns if c not in ("sample_id", "top_cell")])


@query("sta21", """WITH m AS (SELECT cell, median(fraction) AS med FROM {fractions} GROUP BY 1), g AS (SELECT sample_id, cell, abs(fraction - med) AS gap FROM {fractions} JOIN m USING (cell)),
 r AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY gap DESC, cell) AS n FROM g), d AS (SELECT sample_id, sum(gap) / 2 AS distance, string_agg(CASE WHEN n <= 3 THEN CAST(cell AS VARCHAR) END, ',' ORDER BY n) AS top_cells FROM r GROUP BY 1),
 x AS (SELECT median(distance) AS med FROM d), y AS (SELECT greatest(0.1, max(x.med) + 2 * 1.4826 * median(abs(distance - x.med))) AS lim FROM d, x) SELECT sample_id, round(distance, 6) AS distance, round(lim, 6) AS "limit", top_cells FROM d, y WHERE distance > lim""")
def sta21(b: Bound):
    return _r(op.composition_outliers(b.fractions, 0.1, 2.0, saver(b)), "distance", "limit")
