"""Queries of interval joins and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ranges as op
from .bindings import Bound, query
from .saving import saver


def _a(b: Bound):
    return b.regions.select("region_id", "chrom", F.col("start_pos").alias("a_start"), F.col("end_pos").alias("a_end"))


def _b(b: Bound):
    """A second, shifted set of regions."""
    return b.regions.where("region_id % 3 = 0").select(F.col("region_id").alias("other_id"), "chrom", (F.col("start_pos") + 700).alias("b_start"), (F.col("end_pos") + 1900).alias("b_end"))


_A = "(SELECT region_id, chrom, start_pos AS a_start, end_pos AS a_end FROM {regions})"
_B = "(SELECT region_id AS other_id, chrom, start_pos + 700 AS b_start, end_pos + 1900 AS b_end FROM {regions} WHERE region_id % 3 = 0)"


@query("jon05", f"SELECT region_id, other_id, CAST(least(a_end, b_end) - greatest(a_start, b_start) AS BIGINT) AS overlap_bp FROM {_A} a JOIN {_B} b ON a.chrom = b.chrom AND a_start < b_end AND b_start < a_end")
def jon05(b: Bound):
    return op.overlap_join(_a(b), _b(b)).select("region_id", "other_id", "overlap_bp")


@query("jon06", f"SELECT site_id, EXISTS (SELECT 1 FROM {_B} b WHERE b.chrom = s.chrom AND s.pos >= b_start AND s.pos < b_end) AS inside FROM {{sites}} s")
def jon06(b: Bound):
    return op.in_regions(b.sites, _b(b), "inside", "site_id").select("site_id", "inside")


@query("jon07", f"SELECT region_id, CASE WHEN EXISTS (SELECT 1 FROM {_B} b WHERE b.chrom = a.chrom AND a_start < b_end AND b_start < a_end) THEN CASE WHEN region_id % 4 = 0 THEN 'LowQual' ELSE 'PASS' END ELSE CASE WHEN region_id % 4 = 0 THEN 'LowQual;OUTSIDE' ELSE 'OUTSIDE' END END AS filters FROM {_A} a")
def jon07(b: Bound):
    records = _a(b).withColumn("filters", F.array(F.when(F.col("region_id") % 4 == 0, "LowQual").otherwise("PASS")))
    return op.soft_filter(records, _b(b), "OUTSIDE", "region_id").select("region_id", F.array_join("filters", ";").alias("filters"))


_GENES = "(SELECT region_label AS gene, chrom, start_pos + 150 AS b_start, end_pos + 150 AS b_end, CASE WHEN region_id % 2 = 0 THEN start_pos + 150 ELSE end_pos + 149 END AS tss FROM {regions})"
_NEAR = f"""SELECT region_id, gene, CASE WHEN tss < a_start THEN a_start - tss WHEN tss >= a_end THEN tss - a_end + 1 ELSE 0 END AS distance, b_start < a_end AND b_end > a_start AS in_body
 FROM {_A} a JOIN {_GENES} g ON a.chrom = g.chrom"""


@query("jon08", f"""WITH n AS (SELECT * FROM ({_NEAR}) t WHERE distance <= 5000 OR in_body), o AS (SELECT region_id, gene, min(distance) AS d FROM n GROUP BY 1, 2),
 k AS (SELECT region_id, CASE WHEN max(CASE WHEN gene = 'Brand#7' THEN 1 ELSE 0 END) = 1 THEN 'imprinted' WHEN min(distance) <= 200 THEN 'promoter' WHEN bool_or(in_body) THEN 'gene_body' ELSE 'intergenic' END AS region_type FROM n GROUP BY 1)
 SELECT region_id, string_agg(gene, ';' ORDER BY d, gene) AS genes, min(region_type) AS region_type FROM o JOIN k USING (region_id) GROUP BY 1""")
def jon08(b: Bound):
    tss = F.when(F.col("region_id") % 2 == 0, F.col("start_pos") + 150).otherwise(F.col("end_pos") + 149)
    genes = b.regions.select(F.col("region_label").alias("gene"), "chrom", (F.col("start_pos") + 150).alias("b_start"), (F.col("end_pos") + 150).alias("b_end"), tss.alias("tss"))
    return op.region_genes(op.near_join(_a(b), genes, 5000), "region_id", 200, F.col("gene") == "Brand#7")


@query("jon09", f"""SELECT region_id, site_id, CAST(CASE WHEN pos < a_start THEN pos - a_start WHEN pos >= a_end THEN pos - a_end + 1 ELSE 0 END AS BIGINT) AS distance
 FROM {_A} a JOIN {{sites}} s ON s.chrom = a.chrom AND s.pos >= a_start - 20000 AND s.pos < a_end + 20000""")
def jon09(b: Bound):
    return op.cis_pairs(_a(b), b.sites, 20000).select("region_id", "site_id", "distance")


FAR = f"""WITH v AS (SELECT chrom, site_id, pos, row_number() OVER (PARTITION BY chrom ORDER BY pos, site_id) - 1 AS no FROM {{sites}}),
 i AS (SELECT region_id, a.chrom, count(*) AS n, count(CASE WHEN pos <= a_start - 100000 THEN 1 END) AS below, count(CASE WHEN pos < a_end + 99999 THEN 1 END) AS until FROM {_A} a JOIN {{sites}} s USING (chrom) GROUP BY 1, 2),
 d AS (SELECT *, below + n - until AS far, unnest([0, 1, 2]) AS j FROM i), e AS (SELECT *, far * j // 3 AS f, far * (j + 1) // 3 - far * j // 3 AS size, ('0x' || substr(md5('17-' || region_id || '-' || j), 1, 8))::BIGINT AS h FROM d),
 g AS (SELECT region_id, chrom, CASE WHEN f + h % size < below THEN f + h % size ELSE f + h % size - below + until END AS no FROM e WHERE size > 0) SELECT region_id, site_id FROM g JOIN v USING (chrom, no)"""


def far_of(b: Bound):
    return op.far_pairs(_a(b), b.sites.select("site_id", "chrom", "pos"), 100_000, 3, 17, "region_id", "site_id", saver(b)).select("region_id", "site_id")


@query("jon10", FAR)
def jon10(b: Bound):
    return far_of(b)


_MERGED = """SELECT chrom, min(s) AS s, max(e) AS e, count(*) AS n FROM (SELECT chrom, s, e, sum(CASE WHEN r IS NULL OR s > r THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k
 FROM (SELECT chrom, s, e, max(e) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM (%s) x) y) z GROUP BY chrom, k"""
_MA = _MERGED % f"SELECT chrom, a_start AS s, a_end AS e FROM {_A} q"
_MB = _MERGED % f"SELECT chrom, b_start AS s, b_end AS e FROM {_B} q WHERE other_id % 2 = 0"


def _sets(b: Bound):
    x = _a(b).select("chrom", F.col("a_start").alias("start"), F.col("a_end").alias("end"))
    return x, _b(b).where("other_id % 2 = 0").select("chrom", F.col("b_start").alias("start"), F.col("b_end").alias("end"))


@query("jon11", f"SELECT chrom, s AS start, e AS \"end\", n FROM ({_MA}) t")
def jon11(b: Bound):
    return op.merge_intervals(_sets(b)[0], save=saver(b))


@query("jon12", f"WITH a AS ({_MA}), c AS ({_MB}) SELECT a.chrom, greatest(a.s, c.s) AS start, least(a.e, c.e) AS \"end\" FROM a JOIN c ON a.chrom = c.chrom AND a.s < c.e AND c.s < a.e")
def jon12(b: Bound):
    return op.intersect_intervals(*_sets(b), save=saver(b))


@query("jon12_subtract", f"""WITH a AS ({_MA}), c AS ({_MB}), h AS (SELECT a.chrom, a.s, a.e, c.s AS cs, c.e AS ce FROM a LEFT JOIN c ON a.chrom = c.chrom AND a.s < c.e AND c.s < a.e),
 p AS (SELECT chrom, coalesce(lag(ce) OVER (PARTITION BY chrom, s ORDER BY cs), s) AS x, coalesce(cs, e) AS y FROM h UNION ALL SELECT chrom, max(ce), max(e) FROM h WHERE ce IS NOT NULL GROUP BY chrom, s)
 SELECT chrom, x AS start, y AS "end" FROM p WHERE x < y""")
def jon12_subtract(b: Bound):
    return op.subtract_intervals(*_sets(b), save=saver(b))


@query("jon21", f"""WITH o AS (SELECT region_id, other_id, least(a_end, b_end) - greatest(a_start, b_start) AS bp FROM {_A} a JOIN {_B} b ON a.chrom = b.chrom AND a_start < b_end AND b_start < a_end)
 SELECT region_id, other_id AS twin FROM (SELECT *, row_number() OVER (PARTITION BY region_id ORDER BY bp DESC, other_id) AS n FROM o) t WHERE n = 1""")
def jon21(b: Bound):
    return op.twin_of(op.overlap_join(_a(b), _b(b)), "region_id", "other_id")


_LEN = "(SELECT chrom, max(pos) + 1000 AS length FROM {sites} GROUP BY 1)"


def _lengths(b: Bound):
    return b.sites.groupBy("chrom").agg((F.max("pos") + 1000).alias("length"))


@query("agg17", f"""WITH g AS (SELECT chrom, unnest(range(0, (length - 1) // 50000 + 1)) AS bin FROM {_LEN} l), m AS (SELECT chrom, pos // 50000 AS bin, avg(svlen) AS mean FROM {{sites}} WHERE svtype <> 'INV' GROUP BY 1, 2)
 SELECT chrom, bin, round(mean, 6) AS mean FROM g LEFT JOIN m USING (chrom, bin)""")
def agg17(b: Bound):
    values = b.sites.where("svtype <> 'INV'").withColumn("value", F.col("svlen"))
    return op.bin_mean(values, _lengths(b), 50000).withColumn("mean", F.round("mean", 6))


@query("agg18", f"""WITH l AS (SELECT * FROM {_LEN} l), m AS ({_MA}), g AS (SELECT chrom, length, unnest(range(0, (length - 1) // 50000 + 1)) AS bin FROM l),
 c AS (SELECT chrom, bin, sum(least(e, (bin + 1) * 50000) - greatest(s, bin * 50000)) AS bp FROM (SELECT chrom, s, e, unnest(range(s // 50000, (e - 1) // 50000 + 1)) AS bin FROM m) x GROUP BY 1, 2)
 SELECT chrom, bin, CAST(coalesce(bp, 0) AS BIGINT) AS bp, round(coalesce(bp, 0) / CAST(least(50000, length - bin * 50000) AS DOUBLE), 6) AS fraction FROM g LEFT JOIN c USING (chrom, bin)""")
def agg18(b: Bound):
    return op.bin_coverage(_sets(b)[0], _lengths(b), 50000, saver(b)).withColumn("fraction", F.round("fraction", 6))


@query("prj29", f"""WITH l AS (SELECT * FROM {_LEN} l) SELECT concat(chrom, '_', lpad(CAST(k + 1 AS VARCHAR), 3, '0')) AS shard, chrom, k * 200000 AS start, least((k + 1) * 200000, length) AS "end"
 FROM (SELECT *, unnest(range(0, (length - 1) // 200000 + 1)) AS k FROM l WHERE chrom NOT LIKE 'chrUn%' AND chrom <> 'chrM') t UNION ALL SELECT 'rest', chrom, 0, length FROM l WHERE chrom LIKE 'chrUn%' OR chrom = 'chrM'""")
def prj29(b: Bound):
    return op.tiles(_lengths(b), 200_000, ~(F.col("chrom").startswith("chrUn") | (F.col("chrom") == "chrM")))
