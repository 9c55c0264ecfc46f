"""Queries of the frequency family."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import frequency as op
from .bindings import Bound, query


def _strata_sql(called: str, extra: bool) -> str:
    out = []
    for s in op.STRATA:
        inside, tail = (f"sex = '{s}'", f"_{s}") if s else ("TRUE", "")
        n = f"(SELECT count(*) FROM members WHERE {inside})"
        absent = f"{n} - count(CASE WHEN {inside} THEN 1 END)" if extra else "0"
        ac, an = f"coalesce(sum(CASE WHEN {inside} THEN coalesce(alt, 0) END), 0)", f"(coalesce(sum(CASE WHEN {inside} THEN {called} END), 0) + 2 * ({absent}))"
        out += [
            f"CAST({ac} AS BIGINT) AS AC{tail}",
            f"CAST({an} AS BIGINT) AS AN{tail}",
            f"round(CAST({ac} AS DOUBLE) / nullif({an}, 0), 6) AS AF{tail}",
            f"count(CASE WHEN {inside} AND {called} > 0 THEN 1 END) + ({absent}) AS NS{tail}",
            f"2 * count(CASE WHEN {inside} AND {called} = 2 AND alt = 2 THEN 1 END) AS AC_Hom{tail}",
            f"count(CASE WHEN {inside} AND {called} = 2 AND alt = 1 THEN 1 END) AS AC_Het{tail}",
            f"CAST(coalesce(sum(CASE WHEN {inside} AND {called} = 1 THEN coalesce(alt, 0) END), 0) AS BIGINT) AS AC_Hemi{tail}",
        ]
    return ", ".join(out)


_FREQ = f"SELECT site_id, {_strata_sql('called', False)} FROM {{genotypes}} g JOIN {{members}} m USING (sample_id) GROUP BY site_id"
_FREQ_REF = f"SELECT site_id, {_strata_sql('(CASE WHEN called = 0 THEN 2 ELSE called END)', True)} FROM {{genotypes}} g JOIN {{members}} m USING (sample_id) GROUP BY site_id"
_CLASS = """CASE WHEN regexp_matches(chrom, '^(chr)?([1-9]|1[0-9]|2[0-2])$') THEN 'autosome' WHEN chrom IN ('chrX','X') THEN 'chrX'
 WHEN chrom IN ('chrY','Y') THEN 'chrY' WHEN chrom IN ('chrM','M','chrMT','MT') THEN 'chrM' ELSE 'other' END"""
_SIZE = "CASE WHEN svlen < 50 THEN '<50' WHEN svlen < 100 THEN '50-99' WHEN svlen < 500 THEN '100-499' WHEN svlen < 1000 THEN '500-999' WHEN svlen < 10000 THEN '1k-9.9k' ELSE '>=10k' END"
_AF = "CASE WHEN AF < 0.001 THEN '<0.1%' WHEN AF < 0.01 THEN '0.1-1%' WHEN AF < 0.05 THEN '1-5%' WHEN AF < 0.5 THEN '5-50%' ELSE '>=50%' END"


@query("agg01", _FREQ)
def agg01(b: Bound):
    return op.allele_freq(b.genotypes, b.members)


@query("prj10", _FREQ_REF)
def prj10(b: Bound):
    return op.allele_freq(b.genotypes, b.members, missing_is_ref=True)


@query("agg02", "SELECT site_id, count(DISTINCT sample_id) AS SUPP, round(count(DISTINCT sample_id) / CAST((SELECT count(*) FROM members) AS DOUBLE), 6) AS CF FROM {genotypes}, (SELECT 1 FROM {members} LIMIT 1) WHERE alt > 0 GROUP BY site_id")
def agg02(b: Bound):
    return op.carrier_freq(b.genotypes, b.members.count())


def _sites_with_freq(b: Bound):
    return b.sites.join(op.allele_freq(b.genotypes, b.members), "site_id")


@query("agg03", f"""WITH f AS ({_FREQ}), s AS (SELECT * FROM {{sites}} JOIN f USING (site_id)), n AS (SELECT count(*) AS n FROM {{members}})
 SELECT 'by_type' AS metric, svtype AS key, count(*) AS value FROM s GROUP BY 2
 UNION ALL SELECT 'by_class', {_CLASS}, count(*) FROM s GROUP BY 2
 UNION ALL SELECT 'by_filter', filter, count(*) FROM s GROUP BY 2
 UNION ALL SELECT 'by_af', {_AF}, count(*) FROM s WHERE AC > 0 GROUP BY 2
 UNION ALL SELECT 'carried', 'all', count(*) FROM s WHERE AC > 0 HAVING count(*) > 0
 UNION ALL SELECT 'carried', 'XX', count(*) FROM s WHERE AC_XX > 0 HAVING count(*) > 0
 UNION ALL SELECT 'carried', 'XY', count(*) FROM s WHERE AC_XY > 0 HAVING count(*) > 0
 UNION ALL SELECT 'singletons', 'all', count(*) FROM s WHERE AC = 1 HAVING count(*) > 0
 UNION ALL SELECT 'low_call_rate', 'all', count(*) FROM s, n WHERE NS < 0.9 * n.n HAVING count(*) > 0""")
def agg03(b: Bound):
    return op.freq_summary(_sites_with_freq(b), b.members.count())


@query("agg04", f"""WITH s AS (SELECT site_id, chrom, filter, svlen, site_id % 3 AS level, unnest(CASE WHEN site_id % 2 = 0 THEN [svtype] ELSE [svtype, 'CPX'] END) AS t FROM {{sites}})
 SELECT 'by_type' AS metric, t AS key, count(*) AS value FROM s GROUP BY 2
 UNION ALL SELECT 'by_level', CAST(level AS VARCHAR), count(DISTINCT site_id) FROM s GROUP BY 2
 UNION ALL SELECT 'by_class', {_CLASS}, count(DISTINCT site_id) FROM s GROUP BY 2
 UNION ALL SELECT 'by_length', {_SIZE}, count(DISTINCT site_id) FROM s GROUP BY 2""")
def agg04(b: Bound):
    types = F.when(F.col("site_id") % 2 == 0, F.array("svtype")).otherwise(F.array("svtype", F.lit("CPX")))
    s = b.sites.withColumn("level", (F.col("site_id") % 3).cast("string"))
    return op.united(
        [
            op.eav(s.withColumn("t", F.explode(types)), "by_type", F.col("t")),
            op.eav(s, "by_level", F.col("level")),
            op.eav(s, "by_class", X.contig_class(F.col("chrom"))),
            op.eav(s, "by_length", X.binned(F.col("svlen"), "sv_size")),
        ]
    )


@query("agg05", """WITH r AS (SELECT o_custkey AS sample_id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS value, m.sex, m.ancestry
   FROM {orders} JOIN {members} m ON m.sample_id = o_custkey),
 l AS (SELECT *, 'all' AS kind, 'all' AS stratum FROM r UNION ALL SELECT *, 'sex', sex FROM r UNION ALL SELECT *, 'ancestry', ancestry FROM r),
 n AS (SELECT kind, stratum, count(DISTINCT sample_id) AS n_members FROM l GROUP BY 1, 2),
 c AS (SELECT kind, stratum, value, count(*) AS count FROM l WHERE value IS NOT NULL GROUP BY 1, 2, 3)
 SELECT kind, stratum, value, count, round(count / CAST(sum(count) OVER (PARTITION BY kind, stratum) AS DOUBLE), 4) AS fraction,
  CAST(sum(count) OVER (PARTITION BY kind, stratum) AS BIGINT) AS n_called, n_members FROM c JOIN n USING (kind, stratum)""")
def agg05(b: Bound):
    rows = b.orders.join(b.members, F.col("o_custkey") == F.col("sample_id")).withColumn("value", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")))
    return op.freq_table(rows, "value", {"sex": "sex", "ancestry": "ancestry"}, [])


@query("agg06", """SELECT site_id, CAST(sum(coalesce(alt, 0)) AS BIGINT) AS AC, CAST(sum(called) AS BIGINT) AS AN, round(CAST(sum(coalesce(alt, 0)) AS DOUBLE) / nullif(sum(called), 0), 6) AS AF,
 count(CASE WHEN called > 0 THEN 1 END) AS NS FROM {genotypes} JOIN {sites} USING (site_id) WHERE svlen <= 1000 GROUP BY site_id""")
def agg06(b: Bound):
    kept = b.genotypes.join(b.sites.where("svlen <= 1000").select("site_id"), "site_id")
    return op.allele_freq(kept, b.members).select("site_id", "AC", "AN", "AF", "NS")


_MEMBER = """SELECT sample_id, svtype, count(CASE WHEN called > 0 THEN 1 END) AS called, count(CASE WHEN called = 0 THEN 1 END) AS missing,
 count(CASE WHEN called > 0 AND coalesce(alt, 0) = 0 THEN 1 END) AS hom_ref, count(CASE WHEN called > 0 AND alt > 0 AND alt < called THEN 1 END) AS het,
 count(CASE WHEN called > 0 AND alt >= called THEN 1 END) AS hom_alt, CAST(sum(dp) AS BIGINT) AS depth_sum
 FROM {genotypes} JOIN {sites} USING (site_id) GROUP BY sample_id, svtype"""


@query("agg07", _MEMBER)
def agg07(b: Bound):
    return op.member_counts(b.genotypes.join(b.sites.select("site_id", "svtype"), "site_id"))


@query("agg07_totals", f"""WITH c AS ({_MEMBER}) SELECT sample_id, CAST(sum(called) AS BIGINT) AS called, CAST(sum(missing) AS BIGINT) AS missing,
 round(sum(called) / CAST(sum(called) + sum(missing) AS DOUBLE), 6) AS call_rate, CAST(sum(het) + sum(hom_alt) AS BIGINT) AS carried,
 round(sum(depth_sum) / CAST(sum(called) + sum(missing) AS DOUBLE), 6) AS mean_depth FROM c GROUP BY sample_id""")
def agg07_totals(b: Bound):
    return op.member_totals(op.member_counts(b.genotypes.join(b.sites.select("site_id", "svtype"), "site_id")))


_SETS = "SELECT m.batch AS batch, s.svtype AS svtype, CASE WHEN svlen < 500 THEN 'small' ELSE 'large' END AS size, CAST(g.called AS BIGINT) AS called, CAST(coalesce(g.alt, 0) AS BIGINT) AS alt FROM {genotypes} g JOIN {sites} s USING (site_id) JOIN {members} m USING (sample_id)"


def _sets(b: Bound):
    g = b.genotypes.join(b.sites, "site_id").join(b.members, "sample_id")
    return g.select("batch", "svtype", F.when(F.col("svlen") < 500, "small").otherwise("large").alias("size"), F.col("called").cast("long"), F.coalesce("alt", F.lit(0)).cast("long").alias("alt"))


def _sets_sql(sets: str) -> str:
    names = ", ".join(f"CASE WHEN grouping({k}) = 1 THEN 'ALL' ELSE CAST({k} AS VARCHAR) END AS {k}" for k in ("batch", "svtype", "size"))
    return f"WITH t AS ({_SETS}) SELECT {names}, CAST(sum(called) AS BIGINT) AS called, CAST(sum(alt) AS BIGINT) AS alt FROM t GROUP BY {sets}"


@query("agg08", _sets_sql("CUBE (batch, svtype, size)"))
def agg08(b: Bound):
    return op.totals_by_sets(_sets(b), ["batch", "svtype", "size"], ["called", "alt"])


@query("agg09", _sets_sql("ROLLUP (batch, svtype, size)"))
def agg09(b: Bound):
    return op.rolled_up(_sets(b), ["batch", "svtype", "size"], ["called", "alt"])


@query("agg10", """WITH p AS (SELECT site_id % 8 AS shard, 'records' AS metric, svtype AS key, count(*) AS value FROM {sites} GROUP BY 1, 3
 UNION ALL SELECT DISTINCT site_id % 8, 'members', 'all', (SELECT count(*) FROM {members}) FROM {sites}
 UNION ALL SELECT site_id % 8, 'low_quality', 'all', count(*) FROM {sites} WHERE filter = 'LowQual' GROUP BY 1)
 SELECT metric, key, CAST(CASE WHEN metric = 'members' THEN max(value) WHEN metric = 'low_quality' THEN max(least(value, 1)) ELSE sum(value) END AS BIGINT) AS value FROM p GROUP BY metric, key""")
def agg10(b: Bound):
    shard = (F.col("site_id") % 8).alias("shard")
    per = lambda rows, metric, key: rows.groupBy(shard, key.alias("key")).agg(F.count("*").alias("value")).select(F.lit(metric).alias("metric"), "key", "value")
    n = b.members.count()
    constant = b.sites.select(shard).distinct().select(F.lit("members").alias("metric"), F.lit("all").alias("key"), F.lit(n).cast("long").alias("value"))
    parts = op.united([per(b.sites, "records", F.col("svtype")), constant, per(b.sites.where("filter = 'LowQual'"), "low_quality", F.lit("all"))])
    return op.gathered(parts, ["members"], ["low_quality"])


@query("agg21", f"""WITH s AS (SELECT s.*, SUPP FROM {{sites}} s JOIN (SELECT site_id, count(DISTINCT sample_id) AS SUPP FROM {{genotypes}} WHERE alt > 0 GROUP BY 1) USING (site_id))
 SELECT 'type' AS metric, svtype AS key, count(*) AS value FROM s GROUP BY 2 UNION ALL SELECT 'size', {_SIZE}, count(*) FROM s GROUP BY 2
 UNION ALL SELECT 'filter', filter, count(*) FROM s GROUP BY 2 UNION ALL SELECT 'support', CAST(SUPP AS VARCHAR), count(*) FROM s GROUP BY 2""")
def agg21(b: Bound):
    return op.sv_summary(b.sites.join(op.carrier_freq(b.genotypes, 1), "site_id"))


@query("agg22", """WITH n AS (SELECT count(*) AS n FROM {members}), c AS (SELECT site_id, count(DISTINCT sample_id) AS s FROM {genotypes} WHERE alt > 0 GROUP BY 1),
 e AS (SELECT DISTINCT e FROM (SELECT unnest([1, 2, 5, 10, CAST(floor(n * 0.01) AS BIGINT), CAST(floor(n * 0.05) AS BIGINT), CAST(floor(n * 0.1) AS BIGINT), CAST(floor(n * 0.5) AS BIGINT), n - 1]) AS e, n FROM n) WHERE e >= 1 AND e < n),
 k AS (SELECT e, e >= coalesce(max(e) OVER (ORDER BY e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ok FROM e),
 b AS (SELECT e AS hi, coalesce(lag(e) OVER (ORDER BY e), 0) + 1 AS lo FROM k)
 SELECT coalesce((SELECT CASE WHEN lo = hi THEN CAST(lo AS VARCHAR) ELSE concat(lo, '-', hi) END FROM b WHERE c.s BETWEEN lo AND hi), concat('all ', (SELECT n FROM n))) AS bin, count(*) AS records FROM c GROUP BY 1""")
def agg22(b: Bound):
    n = b.members.count()
    return op.supp_bins(op.carrier_freq(b.genotypes, n), n)


@query("agg23", f"""SELECT CASE WHEN site_id % 3 = 0 THEN 'a' ELSE 'b' END AS caller, CASE WHEN filter = 'PASS' THEN 'PASS' ELSE 'OTHER' END AS filter_class,
 CASE WHEN svtype = 'DUP' THEN 'INS' ELSE svtype END AS kind, {_SIZE} AS size_bin, {_CLASS} AS contig_class, count(*) AS count FROM {{sites}} GROUP BY 1, 2, 3, 4, 5""")
def agg23(b: Bound):
    alts = F.array(F.concat(F.lit("<"), F.col("svtype"), F.lit(">")))
    largest = X.call_kind(F.lit("A"), alts, F.array("svtype"), F.array("svlen"))
    rows = b.sites.select(
        F.when(F.col("site_id") % 3 == 0, "a").otherwise("b").alias("caller"),
        X.filter_class(F.array("filter")).alias("filter_class"),
        largest["kind"].alias("kind"),
        X.binned(largest["size"], "sv_size").alias("size_bin"),
        X.contig_class(F.col("chrom")).alias("contig_class"),
    )
    return op.call_spectra(rows)


@query("agg30", "SELECT CASE WHEN value < 0 THEN '<0' ELSE printf('%.2f', least(floor(value / 10) * 10, 90.0)) END AS bin, count(*) AS count FROM {events} WHERE value IS NOT NULL GROUP BY 1")
def agg30(b: Bound):
    return op.hist(b.events, "value", 10.0, 90.0)


@query("agg48", "SELECT 'sex' AS metric, sex AS key, count(*) AS value FROM {members} GROUP BY 2 UNION ALL SELECT 'ancestry', ancestry, count(*) FROM {members} GROUP BY 2 UNION ALL SELECT 'batch', CAST(batch AS VARCHAR), count(*) FROM {members} GROUP BY 2")
def agg48(b: Bound):
    return op.cohort_counts(b.members, ["sex", "ancestry", "batch"])
