"""Queries of members, their tables and stage summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import samples as op
from .bindings import Bound, query


def _r(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("agg55", """WITH f AS (SELECT o_custkey AS sample_id, l_partkey % 50 AS path, min(l_quantity) AS reads, max(l_extendedprice) AS bases, bool_and(l_tax < 0.08) AS exact, count(*) AS listed FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey GROUP BY 1, 2)
 SELECT sample_id, count(*) AS n_files, CAST(sum(reads) AS BIGINT) AS reads, CAST(sum(CAST(floor(bases) AS BIGINT)) AS BIGINT) AS bases, bool_and(exact) AS exact, CAST(sum(listed) - count(*) AS BIGINT) AS dropped, concat_ws(';', CASE WHEN sum(reads) < 300 THEN 'reads below 300' END) AS warnings FROM f GROUP BY 1""")
def agg55(b: Bound):
    rows = b.lineitem.join(b.orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumns({"sample_id": F.col("o_custkey"), "path": F.col("l_partkey") % 50})
    merged = rows.groupBy("sample_id", "path").agg(F.min("l_quantity").alias("reads"), F.floor(F.max("l_extendedprice")).alias("bases"), F.bool_and(F.col("l_tax") < 0.08).alias("exact"), F.count("*").alias("n"))
    listed = merged.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return op.input_totals(listed, {"reads": 300})


@query("agg31", f"""WITH c AS (SELECT sample_id, chrom, avg(dp) AS d FROM {{genotypes}} JOIN {{sites}} USING (site_id) GROUP BY 1, 2), r AS (SELECT sample_id, avg(CASE WHEN regexp_matches(chrom, '^chr[0-9]+$') THEN d END) AS a, avg(CASE WHEN chrom = 'chrX' THEN d END) AS x, avg(CASE WHEN chrom = 'chrY' THEN d END) AS y FROM c GROUP BY 1)
 SELECT sample_id, round(x / a * {op.NUDGE!r}, 6) AS x_ratio, round(y / a * {op.NUDGE!r}, 6) AS y_ratio, CASE WHEN y / a * {op.NUDGE!r} >= 0.9 THEN 'XY' WHEN y / a IS NOT NULL THEN 'XX' ELSE '' END AS sex FROM r""")
def agg31(b: Bound):
    cov = b.genotypes.join(b.sites, "site_id").withColumnRenamed("dp", "depth")
    return _r(op.coverage_ratios(cov, 0.9), "x_ratio", "y_ratio")


_CN = "SELECT p_brand AS region, CASE WHEN l_tax < 0.005 THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS cn FROM {lineitem} JOIN {part} ON l_partkey = p_partkey"


@query("agg36", f"""WITH c AS ({_CN}), k AS (SELECT region, cn, count(*) AS k FROM c WHERE cn IS NOT NULL GROUP BY 1, 2), t AS (SELECT region, string_agg(concat(cn, ':', k), ';' ORDER BY cn) AS counts FROM k GROUP BY 1)
 SELECT region, count(cn) AS called, count(*) - count(cn) AS failed, round(avg(cn), 6) AS mean, round(var_pop(cn), 6) AS variance, min(counts) AS counts FROM c LEFT JOIN t USING (region) GROUP BY 1""")
def agg36(b: Bound):
    rows = b.lineitem.join(b.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_brand").alias("region"), F.when(F.col("l_tax") >= 0.005, F.col("l_linenumber").cast("long")).alias("cn"))
    return _r(op.cn_summary(rows), "mean", "variance")


_HLA = "SELECT o_custkey AS sample_id, o_orderstatus AS gene, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE concat('*', o_orderkey % 9) END AS a1, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE concat('*', o_custkey % 5) END AS a2 FROM {orders}"


@query("agg37", f"""WITH h AS ({_HLA}), l AS (SELECT gene, a1 AS allele FROM h UNION ALL SELECT gene, a2 FROM h), g AS (SELECT gene, count(allele) AS called, count(*) AS n FROM l GROUP BY 1)
 SELECT gene, allele, count(*) AS count, round(count(*) / CAST(max(called) AS DOUBLE), 6) AS fraction, max(called) / 2.0::DOUBLE AS n_called, round(max(called) / CAST(max(n) AS DOUBLE), 6) AS call_rate FROM l JOIN g USING (gene) WHERE allele IS NOT NULL GROUP BY 1, 2""")
def agg37(b: Bound):
    star = lambda c, k: F.when(F.col("o_orderkey") % 7 != 0, F.concat(F.lit("*"), (F.col(c) % k).cast("string")))
    rows = b.orders.select(F.col("o_custkey").alias("sample_id"), F.col("o_orderstatus").alias("gene"), star("o_orderkey", 9).alias("a1"), star("o_custkey", 5).alias("a2"))
    return _r(op.pooled_alleles(rows, "gene", "a1", "a2"), "fraction", "call_rate")


@query("jon26", """WITH r AS (SELECT o_custkey AS sample_id, concat('s', o_custkey, '.hap', o_orderkey % 3) AS id, substr(o_orderpriority, 3, 2) AS haplogroup FROM {orders}), c AS (SELECT DISTINCT * FROM r), a AS (SELECT o_custkey AS sample_id, concat('hap', o_orderkey % 3) AS label, round(sum(o_totalprice), 2) AS abundance FROM {orders} GROUP BY 1, 2)
 SELECT sample_id, label, haplogroup, abundance, row_number() OVER (PARTITION BY sample_id ORDER BY abundance DESC NULLS LAST, label, haplogroup) = 1 AS major FROM (SELECT *, string_split(id, '.')[-1] AS label FROM c) q LEFT JOIN a USING (sample_id, label)""")
def jon26(b: Bound):
    return _haplo(b)


def _haplo(b: Bound):
    hap = (F.col("o_orderkey") % 3).cast("string")
    classified = b.orders.select(F.col("o_custkey").alias("sample_id"), F.concat(F.lit("s"), F.col("o_custkey").cast("string"), F.lit(".hap"), hap).alias("id"), F.substring("o_orderpriority", 3, 2).alias("haplogroup")).distinct()
    ab = b.orders.groupBy(F.col("o_custkey").alias("sample_id"), F.concat(F.lit("hap"), hap).alias("label")).agg(F.round(F.sum("o_totalprice"), 2).alias("abundance"))
    from pyspark.sql import Window

    out = op.major_haplotypes(classified, ab)
    order = Window.partitionBy("sample_id").orderBy(F.col("abundance").desc_nulls_last(), "label", "haplogroup")
    return out.withColumn("major", F.row_number().over(order) == 1).select("sample_id", "label", "haplogroup", "abundance", "major")


@query("agg38", """WITH m AS (SELECT o_custkey AS s, arg_min(substr(o_orderpriority, 3, 2), o_orderkey) AS h FROM {orders} GROUP BY 1), l AS (SELECT 'haplogroup' AS level, h AS value FROM m UNION ALL SELECT 'macro', substr(h, 1, 1) FROM m)
 SELECT level, value, count(*) AS count, round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY level) AS DOUBLE), 6) AS fraction FROM l GROUP BY 1, 2""")
def agg38(b: Bound):
    first = b.orders.groupBy(F.col("o_custkey").alias("sample_id")).agg(F.min_by(F.substring("o_orderpriority", 3, 2), "o_orderkey").alias("haplogroup"))
    return _r(op.haplogroups(first.withColumn("major", F.lit(True))), "fraction")


_MT = "SELECT l_partkey AS site, o_custkey AS sample_id, l_linenumber % 3 AS allele, sum(l_quantity) AS w FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey GROUP BY 1, 2, 3"
_COLLAPSE = f"""SELECT site, sample_id, a1, coalesce(a2, a1) AS a2, w1, w2 FROM (SELECT site, sample_id, max(CASE WHEN n = 1 THEN allele END) AS a1, max(CASE WHEN n = 2 THEN allele END) AS a2, max(CASE WHEN n = 1 THEN w END) AS w1, coalesce(max(CASE WHEN n = 2 THEN w END), 0) AS w2
 FROM (SELECT *, row_number() OVER (PARTITION BY site, sample_id ORDER BY CASE WHEN allele <> 0 THEN 1 ELSE 0 END, w DESC, allele) AS n FROM ({_MT}) t) u GROUP BY 1, 2) v"""
_VAF = "(CASE WHEN a1 <> 0 THEN w1 ELSE 0 END + CASE WHEN a2 <> 0 THEN w2 ELSE 0 END) / (w1 + w2)"


def _collapsed(b: Bound):
    rows = b.lineitem.join(b.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return op.haplotype_collapse(rows.select(F.col("l_partkey").alias("site"), F.col("o_custkey").alias("sample_id"), (F.col("l_linenumber") % 3).alias("allele"), F.col("l_quantity").alias("abundance")))


@query("sta11", f"SELECT site, sample_id, concat(a1, '/', a2) AS gt, round({_VAF}, 6) AS vaf, a1 <> a2 AS het FROM ({_COLLAPSE}) c")
def sta11(b: Bound):
    return _r(_collapsed(b), "vaf")


@query("agg39", f"SELECT sample_id, count(CASE WHEN vaf >= 0.95 THEN 1 END) AS homoplasmic, count(CASE WHEN vaf > 0 AND vaf < 0.95 THEN 1 END) AS heteroplasmic, round(max(vaf), 6) AS max_vaf FROM (SELECT sample_id, {_VAF} AS vaf FROM ({_COLLAPSE}) c) d GROUP BY 1")
def agg39(b: Bound):
    return _r(op.mt_counts(_collapsed(b), 0.95), "max_vaf")


@query("agg52", "SELECT l_suppkey AS sample_id, CASE WHEN l_quantity < 10 THEN '<10' WHEN l_quantity < 30 THEN '10-29' ELSE '>=30' END AS bin, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS total, CAST(max(l_quantity) AS BIGINT) AS longest FROM {lineitem} GROUP BY 1, 2")
def agg52(b: Bound):
    runs = b.lineitem.select(F.col("l_suppkey").alias("sample_id"), F.col("l_quantity").cast("long").alias("length"))
    return op.roh(runs, X.bin_label(F.col("length"), [10, 30], ["<10", "10-29", ">=30"]))


@query("agg47", "SELECT sample_id, " + ", ".join(f"round(avg(CASE WHEN chrom = '{c}' THEN dp END), 6) AS mean_{c}" for c in ("chr1", "chr2", "chrX")) + ", round(avg(dp), 6) AS mean FROM {genotypes} JOIN {sites} USING (site_id) GROUP BY 1")
def agg47(b: Bound):
    return _r(op.per_contig(b.genotypes.join(b.sites, "site_id"), ["chr1", "chr2", "chrX"], "dp"), "mean_chr1", "mean_chr2", "mean_chrX", "mean")


@query("agg56", """SELECT 'cohort' AS stage, 'sites' AS resource, 'by_type' AS metric, svtype AS key, CAST(count(*) AS VARCHAR) AS value FROM {sites} GROUP BY 4 UNION ALL SELECT 'cohort', 'members', 'by_sex', sex, CAST(count(*) AS VARCHAR) FROM {members} GROUP BY 4
 UNION ALL SELECT 'cohort', 'runs', 'by_status', status, CAST(count(*) AS VARCHAR) FROM {runs} GROUP BY 4""")
def agg56(b: Bound):
    per = lambda df, c: df.groupBy(F.col(c).alias("key")).agg(F.count("*").alias("value"))
    return op.stage_summary("cohort", {"sites.by_type": per(b.sites, "svtype"), "members.by_sex": per(b.members, "sex"), "runs.by_status": per(b.runs, "status")})


@query("jon20", "WITH a AS (SELECT o_custkey AS k, min(o_orderpriority) AS v FROM {orders} WHERE o_custkey % 3 = 0 GROUP BY 1), c AS (SELECT user_id AS k, max(event_type) AS v FROM {events} GROUP BY 1) SELECT coalesce(a.k, c.k) AS k, coalesce(a.v, c.v) AS v, CASE WHEN a.v IS NOT NULL THEN 'run' WHEN c.v IS NOT NULL THEN 'cohort' END AS source FROM a FULL JOIN c ON a.k = c.k")
def jon20(b: Bound):
    own = b.orders.where("o_custkey % 3 = 0").groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderpriority").alias("v"))
    other = b.events.groupBy(F.col("user_id").alias("k")).agg(F.max("event_type").alias("v"))
    return op.with_fallback(own, other, "k", "v", ("run", "cohort"))


@query("jon22", """SELECT sample_id, sex, batch, n_sites, n_events, n_runs FROM {members} LEFT JOIN (SELECT sample_id, count(*) AS n_sites FROM {genotypes} WHERE alt > 0 GROUP BY 1) g USING (sample_id) LEFT JOIN (SELECT user_id AS sample_id, count(*) AS n_events FROM {events} GROUP BY 1) e USING (sample_id)
 LEFT JOIN (SELECT subject_id AS sample_id, count(*) AS n_runs FROM {runs} GROUP BY 1) r USING (sample_id)""")
def jon22(b: Bound):
    count = lambda df, key, name: df.groupBy(F.col(key).alias("sample_id")).agg(F.count("*").alias(name))
    return op.member_table(b.members.select("sample_id", "sex", "batch"), [count(b.genotypes.where("alt > 0"), "sample_id", "n_sites"), count(b.events, "user_id", "n_events"), count(b.runs, "subject_id", "n_runs")])


@query("prj19", """SELECT o_custkey AS k, arg_min(o_orderkey, r) AS value, arg_min(o_orderpriority, r) AS stage FROM (SELECT o_custkey, o_orderpriority, max(o_orderkey) AS o_orderkey, CASE o_orderpriority WHEN '2-HIGH' THEN 1 WHEN '1-URGENT' THEN 2 WHEN '5-LOW' THEN 3 END AS r FROM {orders} GROUP BY 1, 2) t WHERE r IS NOT NULL GROUP BY 1""")
def prj19(b: Bound):
    rows = b.orders.groupBy(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("stage")).agg(F.max("o_orderkey").alias("value"))
    return op.preferred(rows, ["k"], ["2-HIGH", "1-URGENT", "5-LOW"])


@query("prj24", """SELECT c AS "check", CAST(c_custkey AS VARCHAR) AS target, CASE WHEN bad THEN 'fail' ELSE 'ok' END AS status, CASE WHEN bad THEN d ELSE '' END AS detail FROM (SELECT c_custkey, 'balance' AS c, c_acctbal < 0 AS bad, 'negative' AS d FROM {customer}
 UNION ALL SELECT c_custkey, 'name', NOT regexp_matches(c_name, '^Customer#[0-9]{{9}}$'), 'pattern' FROM {customer} UNION ALL SELECT c_custkey, 'both_or_neither', (c_nationkey > 20) <> (c_mktsegment = 'BUILDING'), 'one of two' FROM {customer}) t""".replace("{{9}}", "+"))
def prj24(b: Bound):
    rules = [("balance", F.col("c_acctbal") < 0, "negative"), ("name", ~F.col("c_name").rlike("^Customer#[0-9]+$"), "pattern"), ("both_or_neither", (F.col("c_nationkey") > 20) != (F.col("c_mktsegment") == "BUILDING"), "one of two")]
    return op.validate(b.customer, "c_custkey", rules)


@query("prj26", "SELECT site_id, gene FROM {sites} WHERE upper(gene) IN ('PROMO', 'SMALL') ORDER BY pos, site_id LIMIT 100")
def prj26(b: Bound):
    return op.filter_genes(b.sites, "gene", ["promo", "Small"], 100, [F.col("pos"), F.col("site_id")]).select("site_id", "gene")


@query("prj27", "SELECT l_orderkey, l_linenumber FROM {lineitem} WHERE l_returnflag = 'R' OR l_linestatus = 'O'")
def prj27(b: Bound):
    rows = b.lineitem.withColumns({"class": F.col("l_returnflag"), "notes": F.concat_ws(";", F.lit("x"), "l_linestatus")})
    return op.findings(rows, ["R"], ["O"]).select("l_orderkey", "l_linenumber")


@query("prj28", "WITH s AS (SELECT DISTINCT p_brand AS name, regexp_replace(substr(p_brand, 1, 7), '[^A-Za-z0-9_]', '_', 'g') AS safe FROM {part}) SELECT name, safe, count(*) OVER (PARTITION BY safe) > 1 AS collides, safe = 'Brand_1' AS reserved FROM (SELECT substr(name, 1, 7) AS name, safe FROM s GROUP BY 1, 2) t")
def prj28(b: Bound):
    return op.safe_names(b.part.select(F.substring("p_brand", 1, 7).alias("name")), "name", ["Brand_1"])


@query("prj30", "SELECT id FROM (SELECT trim(unnest(string_split(substr(concat('missing: ', user_id, ', ', event_id % 7, ','), 9), ','))) AS id FROM {events} WHERE event_type = 'error') t WHERE id <> ''")
def prj30(b: Bound):
    text = F.concat(F.when(F.col("event_type") == "error", "missing:").otherwise("note:"), F.lit(" "), F.col("user_id").cast("string"), F.lit(", "), (F.col("event_id") % 7).cast("string"), F.lit(","))
    return op.ids_from_messages(b.events.select(text.alias("m")), "m", "missing:")


@query("prj31", "SELECT user_id, round(max(CASE WHEN event_type = 'view' THEN value END), 6) AS view, round(max(CASE WHEN event_type = 'click' THEN value END), 6) AS click, string_agg(DISTINCT CASE WHEN event_type = 'error' THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END, ',' ORDER BY CASE WHEN event_type = 'error' THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END) AS error FROM {events} GROUP BY 1")
def prj31(b: Bound):
    rows = b.events.select("user_id", F.col("event_type").alias("metric"), F.when(F.col("event_type") == "error", F.floor("value").cast("string")).otherwise(F.col("value").cast("string")).alias("value"))
    return _r(op.eav_wide(rows, "user_id", ["view", "click"], ["error"]), "view", "click")


@query("sta24")
def sta24(b: Bound):
    return op.ancestry(b.embeddings)
