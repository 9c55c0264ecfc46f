"""Queries of windows, sorts, limits and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import identity, ordering as op
from .bindings import Bound, query
from .formulas import normal_quantile_sql
from .saving import kept_calls, saver


@query("win01", """SELECT run_id, subject_id, stage, attempt FROM (SELECT *, row_number() OVER (PARTITION BY subject_id, stage ORDER BY attempt DESC, run_id DESC) AS n
 FROM {runs} WHERE status = 'success') t WHERE n = 1""")
def win01(b: Bound):
    return op.latest(b.runs, ["subject_id", "stage"], "success").select("run_id", "subject_id", "stage", F.col("attempt").cast("long").alias("attempt"))


@query("win01_versions", """SELECT run_id, subject_id, stage FROM (SELECT *, row_number() OVER (PARTITION BY subject_id, stage ORDER BY f DESC NULLS LAST, run_id DESC) AS n
 FROM (SELECT *, CASE WHEN status <> 'running' THEN started_at END AS f FROM {runs}) r) t WHERE n = 1""")
def win01_versions(b: Bound):
    runs = b.runs.withColumn("finished_at", F.when(F.col("status") != "running", F.col("started_at")))
    return op.latest(runs, ["subject_id", "stage"], None, ["finished_at", "run_id"]).select("run_id", "subject_id", "stage")


@query("win02", "SELECT subject_id, stage, CAST(max(attempt) + 1 AS BIGINT) AS next_attempt FROM {runs} GROUP BY 1, 2")
def win02(b: Bound):
    return op.next_attempt(b.runs, ["subject_id", "stage"])


@query("win03", """SELECT sample_id, locus_id, call_id, call_no, al2 FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY al2 DESC, al2 - al1 DESC, locus_id, call_id, call_no) AS n FROM {tr_alleles}) t WHERE n <= 3""")
def win03(b: Bound):
    order = [F.col("al2").desc(), (F.col("al2") - F.col("al1")).desc(), F.col("locus_id"), F.col("call_id"), F.col("call_no")]
    return op.row_first(b.tr_alleles, ["sample_id"], order, 3).select("sample_id", "locus_id", "call_id", "call_no", "al2")


_REL = "SELECT sample_a, sample_b, ibs0, (shared_hets - 2.0 * ibs0) / nullif(least(hets_a, hets_b), 0) AS relatedness FROM {pairs}"
#: Where the coefficients of the test tables lie (random genotypes: all below what relatives have).
HUB_LO, HUB_HI, HUB_MIN = -0.5, 0.1, 12
_HUBS = f"""r AS MATERIALIZED ({_REL}), e AS (SELECT sample_a AS x, sample_b AS y FROM r WHERE relatedness >= {HUB_LO} AND relatedness < {HUB_HI} AND (sample_a + sample_b) % 5 <> 0), a AS MATERIALIZED (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
 peel(hubs, top) AS (SELECT CAST([] AS BIGINT[]), CAST({{'n': {HUB_MIN}, 'm': 0}} AS STRUCT(n BIGINT, m BIGINT)) UNION ALL
 SELECT list_append(hubs, top.m), top FROM (SELECT hubs, (SELECT max({{'n': n, 'm': x}}) FROM (SELECT x, count(*) AS n FROM a WHERE NOT list_contains(hubs, x) AND NOT list_contains(hubs, y) GROUP BY x) d) AS top FROM peel) t WHERE top.n >= {HUB_MIN}),
 hubs AS MATERIALIZED (SELECT top.m AS sample_id, top.n AS degree FROM peel WHERE len(hubs) > 0)"""


@query("win04", f"""WITH RECURSIVE {_HUBS}, s AS (SELECT sample_a AS sample_id, sample_b AS relative, relatedness, ibs0 FROM r UNION ALL SELECT sample_b, sample_a, relatedness, ibs0 FROM r),
 c AS (SELECT * FROM s WHERE sample_id NOT IN (SELECT sample_id FROM hubs) AND relative NOT IN (SELECT sample_id FROM hubs)),
 k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY relatedness DESC, relative) AS n FROM s WHERE relatedness IS NOT NULL) t WHERE n = 1), d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY relatedness DESC, relative) AS n FROM c WHERE relatedness IS NOT NULL) t WHERE n = 1)
 SELECT k.sample_id, k.relative, round(k.relatedness, 6) AS relatedness, d.relative AS clean_relative, round(d.relatedness, 6) AS clean_relatedness, d.ibs0 AS clean_ibs0 FROM k LEFT JOIN d ON d.sample_id = k.sample_id""")
def win04(b: Bound):
    save = saver(b)
    calls, columns = kept_calls(b), ("sample_a", "sample_b", "ibs0", "relatedness")
    near = lambda found: (found.relatedness >= HUB_LO) | identity.best_of_each(found)
    pairs = save(identity.relatedness(calls, near, columns), "pairs")
    expected = F.when((F.col("sample_a") + F.col("sample_b")) % 5 == 0, 0.5)
    hubs = save(identity.related_hubs(pairs.withColumn("expected", expected), HUB_LO, HUB_HI, HUB_MIN, save), "of_all")
    if not hubs.isEmpty():  # the best of all others: counted anew among these, rather than all pairs kept
        pairs = pairs.unionByName(identity.relatedness(calls.join(hubs, "sample_id", "left_anti"), identity.best_of_each, columns))
    return op.closest(pairs, hubs).withColumns({c: F.round(c, 6) for c in ("relatedness", "clean_relatedness")})


@query("win05", """SELECT region_label, site_id, pos, n_rows FROM (SELECT *, row_number() OVER (PARTITION BY region_label ORDER BY svlen DESC, site_id) AS n, count(*) OVER (PARTITION BY region_label) AS n_rows FROM {sites}) t WHERE n = 1""")
def win05(b: Bound):
    return op.lead_rows(b.sites, "region_label", [F.col("svlen").desc(), F.col("site_id")]).select("region_label", "site_id", "pos", "n_rows")


@query("win06", """WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, (CAST(round(l_extendedprice * 100) AS BIGINT) % 9973) / 9973.0 AS p FROM {lineitem}),
 r AS (SELECT *, row_number() OVER (ORDER BY p) AS k, count(*) OVER () AS m FROM v)
 SELECT l_orderkey, l_linenumber, l_partkey, round(least(1.0, min(p * m / k) OVER (ORDER BY p RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS q FROM r""")
def win06(b: Bound):
    p = F.round(F.col("l_extendedprice") * 100).cast("long") % 9973 / F.lit(9973.0)
    return op.bh(b.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", p.alias("p"))).select("l_orderkey", "l_linenumber", "l_partkey", F.round("q", 6).alias("q"))


@query("win07", """SELECT event_id, rank() OVER (PARTITION BY event_type ORDER BY value) + (count(*) OVER (PARTITION BY event_type, value) - 1) / 2.0 AS mean_rank,
 count(*) OVER (PARTITION BY event_type) AS group_size FROM {events}""")
def win07(b: Bound):
    return op.mean_rank(b.events, "event_type", "value").select("event_id", "mean_rank", "group_size")


@query("win07_normal", f"""WITH r AS (SELECT event_id, rank() OVER (PARTITION BY event_type ORDER BY value) + (count(*) OVER (PARTITION BY event_type, value) - 1) / 2.0 AS mean_rank, count(*) OVER (PARTITION BY event_type) AS n FROM {{events}})
 SELECT event_id, mean_rank, round({normal_quantile_sql("p")}, 6) AS z FROM (SELECT *, CAST((mean_rank - 0.5) / n AS DOUBLE) AS p FROM r) t""")
def win07_normal(b: Bound):
    return op.rank_normal(b.events, "event_type", "value").select("event_id", "mean_rank", F.round("z", 6).alias("z"))


@query("win08", """SELECT sample_id, batch, round(running, 4) AS running, round(running / total, 6) AS share FROM (SELECT *, sum(w) OVER (PARTITION BY batch ORDER BY position ROWS UNBOUNDED PRECEDING) AS running,
 sum(w) OVER (PARTITION BY batch) AS total FROM (SELECT *, abs(depth_mean) AS w FROM {members}) m) t""")
def win08(b: Bound):
    m = b.members.withColumn("w", F.abs("depth_mean"))
    return op.cumulative(m, ["batch"], ["position"], "w").select("sample_id", "batch", F.round("running", 4).alias("running"), F.round("share", 6).alias("share"))


@query("win09", """WITH g AS (SELECT chrom, min(sample_id) AS position, site_id FROM {genotypes} JOIN {sites} USING (site_id) WHERE alt > 0 GROUP BY chrom, site_id),
 n AS (SELECT chrom, position, count(*) AS new FROM g GROUP BY 1, 2), c AS (SELECT chrom, position, sum(new) OVER (PARTITION BY chrom ORDER BY position) AS v FROM n),
 k AS (SELECT DISTINCT chrom FROM {sites}), p AS (SELECT sample_id AS position FROM {members})
 SELECT p.position, CAST(sum(coalesce((SELECT max(v) FROM c WHERE c.chrom = k.chrom AND c.position <= p.position), 0)) AS BIGINT) AS total FROM k CROSS JOIN p GROUP BY 1""")
def win09(b: Bound):
    first = b.genotypes.where("alt > 0").join(b.sites.select("site_id", "chrom"), "site_id").groupBy("chrom", "site_id").agg(F.min("sample_id").alias("position"))
    new = first.groupBy("chrom", "position").agg(F.count("*").alias("new"))
    values = op.cumulative(new, ["chrom"], ["position"], "new").select("chrom", "position", F.col("running").alias("v"))
    members = b.members.select(F.col("sample_id").alias("position"))
    return op.carried_forward(values, b.sites.select("chrom").distinct(), members, "chrom", "position", "v")


@query("win10", """WITH r AS (SELECT stage, started_at AS s, started_at + to_days(CAST(1 + run_id % 5 AS INTEGER)) AS e FROM {runs}), x AS (SELECT stage, s AS t, 1 AS d FROM r UNION ALL SELECT stage, e, -1 FROM r),
 c AS (SELECT stage, t, d, sum(d) AS n FROM x GROUP BY 1, 2, 3), k AS (SELECT stage, sum(n) OVER (PARTITION BY stage ORDER BY t, d DESC ROWS UNBOUNDED PRECEDING) AS v FROM c)
 SELECT stage, CAST(max(v) AS BIGINT) AS peak FROM k GROUP BY 1""")
def win10(b: Bound):
    runs = b.runs.withColumn("ended_at", F.expr("started_at + make_dt_interval(cast(1 + run_id % 5 as int))"))
    return op.peak(op.concurrency(runs, "stage", "started_at", "ended_at", saver(b)), "stage")


@query("win11", """SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) AS pixel, arg_min(value, (ts, event_id)) AS first, min(value) AS least, max(value) AS largest, arg_max(value, (ts, event_id)) AS last FROM {events} GROUP BY 1""")
def win11(b: Bound):
    return op.downsample(b.events, F.floor(F.unix_timestamp("ts") / 3600), "ts", "value", "event_id")


@query("win12", """SELECT o_orderpriority AS stage, round(median(o_totalprice), 6) AS median, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM {orders} WHERE o_orderstatus = 'F') t WHERE k <= 20 GROUP BY 1""")
def win12(b: Bound):
    runs = b.orders.where("o_orderstatus = 'F'").withColumnRenamed("o_orderpriority", "stage")
    out = op.recent_median(runs, "stage", [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], "o_totalprice", 20)
    return out.withColumn("median", F.round("median", 6))


@query("win13", """SELECT sample_id, row_number() OVER (ORDER BY depth_mean DESC, sample_id) AS position FROM (SELECT * FROM {members} WHERE sex = 'XX' AND batch % 5 <> 0 ORDER BY depth_mean DESC, sample_id LIMIT 25) t""")
def win13(b: Bound):
    ranked = b.members.withColumn("rank", F.struct(-F.col("depth_mean"), F.col("sample_id")))
    return op.emit_prefix(ranked, (F.col("sex") == "XX") & (F.col("batch") % 5 != 0), 25).select("sample_id", "position")


@query("win14", "SELECT site_id, position FROM {sites} JOIN (SELECT region_label, row_number() OVER (ORDER BY region_label DESC) AS position FROM (SELECT DISTINCT region_label FROM {sites}) d) o USING (region_label)")
def win14(b: Bound):
    from pyspark.sql import Window

    labels = b.sites.select("region_label").distinct()
    order = labels.withColumn("position", F.row_number().over(Window.orderBy(F.col("region_label").desc())).cast("long"))  # the labels' dimension table
    return op.restore_order(b.sites, order, "region_label").select("site_id", "position")


@query("srt01", "SELECT site_id, chrom, pos FROM {sites}")
def srt01(b: Bound):
    return op.genome_sort(b.sites, "chrom", "pos", "site_id").select("site_id", "chrom", "pos")


@query("srt02", "SELECT site_id, CASE WHEN site_id % 5 = 0 THEN '' ELSE gene END AS gene FROM {sites}")
def srt02(b: Bound):
    s = b.sites.withColumn("gene", F.when(F.col("site_id") % 5 == 0, "").otherwise(F.col("gene")))
    return op.sort_events(s, "gene", "chrom", "pos").select("site_id", "gene")


@query("srt03", """WITH f AS (SELECT user_id, CASE event_type WHEN 'error' THEN 'fail' WHEN 'purchase' THEN 'warn' WHEN 'click' THEN 'info' ELSE 'pass' END AS level FROM {events})
 SELECT user_id, CASE max(CASE level WHEN 'fail' THEN 3 WHEN 'warn' THEN 2 WHEN 'info' THEN 1 ELSE 0 END) WHEN 3 THEN 'fail' WHEN 2 THEN 'warn' WHEN 1 THEN 'info' ELSE 'pass' END AS worst FROM f GROUP BY 1""")
def srt03(b: Bound):
    level = F.when(F.col("event_type") == "error", "fail").when(F.col("event_type") == "purchase", "warn").when(F.col("event_type") == "click", "info").otherwise("pass")
    found = b.events.select("user_id", level.alias("level"))
    return op.sort_findings(op.worst(found, "user_id", "level"), "worst", "user_id")


@query("srt04", "SELECT site_id, count(*) AS carriers FROM {genotypes} WHERE alt > 0 GROUP BY 1 ORDER BY carriers DESC, site_id LIMIT 50")
def srt04(b: Bound):
    carriers = b.genotypes.where("alt > 0").groupBy("site_id").agg(F.count("*").alias("carriers"))
    return op.topk(carriers, [F.col("carriers").desc(), F.col("site_id")], 50)


@query("srt05", "SELECT task, round(sum(alloc_cpus * elapsed_s) / 3600, 6) AS core_h FROM {jobs} GROUP BY 1 ORDER BY core_h DESC, task LIMIT 5")
def srt05(b: Bound):
    usage = b.jobs.groupBy("task").agg(F.round(F.sum(F.col("alloc_cpus") * F.col("elapsed_s")) / 3600, 6).alias("core_h"))
    return op.topk(usage, [F.col("core_h").desc(), F.col("task")], 5)


@query("set01", "SELECT site_id, chrom, pos FROM {sites}")
def set01(b: Bound):
    s = b.sites.select("site_id", "chrom", "pos")
    return op.gather([s.where(F.col("site_id") % 4 == i) for i in range(4)])


@query("set02", "SELECT DISTINCT chrom, svtype, region_label FROM {sites}")
def set02(b: Bound):
    return b.sites.select("chrom", "svtype", "region_label").dropDuplicates()


@query("set03", """WITH d AS (SELECT site_id // 2 AS allele, sample_id, called, coalesce(alt, 0) AS alt FROM {genotypes}) SELECT allele, sample_id, max(called) AS called, CAST(least(max(called), sum(alt)) AS INTEGER) AS alt FROM d GROUP BY 1, 2""")
def set03(b: Bound):
    return op.merge_duplicate_alleles(b.genotypes.withColumn("allele", F.floor(F.col("site_id") / 2)), ["allele", "sample_id"])


@query("set04", """WITH a AS (SELECT DISTINCT user_id AS id FROM {events}), c AS (SELECT sample_id AS id FROM {members} WHERE sample_id % 3 <> 0)
 SELECT id, 'a' AS only_in FROM a WHERE id NOT IN (SELECT id FROM c) UNION ALL SELECT id, 'b' FROM c WHERE id NOT IN (SELECT id FROM a)""")
def set04(b: Bound):
    return op.set_diff(b.events.select(F.col("user_id").alias("id")), b.members.where("sample_id % 3 <> 0").select(F.col("sample_id").alias("id")), "id")


@query("set05", "SELECT batch, count(*) AS n, count(*) - count(DISTINCT sample_id) AS repeated, sha256(string_agg(CAST(sample_id AS VARCHAR), chr(10) ORDER BY position)) AS sha256 FROM {members} GROUP BY 1")
def set05(b: Bound):
    return op.freeze(b.members, "batch", "sample_id", "position")


@query("set06", "SELECT TRUE AS is_prefix, CAST(least(10, (SELECT count(*) FROM {members} WHERE sex = 'XX' AND batch % 5 <> 0)) AS BIGINT) AS n")
def set06(b: Bound):
    ranked = b.members.withColumn("rank", F.struct(-F.col("depth_mean"), F.col("sample_id")))
    keep = (F.col("sex") == "XX") & (F.col("batch") % 5 != 0)
    return op.is_prefix(op.emit_prefix(ranked, keep, 10), op.emit_prefix(ranked, keep, 25), "sample_id")
