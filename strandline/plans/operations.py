"""Queries of runs, jobs and tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import operations as op, ordering
from .bindings import Bound, query

_STAGES = ("1-URGENT", "2-HIGH", "3-MEDIUM")


def _r(df, *columns, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("agg45", """WITH a AS (SELECT CASE WHEN l_linenumber = 1 THEN CAST(l_orderkey AS VARCHAR) ELSE concat(l_orderkey, '.', l_linenumber) END AS job_id, CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'COMPLETED' END AS state, round(l_extendedprice, 0) AS e, l_quantity AS c, l_partkey, l_suppkey FROM {lineitem})
 SELECT string_split(job_id, '.')[1] AS job, arg_max(state, (CASE WHEN contains(job_id, '.') THEN 0 ELSE 1 END, job_id, state)) AS state, max(e) AS elapsed_s, max(CAST(c AS INTEGER)) AS alloc_cpus, count(CASE WHEN contains(job_id, '.') THEN 1 END) AS n_steps FROM a GROUP BY 1""")
def agg45(b: Bound):
    key = F.col("run_id").cast("string")
    rows = b.jobs.withColumn("job_id", F.when(F.col("job_no") == 1, key).otherwise(F.concat_ws(".", key, F.col("job_no").cast("string"))))
    return op.fold_jobs(rows).drop("max_rss_mb")


_USE = """count(*) AS n_jobs, round(sum(alloc_cpus * elapsed_s / 3600), 4) AS core_h, round(sum(CASE WHEN state <> 'COMPLETED' THEN alloc_cpus * elapsed_s / 3600 ELSE 0 END), 4) AS wasted_core_h, round(sum(max_rss_mb / 1024 * elapsed_s / 3600), 4) AS gb_h,
 round(max(max_rss_mb), 4) AS peak_mb, round(median(queue_s), 4) AS queue_median_s, round(max(queue_s), 4) AS queue_max_s"""
_USED = ("core_h", "wasted_core_h", "gb_h", "peak_mb", "queue_median_s", "queue_max_s")


@query("agg41", f"WITH j AS (SELECT j.*, o_orderpriority AS stage FROM {{jobs}} j JOIN {{orders}} ON o_orderkey = run_id) SELECT CASE WHEN grouping(stage) = 1 THEN 'ALL' ELSE stage END AS stage, CASE WHEN grouping(task) = 1 THEN 'ALL' ELSE task END AS task, {_USE} FROM j GROUP BY GROUPING SETS ((stage), (task), ())")
def agg41(b: Bound):
    jobs = b.jobs.join(b.orders.select(F.col("o_orderkey").alias("run_id"), F.col("o_orderpriority").alias("stage")), "run_id")
    return _r(op.usage(jobs, ["stage", "task"]), *_USED)


@query("agg42", """WITH h AS (SELECT run_id, sum(alloc_cpus * elapsed_s / 3600) AS core_h FROM {jobs} WHERE run_id % 3 = 0 GROUP BY 1), i AS (SELECT DISTINCT stage, CASE WHEN stage LIKE '1%' THEN 8 ELSE 2 END AS cpus FROM {runs} WHERE stage NOT LIKE '5%')
 SELECT stage, round(sum(coalesce(core_h, (3600 + run_id % 100) * coalesce(cpus, 1) / 3600.0)), 4) AS core_h, count(core_h) AS n_accounted, count(*) - count(core_h) AS n_estimated FROM {runs} LEFT JOIN h USING (run_id) LEFT JOIN i USING (stage) GROUP BY 1""")
def agg42(b: Bound):
    jobs = b.jobs.where("run_id % 3 = 0").groupBy("run_id").agg(F.sum(F.col("alloc_cpus") * F.col("elapsed_s") / 3600).alias("core_h"))
    inventory = b.runs.where("stage not like '5%'").select("stage", F.when(F.col("stage").like("1%"), 8).otherwise(2).alias("cpus")).distinct()
    return _r(op.usage_estimate(b.runs.withColumn("wall_s", 3600 + F.col("run_id") % 100), jobs, inventory), "core_h")


@query("agg43", f"SELECT CASE WHEN grouping(task) = 1 THEN 'ALL' ELSE task END AS task, round(sum(alloc_cpus * elapsed_s / 3600) * 0.04 + sum(max_rss_mb / 1024 * elapsed_s / 3600) * 0.005, 4) AS cost FROM {{jobs}} GROUP BY ROLLUP (task)")
def agg43(b: Bound):
    return _r(op.cost(op.usage(b.jobs, ["task"]), {"core_h": 0.04, "gb_h": 0.005}), "cost").select("task", "cost")


@query("agg43_sample", """WITH c AS (SELECT run_id, sum(alloc_cpus * elapsed_s / 3600 * 0.04) AS cost FROM {jobs} GROUP BY 1), r AS (SELECT *, row_number() OVER (PARTITION BY subject_id, stage ORDER BY CASE WHEN status = 'success' THEN 0 ELSE 1 END, attempt DESC, run_id DESC) AS n FROM {runs} JOIN c USING (run_id))
 SELECT (SELECT round(avg(s), 4) FROM (SELECT sum(cost) AS s FROM r GROUP BY subject_id) x) AS as_run, (SELECT round(avg(s), 4) FROM (SELECT sum(cost) AS s FROM r WHERE n = 1 AND status = 'success' GROUP BY subject_id) y) AS clean""")
def agg43_sample(b: Bound):
    cost = b.jobs.groupBy("run_id").agg(F.sum(F.col("alloc_cpus") * F.col("elapsed_s") / 3600 * 0.04).alias("cost"))
    runs = b.runs.join(cost, "run_id")
    return _r(op.per_sample_cost(runs, ordering.latest(runs, ["subject_id", "stage"], "success")), "as_run", "clean")


@query("agg44", """SELECT stage, count(*) AS n, count(CASE WHEN status = 'success' THEN 1 END) AS success, count(CASE WHEN status = 'failed' THEN 1 END) AS failed, count(CASE WHEN status = 'running' THEN 1 END) AS running, count(CASE WHEN attempt > 1 THEN 1 END) AS retries,
 round(median(d), 4) AS median_s, round(avg(d), 4) AS mean_s, max(d) AS max_s, CAST(sum(d) AS BIGINT) AS total_s FROM (SELECT *, run_id * 37 % 5000 AS d FROM {runs}) r GROUP BY 1""")
def agg44(b: Bound):
    return _r(op.run_report(b.runs.withColumn("duration_s", F.col("run_id") * 37 % 5000), ["stage"]), "median_s", "mean_s")


_LATEST = "SELECT subject_id, stage, status FROM (SELECT *, row_number() OVER (PARTITION BY subject_id, stage ORDER BY attempt DESC, run_id DESC) AS n FROM {runs}) t WHERE n = 1"
_PLAN = f"""SELECT m.sample_id AS subject_id, s.stage, CASE WHEN o.status = 'success' THEN 'done' WHEN o.status = 'running' THEN 'active' WHEN s.before IS NOT NULL AND coalesce(p.status, '') <> 'success' THEN concat('blocked(', s.before, ')') ELSE 'runnable' END AS state
 FROM {{members}} m CROSS JOIN (VALUES ('1-URGENT', NULL), ('2-HIGH', '1-URGENT'), ('3-MEDIUM', '2-HIGH')) s(stage, before) LEFT JOIN ({_LATEST}) o ON o.subject_id = m.sample_id AND o.stage = s.stage LEFT JOIN ({_LATEST}) p ON p.subject_id = m.sample_id AND p.stage = s.before"""


def _plan(b: Bound):
    return op.plan_table(b.members.select(F.col("sample_id").alias("subject_id")), ordering.latest(b.runs, ["subject_id", "stage"]), _STAGES)


@query("sta31", _PLAN)
def sta31(b: Bound):
    return _plan(b)


@query("agg46", f"""WITH p AS ({_PLAN}), r AS (SELECT stage, median(d) AS median FROM (SELECT stage, run_id * 37 % 5000 AS d, row_number() OVER (PARTITION BY stage ORDER BY started_at DESC, run_id DESC) AS n FROM {{runs}} WHERE status = 'success') t WHERE n <= 20 GROUP BY 1),
 c AS (SELECT stage, count(*) AS total, count(CASE WHEN state = 'done' THEN 1 END) AS done, count(CASE WHEN state = 'active' THEN 1 END) AS active, count(CASE WHEN state = 'runnable' THEN 1 END) AS runnable, count(CASE WHEN state LIKE 'blocked%' THEN 1 END) AS waiting FROM p GROUP BY 1)
 SELECT stage, total, done, active, runnable, waiting, round(median, 4) AS median, round(ceil((total - done) / 16.0) * median, 4) AS eta FROM c LEFT JOIN r USING (stage)""")
def agg46(b: Bound):
    runs = b.runs.where("status = 'success'").withColumn("d", F.col("run_id") * 37 % 5000)
    recent = ordering.recent_median(runs, "stage", [F.col("started_at").desc(), F.col("run_id").desc()], "d", 20)
    return _r(op.progress(_plan(b), recent, 16), "median", "eta")


@query("jon19", """SELECT run_id, job_no, CASE WHEN job_no % 3 = 0 THEN d.event_type WHEN c.event_type IS NOT NULL THEN c.event_type END AS task, CASE WHEN job_no % 3 = 0 AND d.event_type IS NOT NULL THEN 'dir' WHEN c.event_type IS NOT NULL THEN 'call_id' ELSE 'missing' END AS matched_by
 FROM (SELECT *, CASE WHEN job_no % 3 = 0 THEN run_id END AS dir, run_id + 5000 AS call_id FROM {jobs}) j LEFT JOIN {events} d ON d.event_id = j.dir LEFT JOIN {events} c ON c.event_id = j.call_id""")
def jon19(b: Bound):
    refs = b.jobs.select("run_id", "job_no", F.when(F.col("job_no") % 3 == 0, F.col("run_id")).alias("dir"), (F.col("run_id") + 5000).alias("call_id"))
    by_dir = b.events.select(F.col("event_id").alias("dir"), F.col("event_type").alias("task"))
    return op.join_accounting(refs, by_dir, by_dir.withColumnRenamed("dir", "call_id")).select("run_id", "job_no", "task", "matched_by")


@query("jon25", "SELECT sample_id AS subject_id FROM {members} WHERE sample_id NOT IN (SELECT subject_id FROM {runs} WHERE stage = '2-HIGH' AND status = 'success')")
def jon25(b: Bound):
    return op.waiting_for(b.members.select(F.col("sample_id").alias("subject_id")), b.runs, "2-HIGH")


_LINE = "CASE l_partkey % 9 WHEN 0 THEN 'Exceeded memory limit' WHEN 1 THEN 'slurmstepd: time limit reached' WHEN 2 THEN 'write: No space left on device' WHEN 3 THEN 'input missing' WHEN 4 THEN 'some error' ELSE 'all fine' END"


@query("prj23", f"""WITH l AS (SELECT l_orderkey, l_linenumber, {_LINE} AS line FROM {{lineitem}} WHERE l_returnflag = 'R'), r AS (SELECT *, CASE WHEN regexp_matches(line, '(?i)exceeded memory') THEN 0 WHEN regexp_matches(line, '(?i)time limit') THEN 1 WHEN regexp_matches(line, '(?i)no space left') THEN 2 WHEN regexp_matches(line, '(?i)missing') THEN 3 WHEN regexp_matches(line, '(?i)error') THEN 5 END AS k FROM l)
 SELECT l_orderkey, CASE min(k) WHEN 0 THEN 'out_of_memory' WHEN 1 THEN 'time_limit' WHEN 2 THEN 'disk_full' WHEN 3 THEN 'missing_input' ELSE 'error' END AS kind, CASE min(k) WHEN 0 THEN 'memory' WHEN 1 THEN 'time' WHEN 2 THEN 'disk' WHEN 3 THEN 'input' ELSE '' END AS resource,
 arg_min(l_linenumber, (k, l_linenumber)) AS line_no, arg_min(line, (k, l_linenumber)) AS evidence FROM r WHERE k IS NOT NULL GROUP BY 1""")
def prj23(b: Bound):
    lines = b.lineitem.where("l_returnflag = 'R'").select("l_orderkey", F.col("l_linenumber").alias("line_no"), F.expr(_LINE).alias("line"))
    return op.classify_failures(lines, "l_orderkey")


@query("sta28", "WITH t AS (SELECT task, job_no, state, alloc_cpus, max_rss_mb FROM {jobs} WHERE state = 'COMPLETED' AND job_no > 1) SELECT task, 'alloc_cpus' AS resource, CAST(max(alloc_cpus) AS DOUBLE) AS largest FROM t GROUP BY 1 UNION ALL SELECT task, 'max_rss_mb', round(max(max_rss_mb), 4) FROM t GROUP BY 1")
def sta28(b: Bound):
    tasks = b.jobs.withColumns({"attempt": F.col("job_no"), "alloc_cpus": F.col("alloc_cpus").cast("double")})
    return _r(op.learned_maxima(tasks, ["alloc_cpus", "max_rss_mb"]), "largest")


@query("sta30", f"""WITH s AS (SELECT subject_id, max(run_id) AS run_id FROM {{runs}} WHERE status = 'success' GROUP BY 1) SELECT subject_id, run_id FROM s WHERE subject_id % 4 = 0 OR subject_id % 5 = 0""")
def sta30(b: Bound):
    sources = b.runs.where("status = 'success'").groupBy("subject_id").agg(F.max("run_id").alias("run_id"))
    digests = sources.select("subject_id", F.when(F.col("subject_id") % 4 == 0, -1).otherwise(F.col("run_id")).alias("source_run"), F.when(F.col("subject_id") % 5 == 0, 6).otherwise(7).alias("schema"))
    return op.stale(digests, sources, 7)


@query("sta17", """SELECT sample_id, concat_ws(';', CASE WHEN depth_mean < 0 THEN 'depth_negative' END, CASE WHEN depth_mean < 1000 THEN 'depth_low' END, CASE WHEN sex = '' THEN 'sex_unknown' END) AS codes, CASE WHEN depth_mean < 0 THEN 'fail' WHEN depth_mean < 1000 THEN 'warn' WHEN sex = '' THEN 'info' ELSE 'pass' END AS worst FROM {members}""")
def sta17(b: Bound):
    rules = [("depth_negative", F.col("depth_mean") < 0, "fail"), ("depth_low", F.col("depth_mean") < 1000, "warn"), ("sex_unknown", F.col("sex") == "", "info")]
    return op.qc_rules(b.members, rules, "sample_id")


@query("sta27", "WITH r AS (SELECT sample_id, count(CASE WHEN called = 0 THEN 1 END) / CAST(count(*) AS DOUBLE) AS missing FROM {genotypes} GROUP BY 1) SELECT sample_id, round(missing, 6) AS missing FROM r WHERE missing > (SELECT median(missing) FROM r) + 0.1")
def sta27(b: Bound):
    rates = b.genotypes.groupBy("sample_id").agg((F.count_if(F.col("called") == 0) / F.count("*")).alias("missing"))
    return _r(op.missing_rate_flag(rates, "missing", 0.1), "missing", digits=6)
