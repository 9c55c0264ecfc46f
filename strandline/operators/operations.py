"""Runs, jobs and tasks: usage, cost, reports, progress, plans, failures and learned maxima."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import quantiles


def fold_jobs(rows: DataFrame) -> DataFrame:
    """One record per base job id from accounting rows: the parent's state and the largest values over its steps.

    rows: job_id (`123` or `123.step`), state, elapsed_s, max_rss_mb, alloc_cpus.
    """
    base = F.split_part("job_id", F.lit("."), F.lit(1))
    parent = F.when(F.col("job_id").contains("."), 0).otherwise(1)
    return rows.groupBy(base.alias("job")).agg(
        F.max_by("state", F.struct(parent, F.col("job_id"), F.col("state"))).alias("state"),
        F.max("elapsed_s").alias("elapsed_s"),
        F.max("max_rss_mb").alias("max_rss_mb"),
        F.max("alloc_cpus").alias("alloc_cpus"),
        F.count_if(F.col("job_id").contains(".")).alias("n_steps"),
    )


def usage(jobs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Core hours, GB hours, peaks, queue times, wasted share by every key and in total (ALL).

    jobs: keys, alloc_cpus, elapsed_s, max_rss_mb, queue_s, state.
    """
    core = F.col("alloc_cpus") * F.col("elapsed_s") / 3600
    aggs = [
        F.count("*").alias("n_jobs"),
        F.sum(core).alias("core_h"),
        F.sum(F.when(F.col("state") != "COMPLETED", core).otherwise(0.0)).alias("wasted_core_h"),
        F.sum(F.col("max_rss_mb") / 1024 * F.col("elapsed_s") / 3600).alias("gb_h"),
        F.max("max_rss_mb").alias("peak_mb"),
        F.median("queue_s").alias("queue_median_s"),
        F.max("queue_s").alias("queue_max_s"),
    ]
    sets = jobs.groupingSets([[F.col(k)] for k in keys] + [[]], *keys) if len(keys) > 1 else jobs.rollup(*keys)
    out = sets.agg(*aggs, *[F.grouping(k).alias(f"__{k}") for k in keys])
    named = [F.when(F.col(f"__{k}") == 1, "ALL").otherwise(F.col(k).cast("string")).alias(k) for k in keys]
    return out.select(*named, *[c for c in out.columns if not c.startswith("__") and c not in keys])


def usage_estimate(tasks: DataFrame, jobs: DataFrame, inventory: DataFrame) -> DataFrame:
    """Core hours per stage: accounted where a job row exists, else wall time x the inventory's CPUs; with source counts."""
    rows = tasks.join(jobs.select("run_id", "core_h"), "run_id", "left").join(F.broadcast(inventory), "stage", "left")
    estimate = F.col("wall_s") * F.coalesce("cpus", F.lit(1)) / 3600
    value = F.coalesce("core_h", estimate)
    return rows.groupBy("stage").agg(F.sum(value).alias("core_h"), F.count("core_h").alias("n_accounted"), (F.count("*") - F.count("core_h")).alias("n_estimated"))


def cost(usage_: DataFrame, prices: dict[str, float]) -> DataFrame:
    """Sum of quantity times price; quantities that are null cost nothing."""
    total = F.lit(0.0)
    for column, price in prices.items():
        total = total + F.coalesce(F.col(column), F.lit(0.0)) * price
    return usage_.withColumn("cost", total)


def per_sample_cost(runs: DataFrame, clean: DataFrame) -> DataFrame:
    """Mean cost per subject as run (all attempts) and clean (latest successes only)."""
    mean = lambda df, name: df.groupBy("subject_id").agg(F.sum("cost").alias("c")).agg(F.avg("c").alias(name))
    return mean(runs, "as_run").crossJoin(mean(clean, "clean"))  # one row each


def run_report(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts by status, retries and durations per key."""
    status = [F.count_if(F.col("status") == s).alias(s) for s in ("success", "failed", "running")]
    d = "duration_s"
    return runs.groupBy(*keys).agg(F.count("*").alias("n"), *status, F.count_if(F.col("attempt") > 1).alias("retries"), F.median(d).alias("median_s"), F.avg(d).alias("mean_s"), F.max(d).alias("max_s"), F.sum(d).alias("total_s"))


def waiting_for(subjects: DataFrame, runs: DataFrame, stage: str) -> DataFrame:
    """Subjects without a successful run of a stage."""
    return subjects.join(runs.where((F.col("stage") == stage) & (F.col("status") == "success")).select("subject_id").distinct(), "subject_id", "left_anti")


def plan_table(subjects: DataFrame, latest: DataFrame, stages: Sequence[str]) -> DataFrame:
    """Status of each subject and stage: done, active, blocked(reason) or runnable.

    A stage needs the one before it.  latest: subject_id, stage, status of the newest run.
    """
    status = [F.max(F.when(F.col("stage") == s, F.col("status"))).alias(f"s{i}") for i, s in enumerate(stages)]
    wide = subjects.join(latest.groupBy("subject_id").agg(*status), "subject_id", "left")
    cells = []
    for i, s in enumerate(stages):
        own = F.col(f"s{i}")
        state = F.when(own == "success", "done").when(own == "running", "active")
        if i:
            state = state.when(~F.col(f"s{i - 1}").eqNullSafe("success"), f"blocked({stages[i - 1]})")
        cells.append(F.struct(F.lit(s).alias("stage"), state.otherwise("runnable").alias("state")))
    return wide.select("subject_id", F.explode(F.array(*cells)).alias("c")).select("subject_id", "c.stage", "c.state")


def progress(plan: DataFrame, recent: DataFrame, parallel: int) -> DataFrame:
    """Per stage: counts by state and the estimated seconds left: ceil(remaining / parallel) medians."""
    states = {"done": "done", "active": "active", "runnable": "runnable"}
    counts = plan.groupBy("stage").agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("state") == v).alias(k) for k, v in states.items()],
        F.count_if(F.col("state").startswith("blocked")).alias("waiting"),
    )
    eta = F.ceil((F.col("total") - F.col("done")) / parallel) * F.col("median")
    return counts.join(recent.select("stage", "median"), "stage", "left").withColumn("eta", eta)


def join_accounting(refs: DataFrame, by_dir: DataFrame, by_id: DataFrame) -> DataFrame:
    """Jobs matched to task records by directory, else by call id; with how, and ok or missing."""
    first = by_dir.select("dir", F.col("task").alias("task_dir"))
    second = by_id.select("call_id", F.col("task").alias("task_id"))
    rows = refs.join(first, "dir", "left").join(second, "call_id", "left")
    how = F.when(F.col("task_dir").isNotNull(), "dir").when(F.col("task_id").isNotNull(), "call_id").otherwise("missing")
    return rows.select(*refs.columns, F.coalesce("task_dir", "task_id").alias("task"), how.alias("matched_by"))


#: Failure kinds and their patterns, in the order in which they are tried.
FAILURES = (
    ("out_of_memory", "memory", "(?i)out of memory|oom-kill|cannot allocate|exceeded memory"),
    ("time_limit", "time", "(?i)time limit|timed out|timeout"),
    ("disk_full", "disk", "(?i)no space left|disk quota|disk full"),
    ("missing_input", "input", "(?i)no such file|not found|missing"),
    ("permission", "input", "(?i)permission denied|read-only"),
    ("error", "", "(?i)error|failed|exception"),
)


def classify_failures(lines: DataFrame, key: str) -> DataFrame:
    """Per key the first rule that any line meets (rule order, then line): kind, resource, the evidence line.

    lines: key, line_no, line.
    """
    rule, kinds, resources = F.when(F.lit(False), 0), [], []
    for i, (kind, resource, pattern) in enumerate(FAILURES):
        rule = rule.when(F.col("line").rlike(pattern), i)
        kinds.append(F.lit(kind))
        resources.append(F.lit(resource))
    best = F.min(F.struct(F.col("rule"), "line_no", "line")).alias("b")
    found = lines.withColumn("rule", rule).where("rule is not null").groupBy(key).agg(best)
    return found.select(key, F.get(F.array(*kinds), F.col("b.rule")).alias("kind"), F.get(F.array(*resources), F.col("b.rule")).alias("resource"), F.col("b.line_no").alias("line_no"), F.col("b.line").alias("evidence"))


def learned_maxima(tasks: DataFrame, changes: Sequence[str]) -> DataFrame:
    """Per task and resource the largest granted value of completed tasks that had been raised (attempt > 1)."""
    long = tasks.where("state = 'COMPLETED' and attempt > 1").unpivot(["task"], list(changes), "resource", "granted")
    return long.groupBy("task", "resource").agg(F.max("granted").alias("largest"))


def stale(digests: DataFrame, sources: DataFrame, schema: int) -> DataFrame:
    """Digests to rebuild: another schema version, or a source run that is not the one they were made from."""
    fresh = digests.where(F.col("schema") == schema).join(sources.select("subject_id", F.col("run_id").alias("source_run")), ["subject_id", "source_run"], "left_semi")
    return sources.select("subject_id", "run_id").join(fresh.select("subject_id"), "subject_id", "left_anti")


def event_counts(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    return events.groupBy(*keys).agg(F.count("*").alias("count"))


def qc_rules(df: DataFrame, rules: Sequence[tuple[str, Column, str]], key: str) -> DataFrame:
    """Rules as data: (code, condition, severity) to rows (key, codes, worst)."""
    from ..functions.expressions import severity

    hits = F.array_compact(F.array(*[F.when(c, F.struct(severity(F.lit(s)).alias("rank"), F.lit(s).alias("severity"), F.lit(code).alias("code"))) for code, c, s in rules]))
    rows = df.select(key, hits.alias("hits"))
    return rows.select(key, F.array_join(F.transform("hits", lambda h: h["code"]), ";").alias("codes"), F.coalesce(F.array_max("hits")["severity"], F.lit("pass")).alias("worst"))


def missing_rate_flag(members: DataFrame, rate: str, excess: float) -> DataFrame:
    """Members whose missing share lies above the cohort's median by more than an excess."""
    middle = quantiles(members, [], rate, {"__med": 0.5}).select("__med")  # one row
    return members.crossJoin(F.broadcast(middle)).where(F.col(rate) > F.col("__med") + excess).drop("__med")
