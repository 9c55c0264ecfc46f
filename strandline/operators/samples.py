"""Members and their tables: inputs, validation, enrichment, copy numbers, alleles, haplogroups and stage summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def input_totals(files: DataFrame, floors: dict[str, float]) -> DataFrame:
    """Per sample: files, reads, bases, exactness, dropped duplicate files and warnings for totals below a floor.

    files: sample_id, path, reads, bases, exact.  A path counts once per sample.
    """
    once = files.dropDuplicates(["sample_id", "path"])
    totals = once.groupBy("sample_id").agg(F.count("*").alias("n_files"), F.sum("reads").cast("long").alias("reads"), F.sum("bases").cast("long").alias("bases"), F.bool_and("exact").alias("exact"))
    seen = files.groupBy("sample_id").agg(F.count("*").alias("listed"))
    warn = F.concat_ws(";", *[F.when(F.col(c) < least, f"{c} below {least:g}") for c, least in floors.items()])
    return totals.join(seen, "sample_id").select("sample_id", "n_files", "reads", "bases", "exact", (F.col("listed") - F.col("n_files")).alias("dropped"), warn.alias("warnings"))


#: Means of the same depths added in another order differ in their last bits; a relative nudge far above that puts ratios on a bound or an
#: exact half of the last digit on one side.
NUDGE = 1 + 1e-11


def coverage_ratios(cov: DataFrame, y_min: float) -> DataFrame:
    """Per sample: chrX and chrY mean depth over the mean of the autosome means, and the sex they say (ratios with NUDGE)."""
    from ..functions.expressions import contig_class

    kind = contig_class(F.col("chrom"))
    per = cov.groupBy("sample_id", "chrom").agg(F.avg("depth").alias("depth"))
    mean = lambda k: F.avg(F.when(kind == k, F.col("depth")))
    rows = per.groupBy("sample_id").agg(mean("autosome").alias("a"), mean("chrX").alias("x"), mean("chrY").alias("y"))
    out = rows.select("sample_id", *[(F.try_divide(c, "a") * NUDGE).alias(f"{c}_ratio") for c in ("x", "y")])
    return out.withColumn("sex", F.when(F.col("y_ratio") >= y_min, "XY").when(F.col("y_ratio").isNotNull(), "XX").otherwise(""))


def cn_summary(cn: DataFrame) -> DataFrame:
    """Per region: called and failed members, mean and population variance, and members per copy number (as text 2:10;3:1)."""
    counts = cn.where("cn is not null").groupBy("region", "cn").agg(F.count("*").alias("k"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cn", "k"))), lambda s: F.concat_ws(":", s["cn"].cast("string"), s["k"].cast("string"))), ";")
    listed = counts.groupBy("region").agg(text.alias("counts"))
    sums = cn.groupBy("region").agg(F.count("cn").alias("called"), F.count_if(F.col("cn").isNull()).alias("failed"), F.avg("cn").alias("mean"), F.var_pop("cn").alias("variance"))
    return sums.join(listed, "region", "left")


def pooled_alleles(rows: DataFrame, gene: str, a1: str, a2: str) -> DataFrame:
    """Allele frequencies over both haplotypes: count, fraction of called alleles, called members (alleles / 2), call rate."""
    long = rows.select("sample_id", gene, F.explode(F.array(a1, a2)).alias("allele"))
    per = long.groupBy(gene, "allele").agg(F.count("*").alias("count"))
    total = F.sum(F.when(F.col("allele").isNotNull(), F.col("count"))).over(Window.partitionBy(gene))
    every = F.sum("count").over(Window.partitionBy(gene))
    out = per.select(gene, "allele", "count", F.try_divide(F.col("count"), total).alias("fraction"), (total / 2).alias("n_called"), F.try_divide(total, every).alias("call_rate"))
    return out.where("allele is not null")


def haplogroups(rows: DataFrame) -> DataFrame:
    """Frequencies of haplogroups and of macro groups (first letter) over members' major haplotypes."""
    major = rows.where("major").select("sample_id", F.explode(F.array(F.struct(F.lit("haplogroup").alias("level"), F.col("haplogroup").alias("value")), F.struct(F.lit("macro").alias("level"), F.substring("haplogroup", 1, 1).alias("value")))).alias("v")).select("sample_id", "v.*")
    counts = major.groupBy("level", "value").agg(F.count("*").alias("count"))
    return counts.withColumn("fraction", F.col("count") / F.sum("count").over(Window.partitionBy("level")))


def haplotype_collapse(gt: DataFrame) -> DataFrame:
    """Haplotype alleles weighed by abundance to a diploid call per site: reference first, then by abundance; two are kept.

    gt: site, sample_id, allele (0 is reference), abundance.
    """
    sums = gt.groupBy("site", "sample_id", "allele").agg(F.sum("abundance").alias("w"))
    order = Window.partitionBy("site", "sample_id").orderBy((F.col("allele") != 0).cast("int"), F.col("w").desc(), "allele")
    kept = sums.withColumn("n", F.row_number().over(order)).where("n <= 2")
    rows = kept.groupBy("site", "sample_id").agg(F.array_sort(F.collect_list(F.struct("n", "allele", "w"))).alias("a"))
    one = lambda i, f: F.get("a", i)[f]
    second = F.coalesce(one(1, "allele"), one(0, "allele"))
    total = one(0, "w") + F.coalesce(one(1, "w"), F.lit(0.0))
    alt = F.when(one(0, "allele") != 0, one(0, "w")).otherwise(0.0) + F.when(second != 0, F.coalesce(one(1, "w"), F.lit(0.0))).otherwise(0.0)
    gt_text = F.concat_ws("/", one(0, "allele").cast("string"), second.cast("string"))
    return rows.select("site", "sample_id", gt_text.alias("gt"), F.try_divide(alt, total).alias("vaf"), (one(0, "allele") != second).alias("het"))


def major_haplotypes(classified: DataFrame, abundances: DataFrame) -> DataFrame:
    """Classifier rows with abundances by label (the part after the last dot), and the member's major haplotype flagged."""
    rows = classified.withColumn("label", F.substring_index("id", ".", -1)).join(abundances, ["sample_id", "label"], "left")
    order = Window.partitionBy("sample_id").orderBy(F.col("abundance").desc_nulls_last(), "label")
    return rows.withColumn("major", F.row_number().over(order) == 1)


def mt_counts(gt: DataFrame, homoplasmic: float) -> DataFrame:
    """Per member: homoplasmic and heteroplasmic records and the largest allele fraction."""
    return gt.groupBy("sample_id").agg(F.count_if(F.col("vaf") >= homoplasmic).alias("homoplasmic"), F.count_if((F.col("vaf") > 0) & (F.col("vaf") < homoplasmic)).alias("heteroplasmic"), F.max("vaf").alias("max_vaf"))


def roh(df: DataFrame, bins: Column) -> DataFrame:
    """Per member and length bin: number, total and longest run."""
    return df.groupBy("sample_id", bins.alias("bin")).agg(F.count("*").alias("n"), F.sum("length").cast("long").alias("total"), F.max("length").alias("longest"))


def per_contig(df: DataFrame, contigs: Sequence[str], value: str) -> DataFrame:
    """One row per sample with a mean column per contig."""
    return df.groupBy("sample_id").agg(*[F.avg(F.when(F.col("chrom") == c, F.col(value))).alias(f"mean_{c}") for c in contigs], F.avg(value).alias("mean"))


def with_fallback(own: DataFrame, other: DataFrame, key: str, value: str, names: tuple[str, str]) -> DataFrame:
    """The own value, else the other table's, and where it came from."""
    rows = own.select(key, F.col(value).alias("__own")).join(other.select(key, F.col(value).alias("__other")), key, "full_outer")
    source = F.when(F.col("__own").isNotNull(), names[0]).when(F.col("__other").isNotNull(), names[1])
    return rows.select(key, F.coalesce("__own", "__other").alias(value), source.alias("source"))


def member_table(members: DataFrame, parts: Sequence[DataFrame]) -> DataFrame:
    """members left-joined with per-member tables on sample_id."""
    out = members
    for p in parts:
        out = out.join(p, "sample_id", "left")
    return out


def preferred(values: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of several stages' values the first stage's in an order of priority, and that stage."""
    rank = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("stage"))
    return values.where((rank > 0) & F.col("value").isNotNull()).groupBy(*key).agg(F.min_by("value", rank).alias("value"), F.min_by("stage", rank).alias("stage"))


def validate(df: DataFrame, target: str, rules: Sequence[tuple[str, Column, str]]) -> DataFrame:
    """Rules as (check, failing condition, detail) to rows check, target, status, detail."""
    cells = F.array(*[F.struct(F.lit(name).alias("check"), F.when(F.coalesce(bad, F.lit(False)), "fail").otherwise("ok").alias("status"), F.when(F.coalesce(bad, F.lit(False)), detail).otherwise("").alias("detail")) for name, bad, detail in rules])
    return df.select(F.col(target).cast("string").alias("target"), F.explode(cells).alias("c")).select("c.check", "target", "c.status", "c.detail")


def safe_names(df: DataFrame, column: str, reserved: Sequence[str] = ()) -> DataFrame:
    """Names with other characters replaced, and whether the result is used twice or reserved."""
    safe = F.regexp_replace(column, "[^A-Za-z0-9_]", "_")
    rows = df.select(column, safe.alias("safe")).distinct()
    twice = rows.groupBy("safe").agg((F.count("*") > 1).alias("collides"))
    return rows.join(twice, "safe").withColumn("reserved", F.col("safe").isin(*reserved) if reserved else F.lit(False))


def eav_wide(df: DataFrame, key: str, metrics: Sequence[str], multi: Sequence[str] = ()) -> DataFrame:
    """Rows (key, metric, value) to a column per metric: numbers, or all values in order for the multi-valued ones."""
    columns = [F.max(F.when(F.col("metric") == m, F.col("value").try_cast("double"))).alias(m) for m in metrics]
    many = [F.array_join(F.array_sort(F.collect_set(F.when(F.col("metric") == m, F.col("value")))), ",").alias(m) for m in multi]
    return df.groupBy(key).agg(*columns, *many)


def ids_from_messages(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Ids of messages `prefix: A, B, C`, one per row."""
    text = F.substring(F.col(column), F.lit(len(prefix) + 1), F.length(column))
    ids = F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")
    return df.where(F.col(column).startswith(prefix)).select(F.explode(ids).alias("id"))


def filter_genes(df: DataFrame, column: str, genes: Sequence[str], top: int, order: Sequence[Column]) -> DataFrame:
    """Rows whose ;-joined genes hold one of a list, whatever the case; the first ones of an order."""
    wanted = F.array(*[F.lit(g.upper()) for g in genes])
    return df.where(F.arrays_overlap(F.transform(F.split(column, ";"), lambda g: F.upper(F.trim(g))), wanted)).orderBy(*order).limit(top)


def findings(df: DataFrame, classes: Sequence[str], doubts: Sequence[str]) -> DataFrame:
    """Rows of some classes, or with a doubt among their ;-joined notes."""
    return df.where(F.col("class").isin(*classes) | F.arrays_overlap(F.split("notes", ";"), F.array(*[F.lit(d) for d in doubts])))


def stage_summary(stage: str, frames: dict[str, DataFrame]) -> DataFrame:
    """Typed aggregates (key, value) of several resources as texts: stage, resource, metric, key, value."""
    out = None
    for name, df in frames.items():
        resource, _, metric = name.partition(".")
        rows = df.select(F.lit(stage).alias("stage"), F.lit(resource).alias("resource"), F.lit(metric).alias("metric"), F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


def ancestry(vectors: DataFrame, k: int = 4, seed: int = 1, sample: int = 20_000, penalty: float = 1e-3) -> DataFrame:
    """PCA and multinomial logistic regression on labelled vectors: every vector gets its components, the probability of each label, and the
    likeliest one.

    The models are fitted on at most `sample` labelled vectors (a hash sample), a documented bound; all vectors are scored.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = vectors.select("vec_id", array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"), F.col("label").cast("double").alias("label"))
    train = rows.where("label is not null and vec_id % 5 <> 0").orderBy(F.xxhash64(F.lit(seed), "vec_id")).limit(sample)
    fit = LogisticRegression(featuresCol="pcs", labelCol="label", maxIter=200, tol=1e-9, regParam=penalty, family="multinomial")
    model = Pipeline(stages=[PCA(k=k, inputCol="features", outputCol="pcs"), fit]).fit(train)
    out = model.transform(rows).withColumns({"pcs": vector_to_array("pcs"), "probabilities": vector_to_array("probability")})
    return out.select("vec_id", F.col("prediction").cast("int").alias("predicted"), F.array_max("probabilities").alias("probability"), (F.col("vec_id") % 5 == 0).alias("held_out"), "pcs", "probabilities")
