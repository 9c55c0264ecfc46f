"""Scans of the text formats: header-driven tables, VCF, BED, PAF, GTF, graph paths, reports, JSON and logs.

All are lazy DataFrames over ``spark.read.text`` / ``csv`` / ``json``, split by Spark where the file allows it.  Headers are
the only thing read by the driver: a first line, or the ``#CHROM`` line.  Gzip files cannot be split: convert them to
Parquet once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.expressions import mapped, megabytes, norm_sex, seconds


def lines(spark: SparkSession, paths) -> DataFrame:
    return spark.read.text(paths)


def _cell(i: int, sep: str = "\t") -> Column:
    return F.get(F.split("value", sep), F.lit(i))


def read_tsv(spark: SparkSession, paths) -> DataFrame:
    """Tab-separated text with a header: ## lines are skipped, # is stripped from the header, later # lines are skipped,
    short rows are padded with empty texts."""
    rows = lines(spark, paths).where(~F.col("value").startswith("##"))
    header = rows.where(F.col("value").startswith("#")).first() or rows.first()
    if header is None:
        raise ValueError(f"no header in {paths}")
    names = header["value"].lstrip("#").split("\t")
    body = rows.where(~F.col("value").startswith("#") & (F.col("value") != header["value"]))
    return body.select(*[F.coalesce(_cell(i), F.lit("")).alias(n) for i, n in enumerate(names)])


def _vcf_header(spark: SparkSession, path) -> list[str]:
    head = lines(spark, path).where(F.col("value").startswith("#CHROM")).first()
    if head is None:
        raise ValueError(f"no #CHROM line in {path}")
    return head["value"].split("\t")


def read_vcf_sites(spark: SparkSession, path) -> DataFrame:
    """Sites: chrom, pos, id, ref, alts, filters, info (map; flags have a null value)."""
    body = lines(spark, path).where(~F.col("value").startswith("#"))
    listed = lambda c, sep: F.filter(F.split(c, sep), lambda x: ~x.isin("", "."))
    return body.select(_cell(0).alias("chrom"), _cell(1).cast("long").alias("pos"), _cell(2).alias("id"), _cell(3).alias("ref"), listed(_cell(4), ",").alias("alts"), listed(_cell(6), ";").alias("filters"), mapped(_cell(7)).alias("info"))


def read_vcf_genotypes(spark: SparkSession, path, members: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Long genotypes (chrom, pos, id, sample_id, gt) by sample name, and the members that the file lacks."""
    names = _vcf_header(spark, path)[9:]
    wanted = [(i, n) for i, n in enumerate(names) if members is None or n in set(members)]
    body = lines(spark, path).where(~F.col("value").startswith("#"))
    cells = F.array(*[F.struct(F.lit(n).alias("sample_id"), F.split_part(_cell(9 + i), F.lit(":"), F.lit(1)).alias("gt")) for i, n in wanted])
    rows = body.select(_cell(0).alias("chrom"), _cell(1).cast("long").alias("pos"), _cell(2).alias("id"), F.explode(cells).alias("g"))
    return rows.select("chrom", "pos", "id", "g.*"), sorted(set(members or []) - set(names))


def vcf_query(sites: DataFrame, columns: dict[str, Column], chrom: str | None = None, start: int = 0, end: int | None = None, where: Column | None = None) -> DataFrame:
    """Projection of site columns in a region, with a condition: filters and columns reach the Parquet scan."""
    out = sites
    if chrom is not None:
        out = out.where((F.col("chrom") == chrom) & (F.col("pos") >= start))
        out = out.where(F.col("pos") < end) if end is not None else out
    out = out.where(where) if where is not None else out
    return out.select(*[c.alias(n) for n, c in columns.items()])


def read_bed(spark: SparkSession, path, extra: Sequence[str] = ()) -> DataFrame:
    """chrom, start, end and more columns; track, browser and # lines, malformed and empty intervals are dropped."""
    body = lines(spark, path).where(~F.col("value").rlike("^(#|track|browser)"))
    rows = body.select(_cell(0).alias("chrom"), _cell(1).try_cast("long").alias("start"), _cell(2).try_cast("long").alias("end"), *[_cell(3 + i).alias(n) for i, n in enumerate(extra)])
    return rows.where("start is not null and end is not null and start < end")


def read_sections(spark: SparkSession, paths, spec: dict[str, Sequence[tuple[str, str]]]) -> dict[str, DataFrame]:
    """One DataFrame per line code of a report: code to (column, type) pairs; the file is kept as `file`."""
    body = lines(spark, paths).withColumn("file", F.input_file_name())
    return {
        code: body.where(_cell(0) == code).select(F.element_at(F.split("file", "/"), -1).alias("file"), *[_cell(i + 1).try_cast(t).alias(n) for i, (n, t) in enumerate(columns)])
        for code, columns in spec.items()
    }


def read_kv(spark: SparkSession, paths, keys: Sequence[str]) -> DataFrame:
    """Key/value lines of many files to one row per file."""
    body = lines(spark, paths).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), _cell(0).alias("key"), _cell(1).alias("value"))
    return body.groupBy("file").agg(*[F.max(F.when(F.col("key") == k, F.col("value"))).alias(k) for k in keys])


def read_label_summary(spark: SparkSession, path, labels: Sequence[str]) -> DataFrame:
    """Label rows (sample, label, percent, count) to one row per sample with percent and count columns."""
    body = lines(spark, path).where(~F.col("value").startswith("#"))
    rows = body.select(_cell(0).alias("sample_id"), _cell(1).alias("label"), _cell(2).try_cast("double").alias("percent"), _cell(3).try_cast("long").alias("n"))
    pick = lambda label, c: F.max(F.when(F.col("label") == label, F.col(c))).alias(f"{label}_{c}")
    return rows.groupBy("sample_id").agg(*[pick(label, c) for label in labels for c in ("percent", "n")])


def read_json_map(spark: SparkSession, paths, schema: StructType | str, map_column: str, key: str, multi_line: bool = True) -> DataFrame:
    """JSON documents that hold a map of structs, one row per entry with the map's key."""
    docs = spark.read.json(paths, schema=schema, multiLine=multi_line)
    rest = [c for c in docs.columns if c != map_column]
    return docs.select(*rest, F.explode(map_column).alias(key, "__v")).select(*rest, key, "__v.*")


def read_task_log(spark: SparkSession, paths) -> DataFrame:
    """JSON-lines task logs (source, ts, message) to one row per source: start, end, outcome, retries, cached."""
    rows = spark.read.json(paths, schema="source string, ts double, message string")
    said = lambda p: F.col("message").rlike(p)
    return rows.groupBy("source").agg(
        F.min("ts").alias("started"),
        F.max("ts").alias("ended"),
        F.max_by("message", "ts").alias("last"),
        F.count_if(said("^retry")).alias("retries"),
        (F.count_if(said("^cached")) > 0).alias("cached"),
        F.when(F.count_if(said("^done")) > 0, "done").when(F.count_if(said("^failed")) > 0, "failed").otherwise("open").alias("outcome"),
    )


EVENT_SCHEMA = "event string, level string, run_id bigint, ts timestamp, detail string"


def read_events(spark: SparkSession, path) -> DataFrame:
    return spark.read.json(path, schema=EVENT_SCHEMA)


def read_manifest(spark: SparkSession, path, aliases: dict[str, Sequence[str]], sep: str) -> tuple[DataFrame, DataFrame]:
    """Rows per file to one row per sample with its distinct files, and the samples whose sex or parents conflict.

    aliases: target column (sample_id, path, sex, father_id, mother_id) to the names it may have.
    """
    raw = spark.read.csv(path, header=True, sep=sep)
    known = {t: [raw[n] for n in names if n in raw.columns] for t, names in aliases.items()}
    rows = raw.select(*[(F.coalesce(*c) if c else F.lit(None).cast("string")).alias(t) for t, c in known.items()])
    rows = rows.withColumn("sex", F.when(F.col("sex").isNotNull(), norm_sex(F.col("sex"))))
    out = rows.groupBy("sample_id").agg(F.array_sort(F.collect_set("path")).alias("files"), *[F.max(c).alias(c) for c in ("sex", "father_id", "mother_id")])
    odd = rows.groupBy("sample_id").agg(*[F.count_distinct(c).alias(c) for c in ("sex", "father_id", "mother_id")])
    return out, odd.where("sex > 1 or father_id > 1 or mother_id > 1").select("sample_id")


def read_paf(spark: SparkSession, path, min_mapq: int = 0) -> DataFrame:
    """Primary alignments (tag tp:A:P or tp:A:I, or untagged) of some mapping quality."""
    tags = F.filter(F.split("value", "\t"), lambda t, i: (i >= 12) & t.startswith("tp:A:"))
    primary = (F.size(tags) == 0) | F.exists(tags, lambda t: t.isin("tp:A:P", "tp:A:I"))
    long = lambda i: _cell(i).try_cast("long")
    rows = lines(spark, path).where(primary)
    out = rows.select(_cell(0).alias("qname"), long(1).alias("qlen"), _cell(5).alias("tname"), long(6).alias("tlen"), long(7).alias("tstart"), long(8).alias("tend"), long(11).alias("mapq"))
    return out.where(F.col("mapq") >= min_mapq)


def read_genes(spark: SparkSession, path, genes: Sequence[str] | None = None) -> DataFrame:
    """Gene rows of a GTF: chrom, start (0-based), end, strand, gene_id, gene_name."""
    attribute = lambda k: F.nullif(F.regexp_extract(_cell(8), f'{k} "([^"]*)"', 1), F.lit(""))
    rows = lines(spark, path).where(~F.col("value").startswith("#") & (_cell(2) == "gene"))
    out = rows.select(_cell(0).alias("chrom"), (_cell(3).cast("long") - 1).alias("start"), _cell(4).cast("long").alias("end"), _cell(6).alias("strand"), attribute("gene_id").alias("gene_id"), attribute("gene_name").alias("gene_name"))
    return out.where(F.col("gene_name").isin(*genes)) if genes else out


def read_paths(spark: SparkSession, path) -> DataFrame:
    """Path and walk lines of a graph: sample, haplotype, contig."""
    name = F.split(_cell(1), "#")
    walk = _cell(0) == "W"
    rows = lines(spark, path).where(_cell(0).isin("P", "W"))
    return rows.select(
        F.when(walk, _cell(1)).otherwise(F.get(name, 0)).alias("sample_id"), F.when(walk, _cell(2)).otherwise(F.coalesce(F.get(name, 1), F.lit("0"))).alias("haplotype"), F.when(walk, _cell(3)).otherwise(F.coalesce(F.get(name, 2), F.get(name, 0))).alias("contig")
    )


def read_sacct(spark: SparkSession, path) -> DataFrame:
    """Scheduler accounting (|-separated with a header) with typed columns."""
    raw = spark.read.csv(path, header=True, sep="|")
    cpus = F.col("AllocCPUS").try_cast("int")
    return raw.select(F.col("JobID").alias("job_id"), F.col("State").alias("state"), cpus.alias("alloc_cpus"), seconds(F.col("Elapsed")).alias("elapsed_s"), megabytes(F.col("ReqMem"), cpus).alias("req_mb"), megabytes(F.col("MaxRSS")).alias("max_rss_mb"))


def read_catalog(spark: SparkSession, path) -> DataFrame:
    """Repeat catalogue (BED with ID=...;MOTIFS=... in the 4th column): named loci are those whose id is no position."""
    from ..functions.expressions import is_named

    bed = read_bed(spark, path, ["info"])
    m = mapped(F.col("info"))
    return bed.select("chrom", "start", "end", m["ID"].alias("trid"), F.split(m["MOTIFS"], ",").alias("motifs")).withColumn("named", is_named(F.col("trid")))


#: State tables and their columns.
STATE = {
    "samples": "sample_id string, sex string, father_id string, mother_id string",
    "inputs": "sample_id string, path string, kind string, bytes bigint",
    "cohorts": "cohort_id string, name string, created_at timestamp",
    "members": "cohort_id string, sample_id string, position int",
    "runs": "run_id bigint, subject_id bigint, stage string, status string, attempt int, started_at timestamp",
    "events": EVENT_SCHEMA,
}


def load_state(spark: SparkSession, folder: str, tables: Sequence[str] = tuple(STATE)) -> dict[str, DataFrame]:
    return {t: spark.read.schema(STATE[t]).parquet(f"{folder}/{t}.parquet") for t in tables}
