"""Queries of sources, sinks and streams: tables are written as text by the query and scanned back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import frequency, identity, repeats
from ..sources import sinks, text as src
from ..streaming import events as streams
from .bindings import Bound, query
from .saving import kept_calls, saver


def _text(b: Bound, name: str, rows, *header: str) -> str:
    """Rows of one text column, written under the scratch folder, after header lines in a first file."""
    path = f"{b.scratch}/{name}"
    if header:
        b.spark.range(1).select(F.explode(F.array(*[F.lit(h) for h in header])).alias("value")).coalesce(1).write.mode("append").text(path)
    rows.toDF("value").write.mode("append").text(path)
    return path


def _tab(*columns):
    return F.concat_ws("\t", *[F.col(c).cast("string") if isinstance(c, str) else c for c in columns])


@query("src01", "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, '' AS note FROM {part}")
def src01(b: Bound):
    path = f"{b.scratch}/table.tsv"
    body = b.part.select(_tab("p_partkey", "p_name").alias("value"))
    head = b.spark.range(1).select(F.explode(F.array(F.lit("## made"), F.lit("#id\tname\tnote"))).alias("value"))
    head.coalesce(1).write.text(f"{path}/a")
    body.write.text(f"{path}/b")
    return src.read_tsv(b.spark, [f"{path}/a", f"{path}/b"])


def _vcf(b: Bound):
    members = ["m1", "m2", "m3"]
    gt = lambda k: F.when(F.col("site_id") % k == 0, "0/1:7").when(F.col("site_id") % k == 1, "./.").otherwise("0/0:3")
    info = F.concat(F.lit("SVTYPE="), F.col("svtype"), F.lit(";SVLEN="), F.col("svlen").cast("string"), F.lit(";IMPRECISE"))
    body = b.sites.select(_tab("chrom", "pos", "site_id", F.lit("N"), F.concat(F.lit("<"), F.col("svtype"), F.lit(">")), F.lit("."), "filter", info, F.lit("GT:DP"), gt(3), gt(4), gt(5)).alias("value"))
    return _text(b, "sites.vcf", body, "##fileformat=VCFv4.2", "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *members]))


@query("src02", "SELECT site_id AS id, chrom, pos, svtype AS kind, CAST(svlen AS BIGINT) AS len, filter FROM {sites}")
def src02(b: Bound):
    s = src.read_vcf_sites(b.spark, _vcf(b))
    return s.select(F.col("id").cast("long").alias("id"), "chrom", "pos", F.col("info")["SVTYPE"].alias("kind"), F.col("info")["SVLEN"].cast("long").alias("len"), F.array_join("filters", ";").alias("filter"))


@query("src03", "SELECT site_id AS id, m AS sample_id, CASE WHEN site_id % k = 0 THEN '0/1' WHEN site_id % k = 1 THEN './.' ELSE '0/0' END AS gt FROM {sites}, (VALUES ('m1', 3), ('m3', 5)) v(m, k)")
def src03(b: Bound):
    rows, _ = src.read_vcf_genotypes(b.spark, _vcf(b), ["m3", "m1", "m9"])
    return rows.select(F.col("id").cast("long").alias("id"), "sample_id", "gt")


@query("src04", "SELECT site_id, pos, CAST(svlen AS BIGINT) AS len FROM {sites} WHERE chrom = 'chr3' AND pos >= 100000 AND pos < 800000 AND svtype = 'DEL'")
def src04(b: Bound):
    sites = saver(b)(b.sites, "sites")
    return src.vcf_query(sites, {"site_id": F.col("site_id"), "pos": F.col("pos"), "len": F.col("svlen").cast("long")}, "chr3", 100_000, 800_000, F.col("svtype") == "DEL")


@query("src05", "SELECT chrom, start_pos AS start, end_pos AS \"end\", region_label AS name FROM {regions} WHERE region_id % 7 <> 0")
def src05(b: Bound):
    end = F.when(F.col("region_id") % 7 == 0, F.col("start_pos")).otherwise(F.col("end_pos"))
    path = _text(b, "regions.bed", b.regions.select(_tab("chrom", "start_pos", end, "region_label")), "track name=x", "# a comment", "chr1\tx\ty\tbad")
    return src.read_bed(b.spark, path, ["name"])


@query("src06", "SELECT svtype AS name, count(*) AS n FROM {sites} GROUP BY 1")
def src06(b: Bound):
    sn = b.sites.groupBy("svtype").agg(F.count("*").alias("n")).select(_tab(F.lit("SN"), "svtype", "n").alias("value"))
    st = b.sites.groupBy("chrom").agg(F.count("*").alias("n")).select(_tab(F.lit("ST"), "chrom", "n").alias("value"))
    path = _text(b, "report", sn.unionByName(st))
    return src.read_sections(b.spark, path, {"SN": [("name", "string"), ("n", "bigint")], "ST": [("chrom", "string"), ("n", "bigint")]})["SN"].drop("file")


@query("src07", "SELECT CAST((SELECT count(*) FROM {sites}) AS VARCHAR) AS sites, CAST((SELECT count(*) FROM {members}) AS VARCHAR) AS members")
def src07(b: Bound):
    rows = b.sites.agg(F.count("*").alias("n")).select(_tab(F.lit("sites"), "n").alias("value")).unionByName(b.members.agg(F.count("*").alias("n")).select(_tab(F.lit("members"), "n").alias("value")))
    return src.read_kv(b.spark, _text(b, "kv", rows.coalesce(1)), ["sites", "members"]).drop("file")


@query("src08", "SELECT CAST(user_id AS VARCHAR) AS sample_id, " + ", ".join(f"round(max(CASE WHEN event_type = '{e}' THEN m END), 6) AS {e}_percent, max(CASE WHEN event_type = '{e}' THEN n END) AS {e}_n" for e in ("view", "click")) + " FROM (SELECT user_id, event_type, avg(value) AS m, count(*) AS n FROM {events} GROUP BY 1, 2) t GROUP BY 1")
def src08(b: Bound):
    rows = b.events.groupBy("user_id", "event_type").agg(F.avg("value").alias("m"), F.count("*").alias("n"))
    out = src.read_label_summary(b.spark, _text(b, "labels", rows.select(_tab("user_id", "event_type", "m", "n"))), ["view", "click"])
    return out.withColumns({f"{e}_percent": F.round(f"{e}_percent", 6) for e in ("view", "click")})


@query("src09", "SELECT batch AS sample, sex AS region, count(*) AS cn, round(avg(depth_mean), 4) AS depth FROM {members} WHERE sex <> '' GROUP BY 1, 2")
def src09(b: Bound):
    per = b.members.where("sex <> ''").groupBy("batch", "sex").agg(F.count("*").alias("cn"), F.avg("depth_mean").alias("depth"))
    docs = per.groupBy(F.col("batch").alias("sample")).agg(F.map_from_entries(F.collect_list(F.struct("sex", F.struct("cn", "depth")))).alias("regions"))
    path = f"{b.scratch}/docs.json"
    docs.write.json(path)
    out = src.read_json_map(b.spark, path, "sample int, regions map<string, struct<cn: bigint, depth: double>>", "regions", "region", multi_line=False)
    return out.withColumn("depth", F.round("depth", 4))


@query("src10", "SELECT CAST(user_id AS VARCHAR) AS source, min(epoch(ts)) AS started, count(CASE WHEN event_type = 'click' THEN 1 END) AS retries, count(CASE WHEN event_type = 'signup' THEN 1 END) > 0 AS cached, CASE WHEN count(CASE WHEN event_type = 'purchase' THEN 1 END) > 0 THEN 'done' WHEN count(CASE WHEN event_type = 'error' THEN 1 END) > 0 THEN 'failed' ELSE 'open' END AS outcome FROM {events} GROUP BY 1")
def src10(b: Bound):
    said = F.when(F.col("event_type") == "click", "retry 1").when(F.col("event_type") == "signup", "cached").when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "error", "failed").otherwise("setup")
    path = f"{b.scratch}/task.jsonl"
    b.events.select(F.col("user_id").cast("string").alias("source"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("ts"), said.alias("message")).write.json(path)
    return src.read_task_log(b.spark, path).select("source", "started", "retries", "cached", "outcome")


def _event_files(b: Bound) -> str:
    path = f"{b.scratch}/events.jsonl"
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    name = F.when(F.col("event_type") == "view", "submit.progress").otherwise(F.col("event_type"))
    detail = F.to_json(F.struct((F.col("event_id") % 100).alias("done"), F.lit(100).alias("total")))
    b.events.select(name.alias("event"), level.alias("level"), F.col("user_id").alias("run_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), detail.alias("detail")).repartition(4).write.json(path)
    return path


_COUNTS = "SELECT CASE WHEN event_type = 'view' THEN 'submit.progress' ELSE event_type END AS event, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level, count(*) AS count FROM {events} GROUP BY 1, 2"
_SERIES = "SELECT user_id AS run_id, ts, event_id % 100 AS done, CAST(100 AS BIGINT) AS total, round((event_id % 100) / 100.0, 6)::DOUBLE AS share FROM {events} WHERE event_type = 'view'"


@query("src11", _COUNTS)
def src11(b: Bound):
    return streams.counts(src.read_events(b.spark, _event_files(b)))


@query("src12", "SELECT CAST(o_custkey AS VARCHAR) AS sample_id, string_agg(DISTINCT concat('f', o_orderkey % 10), ',' ORDER BY concat('f', o_orderkey % 10)) AS files, max(CASE WHEN o_custkey % 2 = 0 THEN 'XX' ELSE 'XY' END) AS sex FROM {orders} GROUP BY 1")
def src12(b: Bound):
    path = f"{b.scratch}/manifest.csv"
    sex = F.when(F.col("o_custkey") % 2 == 0, "female").otherwise("1")
    b.orders.select(F.col("o_custkey").alias("Sample"), F.concat(F.lit("f"), (F.col("o_orderkey") % 10).cast("string")).alias("file"), sex.alias("Gender")).write.csv(path, header=True, sep=";")
    aliases = {"sample_id": ["sample_id", "Sample"], "path": ["path", "file"], "sex": ["sex", "Gender"], "father_id": ["father_id"], "mother_id": ["mother_id"]}
    return src.read_manifest(b.spark, path, aliases, ";")[0].select("sample_id", F.array_join("files", ",").alias("files"), "sex")


@query("src13", "SELECT CAST(l_partkey AS VARCHAR) AS qname, CAST(l_linenumber * 1000 AS BIGINT) AS tstart, CAST(l_suppkey % 61 AS BIGINT) AS mapq FROM {lineitem} WHERE l_suppkey % 61 >= 20 AND l_linenumber % 3 <> 0")
def src13(b: Bound):
    tag = F.when(F.col("l_linenumber") % 3 == 0, "tp:A:S").when(F.col("l_linenumber") % 3 == 1, "tp:A:P").otherwise("NM:i:0")
    rows = b.lineitem.select(_tab("l_partkey", F.lit("100"), F.lit("0"), F.lit("9"), F.lit("+"), F.lit("chr1"), F.lit("5000"), F.col("l_linenumber") * 1000, F.col("l_linenumber") * 1000 + 9, F.lit("9"), F.lit("9"), F.col("l_suppkey") % 61, tag))
    return src.read_paf(b.spark, _text(b, "a.paf", rows), 20).select("qname", "tstart", "mapq")


@query("src14", "SELECT chrom, start_pos AS start, end_pos AS \"end\", concat('G', region_id) AS gene_id, region_label AS gene_name FROM {regions} WHERE region_label IN ('Brand#3', 'Brand#5')")
def src14(b: Bound):
    attributes = F.concat(F.lit('gene_id "G'), F.col("region_id").cast("string"), F.lit('"; gene_name "'), F.col("region_label"), F.lit('";'))
    row = lambda kind: b.regions.select(_tab("chrom", F.lit("x"), F.lit(kind), F.col("start_pos") + 1, "end_pos", F.lit("."), F.lit("+"), F.lit("."), attributes).alias("value"))
    out = src.read_genes(b.spark, _text(b, "a.gtf", row("gene").unionByName(row("exon")), "# gtf"), ["Brand#3", "Brand#5"])
    return out.drop("strand")


@query("src15", "SELECT CAST(sample_id AS VARCHAR) AS sample_id, CASE WHEN sample_id % 2 = 0 THEN '1' ELSE '2' END AS haplotype, concat('ctg', batch) AS contig FROM {members}")
def src15(b: Bound):
    contig, sample = F.concat(F.lit("ctg"), F.col("batch").cast("string")), F.col("sample_id").cast("string")
    walk = _tab(F.lit("W"), sample, F.lit("1"), contig, F.lit("0"), F.lit("9"), F.lit(">1"))
    path_ = _tab(F.lit("P"), F.concat_ws("#", sample, F.lit("2"), contig), F.lit("1+"))
    rows = b.members.select(F.when(F.col("sample_id") % 2 == 0, walk).otherwise(path_))
    return src.read_paths(b.spark, _text(b, "a.gfa", rows, "H\tVN:Z:1.1"))


@query("src16", "SELECT CAST(l_orderkey AS VARCHAR) AS job_id, CAST(l_linenumber AS INTEGER) AS alloc_cpus, CAST(l_linenumber * 3600 + 61 AS DOUBLE) AS elapsed_s, CAST(l_linenumber * 2048 AS DOUBLE) AS req_mb, CAST(l_suppkey AS DOUBLE) AS max_rss_mb FROM {lineitem}")
def src16(b: Bound):
    path = f"{b.scratch}/sacct.txt"
    n = F.col("l_linenumber")
    b.lineitem.select(
        F.col("l_orderkey").alias("JobID"), F.lit("COMPLETED").alias("State"), n.alias("AllocCPUS"), F.format_string("%02d:01:01", n).alias("Elapsed"), F.lit("2Gc").alias("ReqMem"), F.concat(F.col("l_suppkey").cast("string"), F.lit("M")).alias("MaxRSS")
    ).write.csv(path, header=True, sep="|")
    return src.read_sacct(b.spark, path).drop("state")


@query("src17", "SELECT CASE WHEN region_id % 3 = 0 THEN concat('DIS', region_id) ELSE concat(chrom, '_', start_pos, '_', end_pos) END AS trid, region_id % 3 = 0 AS named, CAST(2 AS INTEGER) AS n_motifs FROM {regions}")
def src17(b: Bound):
    trid = F.when(F.col("region_id") % 3 == 0, F.concat(F.lit("DIS"), F.col("region_id").cast("string"))).otherwise(F.concat_ws("_", "chrom", F.col("start_pos").cast("string"), F.col("end_pos").cast("string")))
    rows = b.regions.select(_tab("chrom", "start_pos", "end_pos", F.concat(F.lit("ID="), trid, F.lit(";MOTIFS=CAG,CTG"))))
    return src.read_catalog(b.spark, _text(b, "catalog.bed", rows)).select("trid", "named", F.size("motifs").alias("n_motifs"))


@query("src18", "SELECT stage, count(*) AS n FROM {runs} GROUP BY 1")
def src18(b: Bound):
    b.runs.withColumn("attempt", F.col("attempt").cast("int")).write.parquet(f"{b.scratch}/state/runs.parquet")
    return src.load_state(b.spark, f"{b.scratch}/state", ["runs"])["runs"].groupBy("stage").agg(F.count("*").alias("n"))


@query("snk01", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CASE WHEN p_size % 5 = 0 THEN '' ELSE p_name END AS name, CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END AS big, concat(p_size, ',', p_partkey) AS list FROM {part}")
def snk01(b: Bound):
    rows = b.part.select("p_partkey", F.when(F.col("p_size") % 5 != 0, F.col("p_name")).alias("name"), (F.col("p_size") > 25).alias("big"), F.array(F.col("p_size").cast("long"), "p_partkey").alias("list"))
    sinks.write_tsv(rows, f"{b.scratch}/out.tsv", comment="parts")
    return b.spark.read.csv(f"{b.scratch}/out.tsv", sep="\t", header=True, schema="p_partkey string, name string, big string, list string", nullValue="\x00", emptyValue="").withColumn("name", F.coalesce("name", F.lit("")))


_FREQ = """SELECT count(*) FROM (SELECT DISTINCT k, s, v FROM (SELECT stage AS v, unnest(['all', 'sex', 'ancestry']) AS k, unnest(['all', sex, ancestry]) AS s FROM {runs} JOIN {members} ON sample_id = subject_id WHERE status <> 'running') t WHERE v IS NOT NULL) u"""


@query("snk02", f"""SELECT 'members' AS domain, 'members' AS file, count(*) AS rows, '' AS note, sum(length(concat_ws(chr(9), sample_id, sex, ancestry, batch)) + 1) AS bytes FROM {{members}} UNION ALL SELECT 'coverage', 'coverage', count(*), '', NULL FROM {{members}} UNION ALL SELECT 'variants', 'variants', count(DISTINCT (sample_id, svtype)), '', NULL FROM {{genotypes}} JOIN {{sites}} USING (site_id)
 UNION ALL SELECT 'phasing', '', 0, 'no member has phase blocks', 0 UNION ALL SELECT 'cn', 'cn', count(*), '', NULL FROM {{regions}} UNION ALL SELECT 'pgx', 'pgx', count(*), '', NULL FROM {{runs}} UNION ALL SELECT 'pgx', 'pgx.freq', ({_FREQ}), '', NULL UNION ALL SELECT 'hla', '', 0, 'no data', 0 UNION ALL SELECT 'mito', 'mito', count(*), '', NULL FROM {{sites}} WHERE chrom = 'chrM'
 UNION ALL SELECT 'identity', 'identity.pairs', count(*), '', NULL FROM {{pairs}} UNION ALL SELECT 'identity', 'identity.members', count(DISTINCT sample_id), '', NULL FROM {{genotypes}} UNION ALL SELECT 'tr', 'tr.spectrum', count(*), '', NULL FROM (SELECT DISTINCT locus_id, al FROM (SELECT locus_id, al1 AS al FROM {{tr_alleles}} UNION ALL SELECT locus_id, al2 FROM {{tr_alleles}}) q) q UNION ALL SELECT 'tr', 'tr.loci', count(*), '', NULL FROM {{loci}}
 UNION ALL SELECT 'methyl', 'methyl.samples', count(*), '', NULL FROM {{methyl}} UNION ALL SELECT 'mqtl', 'mqtl.islands', count(*), '', NULL FROM {{regions}} UNION ALL SELECT 'graph_gt', 'graph_gt.members', count(DISTINCT (sample_id, svtype)), '', NULL FROM {{genotypes}} JOIN {{sites}} USING (site_id) UNION ALL SELECT 'graph_gt', 'graph_gt.skipped', count(*), '', NULL FROM {{sites}} WHERE filter <> 'PASS' UNION ALL SELECT 'assembly', '', 0, 'no member has an assembly', 0""")
def snk02(b: Bound):
    """All domains that the tables can fill, each with its files; bytes are compared where both engines write alike."""
    calls = kept_calls(b, "dp")
    typed = calls.join(b.sites.select("site_id", "svtype"), "site_id")
    runs = b.runs.join(b.members, F.col("subject_id") == F.col("sample_id")).withColumn("value", F.when(F.col("status") != "running", F.col("stage")))
    own = frequency.member_counts(typed)
    domains = {
        "members": {"": b.members.select("sample_id", "sex", "ancestry", "batch")},
        "coverage": {"": b.members.select("sample_id", "depth_mean")},
        "variants": {"": own},
        "phasing": "no member has phase blocks",
        "cn": {"": b.regions.select("region_id", "chrom", "region_label")},
        "pgx": {"": b.runs.select("run_id", "subject_id", "stage", "status"), "freq": frequency.freq_table(runs, "value", {"sex": "sex", "ancestry": "ancestry"}, [])},
        "mito": {"": b.sites.where("chrom = 'chrM'")},
        "identity": {"pairs": identity.relatedness(calls), "members": calls.select("sample_id").distinct()},
        "tr": {"spectrum": repeats.allele_spectrum(repeats.long_alleles(b.tr_alleles)), "loci": b.loci},
        "methyl": {"samples": b.methyl},
        "mqtl": {"islands": b.regions},
        "graph_gt": {"members": own, "skipped": b.sites.where("filter <> 'PASS'")},
        "assembly": "no member has an assembly",
    }
    out = sinks.export(b.spark, domains, f"{b.scratch}/export", compression="gzip")  # pairs are many more than genotypes
    return out.select("domain", "file", "rows", "note", F.when((F.col("file") == "members") | (F.col("note") != ""), F.col("bytes")).alias("bytes"))


@query("snk03", "SELECT sample_id, count(*) AS n FROM {genotypes} WHERE alt > 0 GROUP BY 1")
def snk03(b: Bound):
    sinks.write_by_sample(kept_calls(b, "dp"), f"{b.scratch}/by_sample", False)
    out = b.spark.read.schema("site_id long, alt int, called int, dp long, sample_id long").parquet(f"{b.scratch}/by_sample")
    return out.groupBy(F.col("sample_id").cast("long").alias("sample_id")).agg(F.count("*").alias("n"))


_SHARDS = "(SELECT chrom, k AS shard_no, k * 200000 AS b_start, (k + 1) * 200000 AS b_end FROM (SELECT chrom, unnest(range(0, CAST(floor((greatest(max(start_pos) + 1, max(end_pos)) - 1) / 200000) AS BIGINT) + 1)) AS k FROM {regions} GROUP BY chrom) c)"


@query("snk04", f"SELECT chrom, CAST(shard_no AS BIGINT) AS shard_no, count(*) AS n, count(CASE WHEN start_pos >= b_start THEN 1 END) AS n_start FROM (SELECT s.*, start_pos, end_pos FROM {{regions}} r JOIN {_SHARDS} s USING (chrom) WHERE start_pos < b_end AND b_start < end_pos) t GROUP BY 1, 2")
def snk04(b: Bound):
    last = F.floor((F.greatest(F.max("start_pos") + 1, F.max("end_pos")) - 1) / 200000)
    shards = b.regions.groupBy("chrom").agg(last.alias("last")).select("chrom", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("k"))
    shards = shards.select("chrom", F.concat_ws("_", "chrom", F.col("k").cast("string")).alias("shard"), (F.col("k") * 200000).alias("b_start"), ((F.col("k") + 1) * 200000).alias("b_end"))
    rows = b.regions.select("region_id", "chrom", F.col("start_pos").alias("a_start"), F.col("end_pos").alias("a_end"))
    sinks.write_by_shard(rows, shards, f"{b.scratch}/shards")
    no = F.element_at(F.split("shard", "_"), -1).cast("long")
    return b.spark.read.parquet(f"{b.scratch}/shards").groupBy("chrom", no.alias("shard_no")).agg(F.count("*").alias("n"), F.count_if(F.col("a_start") >= no * 200000).alias("n_start"))


@query("snk05", "SELECT site_id, chrom, pos FROM {sites}")
def snk05(b: Bound):
    wide = b.sites.select("site_id", "chrom", "pos").withColumn("genotypes", F.array(F.lit("0/1")))
    return sinks.sites_only(wide)


@query("snk06", """WITH m AS (SELECT sample_id, position FROM {members}), c AS (SELECT s.site_id, m.position, CASE WHEN g.sample_id IS NULL THEN './.:.' ELSE concat(CASE WHEN called = 0 THEN './.' WHEN called = 1 THEN concat('./', alt) WHEN alt >= 2 THEN '1/1' WHEN alt = 1 THEN '0/1' ELSE '0/0' END, ':', dp) END AS cell
 FROM {sites} s CROSS JOIN m LEFT JOIN {genotypes} g ON g.site_id = s.site_id AND g.sample_id = m.sample_id) SELECT s.site_id, concat(chrom, chr(9), pos, chr(9), s.site_id, chr(9), 'N', chr(9), '<', svtype, '>', chr(9), '.', chr(9), 'PASS', chr(9), '.', chr(9), 'GT:DP', chr(9), string_agg(cell, chr(9) ORDER BY position)) AS value FROM {sites} s JOIN c USING (site_id) GROUP BY s.site_id, chrom, pos, svtype""")
def snk06(b: Bound):
    body = sinks.vcf_lines(b.sites, b.genotypes, b.members)
    sinks.write_vcf(body, f"{b.scratch}/out.vcf", b.members.select("sample_id", "position"))
    back = src.lines(b.spark, f"{b.scratch}/out.vcf").where(~F.col("value").startswith("#"))
    site = F.substring_index(F.substring_index("value", "\t", 3), "\t", -1)  # a line is not taken apart for its third field
    return back.select(site.cast("long").alias("site_id"), "value")


@query("snk07", "SELECT 'cohort' AS subject, CAST((SELECT count(*) FROM {members}) AS BIGINT) AS members")
def snk07(b: Bound):
    sinks.write_manifest(b.spark, f"{b.scratch}/provenance", "cohort", b.members.count(), {"strandline": "1"}, 0.0)
    return b.spark.read.json(f"{b.scratch}/provenance", schema="subject string, members bigint")


@query("str01", "SELECT CASE WHEN event_type = 'view' THEN 'submit.progress' ELSE event_type END AS event, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level, user_id AS run_id, count(*) AS count FROM {events} GROUP BY 1, 2, 3")
def str01(b: Bound):
    stream = streams.counts(streams.event_stream(b.spark, _event_files(b), 1), "run_id")
    streams.run_available(stream, "complete", f"{b.scratch}/counts", f"{b.scratch}/state-counts")
    return b.spark.read.parquet(f"{b.scratch}/counts")


@query("str01_windows", "SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, CASE WHEN event_type = 'view' THEN 'submit.progress' ELSE event_type END AS event, count(*) AS count FROM {events} GROUP BY 1, 2")
def str01_windows(b: Bound):
    stream = streams.windowed_counts(streams.event_stream(b.spark, _event_files(b), 1), "1 day", "2 days")
    streams.run_available(stream, "complete", f"{b.scratch}/windows", f"{b.scratch}/state-windows")
    return b.spark.read.parquet(f"{b.scratch}/windows")


@query("str02", f"SELECT run_id, ts, done, total, share, round(CASE WHEN done > d0 THEN (total - done) * ((epoch_us(ts) - epoch_us(t0)) / 1e6) / (done - d0) END, 3) AS eta_seconds FROM (SELECT *, first_value(done) OVER w AS d0, first_value(ts) OVER w AS t0 FROM ({_SERIES}) s WINDOW w AS (PARTITION BY run_id ORDER BY ts, done ROWS BETWEEN {streams.POINTS} PRECEDING AND CURRENT ROW)) t")
def str02(b: Bound):
    stream = streams.progress_with_eta(streams.progress_series(streams.event_stream(b.spark, _event_files(b))))
    streams.run_available(stream, "append", f"{b.scratch}/series", f"{b.scratch}/state-series")
    return b.spark.read.parquet(f"{b.scratch}/series").withColumns({"share": F.round("share", 6), "eta_seconds": F.round("eta_seconds", 3)})
