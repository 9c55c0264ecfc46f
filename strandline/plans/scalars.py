"""Queries of projections and scalar functions over texts made from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expressions as X
from .bindings import Bound, query

_GT = "CASE l_partkey % 7 WHEN 0 THEN '0/0' WHEN 1 THEN '0|1' WHEN 2 THEN '1/1' WHEN 3 THEN './.' WHEN 4 THEN '1|.' WHEN 5 THEN '2|1' ELSE '0/2:35' END"


def _gt(b: Bound):
    return b.lineitem.select("l_orderkey", "l_linenumber", F.expr(_GT).alias("gt"))


def _case(values: dict[str, object], kind: str) -> str:
    return "CASE gt " + " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in values.items()) + f" END::{kind}"


_G = f"SELECT l_orderkey, l_linenumber, {_GT} AS gt FROM {{lineitem}}"


@query("prj01", "SELECT site_id, CASE WHEN regexp_matches(chrom, '^chr[0-9]+$') THEN 'autosome' WHEN chrom IN ('chrX', 'chrY', 'chrM') THEN chrom ELSE 'other' END AS cls FROM {sites}")
def prj01(b: Bound):
    return b.sites.select("site_id", X.contig_class(F.col("chrom")).alias("cls"))


@query("prj02", "SELECT DISTINCT chrom, coalesce(try_cast(substr(chrom, 4) AS INTEGER), 0) AS number, try_cast(substr(chrom, 4) AS INTEGER) IS NULL AS named FROM {sites}")
def prj02(b: Bound):
    k = X.chrom_key(F.col("chrom"))
    return b.sites.select("chrom", k["number"].alias("number"), k["named"].alias("named")).distinct()


_ALLELES = "SELECT p_partkey, concat('A', repeat('C', CAST(p_size % 3 AS INT))) AS ref, concat('A', repeat('G', CAST(p_size % 4 AS INT))) AS a1, concat('A', repeat('T', CAST(p_partkey % 70 AS INT))) AS a2 FROM {part}"
_KIND = "CASE WHEN length({a}) = length(ref) AND length(ref) = 1 THEN 'SNV' WHEN length({a}) = length(ref) THEN 'MNV' WHEN abs(length({a}) - length(ref)) < 50 THEN 'INDEL' WHEN length({a}) > length(ref) THEN 'INS' ELSE 'DEL' END"


@query("prj03", f"SELECT p_partkey, CASE WHEN {_KIND.replace('{a}', 'a1')} = {_KIND.replace('{a}', 'a2')} THEN {_KIND.replace('{a}', 'a1')} ELSE 'MIXED' END AS kind FROM ({_ALLELES}) t")
def prj03(b: Bound):
    rows = b.spark.sql(_ALLELES, part=b.part)
    return rows.select("p_partkey", X.variant_kind(F.col("ref"), F.array("a1", "a2")).alias("kind"))


@query("prj04", """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN CASE WHEN p_size % 2 = 0 THEN 'INV' ELSE 'INS' END ELSE CASE WHEN p_partkey % 70 = 0 THEN 'SNV' WHEN p_partkey % 70 < 50 THEN 'INDEL' ELSE 'INS' END END AS kind,
 CAST(CASE WHEN p_size % 3 = 0 THEN p_size ELSE p_partkey % 70 END AS INTEGER) AS size FROM {part}""")
def prj04(b: Bound):
    symbolic = F.col("p_size") % 3 == 0
    alt = F.when(symbolic, F.when(F.col("p_size") % 2 == 0, "<INV>").otherwise("<DUP:TANDEM>")).otherwise(F.concat(F.lit("A"), F.repeat(F.lit("T"), (F.col("p_partkey") % 70).cast("int"))))
    k = X.call_kind(F.lit("A"), F.array(alt), F.array().cast("array<string>"), F.array((-F.col("p_size")).cast("int")))
    return b.part.select("p_partkey", k["kind"].alias("kind"), k["size"].alias("size"))


@query("prj05", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 AND p_size % 3 = 0 THEN 'BOTH' WHEN p_size % 2 = 0 THEN 'ASM_UNRELIABLE' WHEN p_size % 3 = 0 THEN 'OTHER' ELSE 'PASS' END AS cls FROM {part}")
def prj05(b: Bound):
    names = F.array_compact(F.array(F.when(F.col("p_size") % 2 == 0, "ASM_UNRELIABLE"), F.when(F.col("p_size") % 3 == 0, "LowQual"), F.lit("PASS")))
    return b.part.select("p_partkey", X.filter_class(names).alias("cls"))


@query("prj06", "SELECT site_id, CASE WHEN svlen < 50 THEN '<50' WHEN svlen < 100 THEN '50-99' WHEN svlen < 500 THEN '100-499' WHEN svlen < 1000 THEN '500-999' WHEN svlen < 10000 THEN '1k-9.9k' ELSE '>=10k' END AS bin FROM {sites}")
def prj06(b: Bound):
    return b.sites.select("site_id", X.binned(F.col("svlen"), "sv_size").alias("bin"))


@query("prj07", f"""SELECT l_orderkey, l_linenumber, {_case({'0/0': 0, '0|1': 1, '1/1': 2, './.': 0, '1|.': 1, '2|1': 2, '0/2:35': 1}, 'BIGINT')} AS alt, {_case({'0/0': 2, '0|1': 2, '1/1': 2, './.': 0, '1|.': 1, '2|1': 2, '0/2:35': 2}, 'BIGINT')} AS called,
 {_case({'0/0': 'hom_ref', '0|1': 'het', '1/1': 'hom_alt', './.': 'missing', '1|.': 'hom_alt', '2|1': 'het', '0/2:35': 'het'}, 'VARCHAR')} AS zygosity FROM ({_G}) t""")
def prj07(b: Bound):
    gt = F.col("gt")
    return _gt(b).select("l_orderkey", "l_linenumber", X.gt_alt(gt).alias("alt"), X.gt_called(gt).alias("called"), X.zygosity(gt).alias("zygosity"))


@query("prj08", f"SELECT l_orderkey, l_linenumber, {_case({'0/0': '0,0', '0|1': '0,1', '1/1': '1,1', '2|1': '1,2', '0/2:35': '0,2'}, 'VARCHAR')} AS alleles FROM ({_G}) t")
def prj08(b: Bound):
    return _gt(b).select("l_orderkey", "l_linenumber", F.array_join(X.order_free(F.col("gt")), ",").alias("alleles"))


@query("prj09", f"SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 2 = 0 THEN replace(gt, '|', '/') ELSE gt END AS gt FROM ({_G}) t")
def prj09(b: Bound):
    return _gt(b).withColumn("gt", X.unphased(F.col("gt"), F.col("l_orderkey") % 2 == 0))


@query("prj11", "SELECT p_partkey, unnest(range(1, CAST(1 + p_size % 3 AS BIGINT) + 1)) AS allele FROM {part}")
def prj11(b: Bound):
    alts = F.transform(F.sequence(F.lit(0), (F.col("p_size") % 3).cast("int")), lambda i: F.concat(F.lit("A"), i.cast("string")))
    return b.part.select("p_partkey", F.posexplode(alts).alias("i", "alt")).select("p_partkey", (F.col("i") + 1).cast("long").alias("allele"))


@query("prj13", f"SELECT p_partkey, concat('chr1-', p_partkey, '-', CASE WHEN length(a2) > length(ref) THEN 'INS' ELSE 'DEL' END, '-', abs(length(a2) - length(ref)), '-', substr(sha1(concat(ref, '>', a2)), 1, 8)) AS id FROM ({_ALLELES}) t")
def prj13(b: Bound):
    rows = b.spark.sql(_ALLELES, part=b.part)
    return rows.select("p_partkey", X.allele_id(F.lit("chr1"), F.col("p_partkey"), F.col("ref"), F.col("a2")).alias("id"))


@query("prj14", "SELECT p_partkey, p_partkey % 2 = 0 AS named FROM {part}")
def prj14(b: Bound):
    trid = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("DIS_"), F.col("p_brand"))).otherwise(F.concat_ws("_", F.lit("chr7"), F.col("p_partkey").cast("string"), F.col("p_size").cast("string")))
    return b.part.select("p_partkey", X.is_named(trid).alias("named"))


@query("prj15", "SELECT DISTINCT concat('brand=', regexp_replace(p_brand, '[^A-Za-z0-9_.-]+', '_', 'g')) AS label FROM {part}")
def prj15(b: Bound):
    return b.part.select(X.label_text("brand", F.concat(F.lit(" "), F.col("p_brand"))).alias("label")).distinct()


@query("prj16", "SELECT sample_id, CASE WHEN sample_id % 4 = 0 THEN 'XY' WHEN sample_id % 4 = 1 THEN 'XX' WHEN sample_id % 4 = 2 THEN 'XX' ELSE '' END AS sex FROM {members}")
def prj16(b: Bound):
    raw = F.when(F.col("sample_id") % 4 == 0, " male").when(F.col("sample_id") % 4 == 1, "f").when(F.col("sample_id") % 4 == 2, "2").otherwise("?")
    return b.members.select("sample_id", X.norm_sex(raw).alias("sex"))


@query("prj17", "SELECT l_orderkey, l_linenumber, round(l_quantity + l_tax, 6) AS total, round(greatest(l_quantity, l_tax), 6) AS largest FROM {lineitem}")
def prj17(b: Bound):
    x = X.numbers(F.concat_ws(",", F.col("l_quantity").cast("string"), F.lit("."), F.col("l_tax").cast("string"), F.lit("NaN")))
    return b.lineitem.select("l_orderkey", "l_linenumber", F.round(X.total(x), 6).alias("total"), F.round(F.array_max(x), 6).alias("largest"))


@query("prj18", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM {events}")
def prj18(b: Bound):
    return b.events.select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))


@query("prj20", "SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 2 = 0 THEN 'x,y' ELSE 'y,x' END AS slots FROM {lineitem}")
def prj20(b: Bound):
    gt = F.when(F.col("l_partkey") % 2 == 0, "0|1").otherwise("1|0")
    return b.lineitem.select("l_orderkey", "l_linenumber", F.array_join(X.repaired_slots(gt, F.array(F.lit("x"), F.lit("y"))), ",").alias("slots"))


@query("prj21", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'exact' WHEN 1 THEN 'rotation' WHEN 2 THEN 'iupac' END AS kind FROM {part}")
def prj21(b: Bound):
    a = F.when(F.col("p_partkey") % 4 == 2, "CNG").otherwise("CAG")
    other = F.when(F.col("p_partkey") % 4 == 0, "CAG").when(F.col("p_partkey") % 4 == 1, "GCA").when(F.col("p_partkey") % 4 == 2, "TGC").otherwise("CTG")
    return b.part.select("p_partkey", X.motif_match(a, other).alias("kind"))


_MOTIF = "substr('ACGTNRYSWKMBDHVACGT', CAST({0} % 15 + 1 AS INT), CAST({1} AS INT))"
_CODES = ", ".join(f"('{x}', '{y}')" for x, y in X.IUPAC.items())


@query("prj21_lists", f"""WITH l AS (SELECT p_partkey, [{_MOTIF.format('p_partkey', '3')}, {_MOTIF.format('p_size', '2 + p_partkey % 3')}] AS path, [{_MOTIF.format('(p_size + 1)', '3')}, {_MOTIF.format('(p_partkey + p_size)', '3')}, {_MOTIF.format('p_size', '3')}] AS cat FROM {{part}}),
 codes AS (SELECT * FROM (VALUES {_CODES}) v(code, bases)), k AS (SELECT a.code AS x, b.code AS y FROM codes a JOIN codes b ON len(list_intersect(string_split(a.bases, ''), string_split(b.bases, ''))) > 0),
 u AS (SELECT p_partkey, i, path[i] AS p, j, cat[j] AS c FROM (SELECT *, unnest(range(1, 3)) AS i FROM l) t, range(1, 4) r(j)),
 o AS (SELECT DISTINCT p, c FROM u WHERE length(p) = length(c)), q AS (SELECT p, c, s, t, substr(p || p, CAST(s + t + 1 AS INT), 1) AS x, substr(c, CAST(t + 1 AS INT), 1) AS y FROM (SELECT *, unnest(range(0, length(p))) AS t FROM (SELECT *, unnest(range(0, length(p))) AS s FROM o) a) b),
 fits AS (SELECT DISTINCT p, c FROM (SELECT p, c, s FROM q LEFT JOIN k USING (x, y) GROUP BY 1, 2, 3 HAVING count(k.x) = count(*)) z),
 m AS (SELECT u.*, CASE WHEN u.p = u.c THEN 1 WHEN length(u.p) = length(u.c) AND contains(u.p || u.p, u.c) THEN 2 WHEN fits.p IS NOT NULL THEN 3 END AS rank FROM u LEFT JOIN fits ON fits.p = u.p AND fits.c = u.c),
 g AS (SELECT p_partkey, max(rank) AS worst, count(DISTINCT i) FILTER (WHERE rank IS NOT NULL) AS found FROM m GROUP BY 1), h AS (SELECT p_partkey, string_agg(c, ',' ORDER BY j) AS matched FROM (SELECT p_partkey, c, min(j) AS j FROM m WHERE rank IS NOT NULL GROUP BY 1, 2) t GROUP BY 1)
 SELECT p_partkey, coalesce(matched, '') AS matched, CASE WHEN worst IS NULL THEN 'none' ELSE (CASE WHEN found < 2 THEN 'partial:' ELSE '' END) || CASE worst WHEN 1 THEN 'exact' WHEN 2 THEN 'rotation' ELSE 'iupac' END END AS motif_match FROM g LEFT JOIN h USING (p_partkey)""")
def prj21_lists(b: Bound):
    motif = lambda at, size: F.expr(_MOTIF.format(at, size))
    path = F.array(motif("p_partkey", "3"), motif("p_size", "2 + p_partkey % 3"))
    cat = F.array(motif("(p_size + 1)", "3"), motif("(p_partkey + p_size)", "3"), motif("p_size", "3"))
    rows = b.part.select("p_partkey", path.alias("path"), cat.alias("cat")).withColumn("m", X.match_motifs(F.col("path"), F.col("cat")))
    return rows.select("p_partkey", F.array_join("m.matched", ",").alias("matched"), "m.motif_match")


@query("scl01", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_retailprice END AS x FROM {part}")
def scl01(b: Bound):
    text = F.when(F.col("p_size") % 6 == 0, "nan").when(F.col("p_size") % 3 == 0, "Infinity").otherwise(F.col("p_retailprice").cast("string"))
    return b.part.select("p_partkey", X.number(text).alias("x"))


@query("scl02", "SELECT l_orderkey, l_linenumber, regexp_replace(regexp_replace(printf('%.4f', l_discount), '0+$', ''), '\\.$', '') AS x FROM {lineitem}")
def scl02(b: Bound):
    return b.lineitem.select("l_orderkey", "l_linenumber", X.fixed(F.col("l_discount"), 4).alias("x"))


@query("scl03", "SELECT c_custkey, upper(string_split(c_name, '#')[1]) AS head, string_split(c_name, '#')[-1] AS tail FROM {customer}")
def scl03(b: Bound):
    parts = F.split("c_name", "#")
    return b.customer.select("c_custkey", F.upper(F.get(parts, 0)).alias("head"), F.element_at(parts, -1).alias("tail"))


@query("scl04", "SELECT site_id, svtype AS kind, CAST(svlen AS BIGINT) AS len FROM {sites}")
def scl04(b: Bound):
    info = F.concat(F.lit("SVTYPE="), F.col("svtype"), F.lit(";IMPRECISE;SVLEN="), F.col("svlen").cast("string"))
    m = X.mapped(info)
    return b.sites.select("site_id", m["SVTYPE"].alias("kind"), m["SVLEN"].try_cast("long").alias("len"))


@query("scl05", "SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber ELSE 0 END AS BIGINT) AS gpus FROM {lineitem}")
def scl05(b: Bound):
    tres = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("cpu=4,gres/gpu:a100="), F.col("l_linenumber").cast("string"))).otherwise("cpu=4,mem=5G")
    return b.lineitem.select("l_orderkey", "l_linenumber", X.gpus(tres).alias("gpus"))


@query("scl06", "SELECT vec_id, round(list_max(e), 6) AS top, round(list_sum(e), 4) AS total, list_position(e, list_max(e)) AS at FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM {embeddings}) t")
def scl06(b: Bound):
    e = F.transform("embedding", lambda x: x.cast("double"))
    rows = b.embeddings.select("vec_id", e.alias("e"))
    return rows.select("vec_id", F.round(F.array_max("e"), 6).alias("top"), F.round(X.total(F.col("e")), 4).alias("total"), F.array_position("e", F.array_max("e")).cast("int").alias("at"))


@query("scl07", "SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS epoch, date_diff('second', TIMESTAMP '1995-01-01', o_orderdate) AS since FROM {orders}")
def scl07(b: Bound):
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    at = F.to_timestamp(iso, "yyyy-MM-dd'T'HH:mm:ssX")
    return b.orders.select("o_orderkey", F.unix_timestamp(at).alias("epoch"), (F.unix_timestamp(at) - F.unix_timestamp(F.lit("1995-01-01 00:00:00"))).alias("since"))


@query("scl08", "SELECT l_orderkey, l_linenumber, CAST(l_linenumber * 86400 + 3723 AS DOUBLE) AS s FROM {lineitem}")
def scl08(b: Bound):
    return b.lineitem.select("l_orderkey", "l_linenumber", X.seconds(F.concat(F.col("l_linenumber").cast("string"), F.lit("-01:02:03"))).alias("s"))


@query("scl09", "SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber * 1024 ELSE l_linenumber * 4 END AS DOUBLE) AS mb FROM {lineitem}")
def scl09(b: Bound):
    n = F.col("l_linenumber").cast("string")
    text = F.when(F.col("l_linenumber") % 2 == 0, F.concat(n, F.lit("G"))).otherwise(F.concat(n, F.lit("Mc")))
    return b.lineitem.select("l_orderkey", "l_linenumber", X.megabytes(text, F.lit(4)).alias("mb"))


@query("scl10", "SELECT p_partkey, CASE WHEN p_partkey * 7 < 60 THEN concat(p_partkey * 7, ' s') WHEN p_partkey * 7 < 3600 THEN concat(CAST(round(p_partkey * 7 / 60.0) AS BIGINT), ' min') ELSE printf('%d h %02d min', p_partkey * 7 // 3600, p_partkey * 7 % 3600 // 60) END AS text FROM {part}")
def scl10(b: Bound):
    return b.part.select("p_partkey", X.human_seconds(F.col("p_partkey") * 7).alias("text"))


@query("scl11", "SELECT p_partkey, sha1(p_name) AS a, sha256(p_type) AS b FROM {part}")
def scl11(b: Bound):
    return b.part.select("p_partkey", F.sha1("p_name").alias("a"), F.sha2("p_type", 256).alias("b"))


@query("scl12", "SELECT p_partkey, round(sqrt(p_size), 6) AS root, round(ln(p_retailprice), 6) AS logs, least(greatest(p_size, 10), 40) AS clamped FROM {part}")
def scl12(b: Bound):
    return b.part.select("p_partkey", F.round(F.sqrt("p_size"), 6).alias("root"), F.round(F.log("p_retailprice"), 6).alias("logs"), F.least(F.greatest("p_size", F.lit(10)), F.lit(40)).alias("clamped"))


@query("scl15", "SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS k, count(*) AS n FROM {events} GROUP BY 1")
def scl15(b: Bound):
    k = F.from_json("props", "k bigint")["k"]
    return b.events.groupBy((k % 10).alias("k")).agg(F.count("*").alias("n"))


@query("scl16", "SELECT p_partkey, CAST(p_size AS BIGINT) AS low, p_partkey AS high FROM {part}")
def scl16(b: Bound):
    r = X.low_high(F.concat_ws("-", F.col("p_size").cast("string"), F.col("p_partkey").cast("string")))
    return b.part.select("p_partkey", r["low"].alias("low"), r["high"].alias("high"))
