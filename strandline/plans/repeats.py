"""Queries of the tandem-repeat family."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import repeats as op
from .bindings import Bound, query
from .saving import saver

_ALLELES = "(SELECT locus_id, sample_id, al1 AS al FROM {tr_alleles} UNION ALL SELECT locus_id, sample_id, al2 FROM {tr_alleles})"


@query("agg11", f"SELECT locus_id, al, count(*) AS n_alleles, count(DISTINCT sample_id) AS n_members FROM {_ALLELES} a GROUP BY 1, 2")
def agg11(b: Bound):
    return op.allele_spectrum(op.long_alleles(b.tr_alleles))


_Q = f"""SELECT locus_id, list(al ORDER BY al) AS v, count(*) AS n, median(al) AS median FROM {_ALLELES} a GROUP BY 1"""


@query("agg12", f"""WITH q AS ({_Q}), d AS (SELECT a.locus_id, median(abs(al - q.median)) AS mad FROM {_ALLELES} a JOIN q USING (locus_id) GROUP BY 1)
 SELECT locus_id, v[greatest(1, CAST(ceil(0.25 * n) AS BIGINT))] AS p25, v[greatest(1, CAST(ceil(0.9 * n) AS BIGINT))] AS p90, median, mad, n FROM q JOIN d USING (locus_id)""")
def agg12(b: Bound):
    counts = op.allele_spectrum(op.long_alleles(b.tr_alleles))
    q = op.wquantiles(counts, "locus_id", "al", "n_alleles", {"p25": 0.25, "p90": 0.9})
    return q.join(op.wmad(counts, q, "locus_id", "al", "n_alleles"), "locus_id")


_STATS = f"""SELECT l.locus_id, CASE WHEN l.chrom = 'chrY' THEN (SELECT count(*) FROM {{members}} WHERE sex <> 'XX') ELSE (SELECT count(*) FROM {{members}}) END AS n_expected,
 c.n_called, q.n AS n_alleles, q.median, d.mad, q.v[greatest(1, CAST(ceil(0.95 * q.n) AS BIGINT))] AS p95, q.v[greatest(1, CAST(ceil(0.99 * q.n) AS BIGINT))] AS p99,
 len(list_distinct(q.v)) AS n_distinct, q.v[1] AS al_min, q.v[q.n] AS al_max
 FROM {{loci}} l JOIN ({_Q}) q USING (locus_id) JOIN (SELECT locus_id, count(DISTINCT sample_id) AS n_called FROM {{tr_alleles}} GROUP BY 1) c USING (locus_id)
 JOIN (SELECT a.locus_id, median(abs(al - q.median)) AS mad FROM {_ALLELES} a JOIN ({_Q}) q USING (locus_id) GROUP BY 1) d USING (locus_id)"""


@query("agg13", _STATS)
def agg13(b: Bound):
    return op.locus_stats(op.long_alleles(b.tr_alleles), b.loci, b.members)


_OUT = f"""SELECT t.*, s.n_called, greatest(al1, al2) - s.median AS excess, greatest(1.4826 * s.mad, 3.0) AS scale,
  greatest(al1, al2) - s.median >= 30 AND (greatest(al1, al2) - s.median) / greatest(1.4826 * s.mad, 3.0) >= 8 AS hit,
  least(al1, al2) - s.median >= 30 AND (least(al1, al2) - s.median) / greatest(1.4826 * s.mad, 3.0) >= 8 AS low_hit FROM {{tr_alleles}} t JOIN ({_STATS}) s USING (locus_id)"""
_STATUS = "CASE WHEN n_called < 20 THEN 'below_min_called' WHEN n_carriers = 0 THEN 'none' WHEN n_carriers > greatest(1, floor(0.02 * n_called)) THEN 'common' ELSE 'listed' END"


def _outliers(b: Bound):
    stats = op.locus_stats(op.long_alleles(b.tr_alleles), b.loci, b.members)
    return op.tr_outliers(b.tr_alleles, stats, 3, 30, 8.0, 20, 0.02, 1, saver(b))


@query("sta09", f"""WITH o AS ({_OUT}), c AS (SELECT locus_id, count(CASE WHEN hit THEN 1 END) AS n_carriers FROM o GROUP BY 1)
 SELECT locus_id, sample_id, call_id, call_no, round(excess, 6) AS excess, round(excess / scale, 6) AS z, n_carriers, {_STATUS} AS status, hit AND low_hit AS both FROM o JOIN c USING (locus_id) WHERE hit""")
def sta09(b: Bound):
    return _outliers(b).select("locus_id", "sample_id", "call_id", "call_no", F.round("excess", 6).alias("excess"), F.round("z", 6).alias("z"), "n_carriers", "status", "both")


def _class_sql(c: str) -> str:
    return f"""CASE WHEN assessable = 'no' THEN 'not_assessable' WHEN {c} >= benign_min AND {c} <= benign_max THEN 'normal' WHEN {c} >= pathogenic_min THEN 'pathogenic'
 WHEN {c} >= intermediate_min AND {c} <= intermediate_max THEN 'intermediate' WHEN {c} < benign_min THEN 'below_benign' ELSE 'above_benign' END"""


def _edge_sql(c: str) -> str:
    same = lambda x: f"replace({_class_sql(x)}, 'below_benign', 'normal')"
    low, high = f"greatest(0, {c} - 3)", f"({c} + 3)"
    return f"({same(low)} <> {same(c)} OR {same(high)} <> {same(c)})"


_RANK = "list_position(['uncalled','not_assessable','normal','below_pathogenic','below_benign','above_benign','intermediate','pathogenic'], {})"
_SCREEN = f"""SELECT *, (CASE WHEN class1 = 'pathogenic' THEN 1 ELSE 0 END) + (CASE WHEN class2 = 'pathogenic' THEN 1 ELSE 0 END) AS np,
 CASE WHEN {_RANK.format('class1')} >= {_RANK.format('class2')} THEN class1 ELSE class2 END AS cls FROM (SELECT *, {_class_sql('copies1')} AS class1, {_class_sql('copies2')} AS class2, {_edge_sql('copies1')} OR {_edge_sql('copies2')} AS borderline
 FROM (SELECT t.*, l.* EXCLUDE (locus_id), greatest(al1, al2) // 3 AS copies1, least(al1, al2) // 3 AS copies2 FROM {{tr_alleles}} t JOIN {{loci}} l USING (locus_id)) x) y"""


@query("sta10", f"""WITH s AS ({_SCREEN}) SELECT locus_id, sample_id, call_id, call_no, copies1, copies2, class1, class2, cls AS class, CAST(np AS BIGINT) AS n_pathogenic,
 CASE WHEN np = 0 THEN 'none' WHEN inheritance IN ('AR', 'XR') THEN CASE WHEN np >= 2 THEN 'consistent' ELSE 'carrier' END ELSE 'consistent' END AS mode_match, borderline FROM s""")
def sta10(b: Bound):
    return op.tr_screen(b.tr_alleles, b.loci, 9).select("locus_id", "sample_id", "call_id", "call_no", "copies1", "copies2", "class1", "class2", "class", "n_pathogenic", "mode_match", "borderline")


@query("agg49", f"""WITH s AS ({_SCREEN}), a AS (SELECT locus_id, assessable, copies1 AS copies, class1 AS c FROM s UNION ALL SELECT locus_id, assessable, copies2, class2 FROM s),
 n AS (SELECT count(*) AS n FROM {{members}}), q AS (SELECT locus_id, assessable, list(copies ORDER BY copies) AS v, count(*) AS k, median(copies) AS copies_median,
  avg(CASE WHEN c IN ('above_benign','intermediate','pathogenic') THEN 1.0 ELSE 0 END) AS above, avg(CASE WHEN c = 'below_benign' THEN 1.0 ELSE 0 END) AS below FROM a GROUP BY 1, 2),
 c AS (SELECT locus_id, count(DISTINCT sample_id) AS n_called, count(CASE WHEN cls = 'pathogenic' THEN 1 END) AS n_pathogenic, count(CASE WHEN borderline THEN 1 END) AS n_borderline FROM s GROUP BY 1)
 SELECT locus_id, copies_median, v[greatest(1, CAST(ceil(0.95 * k) AS BIGINT))] AS copies_p95, v[k] AS copies_max, round(above, 6) AS above, round(below, 6) AS below, n_called, n_pathogenic, n_borderline, round(n_called / CAST(n AS DOUBLE), 6) AS call_rate,
 CASE WHEN assessable = 'no' THEN 'not_assessable' WHEN n_called / CAST(n AS DOUBLE) < 0.5 THEN 'mostly_uncalled' WHEN above > 0.2 OR below > 0.2 THEN 'threshold_or_frame_suspect' WHEN n_called < n THEN 'few_uncalled' ELSE 'ok' END AS call_note
 FROM q JOIN c USING (locus_id), n""")
def agg49(b: Bound):
    out = op.screen_loci(op.tr_screen(b.tr_alleles, b.loci, 9), b.members.count())
    r = {c: F.round(c, 6) for c in ("above", "below", "call_rate")}
    return out.withColumns(r).drop("assessable")


@query("agg50", f"""WITH o AS ({_OUT}), k AS (SELECT locus_id, count(CASE WHEN hit THEN 1 END) AS n_carriers FROM o GROUP BY 1), f AS (SELECT sample_id, count(*) AS n_outliers, count(CASE WHEN low_hit THEN 1 END) AS n_both FROM o JOIN k USING (locus_id) WHERE hit AND {_STATUS} = 'listed' GROUP BY 1),
 s AS ({_SCREEN}) SELECT sample_id, n_calls, n_pathogenic, n_borderline, coalesce(n_outliers, 0) AS n_outliers, coalesce(n_both, 0) AS n_both FROM
 (SELECT sample_id, count(*) AS n_calls, count(CASE WHEN cls = 'pathogenic' THEN 1 END) AS n_pathogenic, count(CASE WHEN borderline THEN 1 END) AS n_borderline FROM s GROUP BY 1) q LEFT JOIN f USING (sample_id)""")
def agg50(b: Bound):
    return op.tr_members(_outliers(b), op.tr_screen(b.tr_alleles, b.loci, 9))


_MAD = """WITH m AS (SELECT event_type, median(value) AS median, count(*) AS n FROM {events} GROUP BY 1), d AS (SELECT event_type, median(abs(value - median)) AS mad FROM {events} JOIN m USING (event_type) GROUP BY 1)
 SELECT event_type, event_id, value, round(median, 6) AS median, round(mad, 6) AS mad FROM {events} JOIN m USING (event_type) JOIN d USING (event_type) WHERE n >= 4 AND mad > 0 AND """


def _rounded(df):
    return df.withColumns({"median": F.round("median", 6), "mad": F.round("mad", 6)})


@query("agg14", _MAD + "abs(value - median) > 3 * 1.4826 * mad")
def agg14(b: Bound):
    return _rounded(op.mad_outliers(b.events, "event_type", "event_id", save=saver(b)))


@query("agg14_plain", _MAD + "value - median > 5.0 * mad")
def agg14_plain(b: Bound):
    return _rounded(op.mad_outliers(b.events, "event_type", "event_id", 5.0, scaled=False, side="high", save=saver(b)))


@query("agg15", """WITH t AS (SELECT o_custkey AS sample_id, max(o_totalprice) AS top, avg(o_totalprice) AS mean, CAST(count(*) AS DOUBLE) AS n_orders FROM {orders} GROUP BY 1),
 l AS (SELECT sample_id, 'top' AS metric, top AS value FROM t UNION ALL SELECT sample_id, 'mean', mean FROM t UNION ALL SELECT sample_id, 'n_orders', n_orders FROM t),
 m AS (SELECT metric, median(value) AS median, count(*) AS n FROM l GROUP BY 1), d AS (SELECT metric, median(abs(value - median)) AS mad FROM l JOIN m USING (metric) GROUP BY 1)
 SELECT metric, n, round(median, 6) AS median, round(mad, 6) AS mad, count(CASE WHEN mad > 0 AND abs(value - median) > 3 * 1.4826 * mad THEN 1 END) AS n_outliers FROM l JOIN m USING (metric) JOIN d USING (metric) GROUP BY 1, 2, 3, 4""")
def agg15(b: Bound):
    t = b.orders.groupBy(F.col("o_custkey").alias("sample_id")).agg(F.max("o_totalprice").alias("top"), F.avg("o_totalprice").alias("mean"), F.count("*").cast("double").alias("n_orders"))
    return _rounded(op.distributions(t, ["top", "mean", "n_orders"], save=saver(b)))


@query("agg16", """WITH r AS (SELECT l_suppkey AS hap, CAST(l_quantity AS BIGINT) AS len FROM {lineitem}), s AS (SELECT *, sum(len) OVER (PARTITION BY hap ORDER BY len DESC) AS run, sum(len) OVER (PARTITION BY hap) AS total FROM r)
 SELECT hap, max(CASE WHEN run >= 0.5 * total THEN len END) AS n50, CAST(max(total) AS BIGINT) AS total FROM s GROUP BY 1""")
def agg16(b: Bound):
    return op.n50(b.lineitem.select(F.col("l_suppkey").alias("hap"), F.col("l_quantity").cast("long").alias("len")), "hap", "len")


@query("agg51", "SELECT CASE WHEN called = 0 THEN 'full' WHEN called = 1 THEN 'half' ELSE 'none' END AS class, count(*) AS count FROM {genotypes} GROUP BY 1")
def agg51(b: Bound):
    return op.dropouts(b.genotypes, F.when(F.col("called") == 0, "full").when(F.col("called") == 1, "half").otherwise("none"))
