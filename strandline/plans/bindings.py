"""Views that bind the driver's tables to the cohort data model, and the registry of queries.

The same text builds the Spark views (over the tables of a folder) and the ``WITH`` prefix of an oracle statement.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..session import enough_parts, ready, shared_folder, small_tasks, stored_bytes

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS: dict[str, str] = {
    "members": """SELECT c_custkey AS sample_id,
        CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 2 = 0 THEN 'XX' ELSE 'XY' END AS sex,
        c_mktsegment AS ancestry, c_nationkey AS batch, c_acctbal AS depth_mean, c_custkey AS position FROM {customer}""",
    "sites": """SELECT p_partkey AS site_id,
        CASE WHEN p_partkey % 26 < 22 THEN concat('chr', CAST(p_partkey % 26 + 1 AS VARCHAR(8)))
             WHEN p_partkey % 26 = 22 THEN 'chrX' WHEN p_partkey % 26 = 23 THEN 'chrY'
             WHEN p_partkey % 26 = 24 THEN 'chrM' ELSE 'chrUn_1' END AS chrom,
        p_partkey * 500 + p_size * 7 + 1 AS pos, p_size * p_size + 40 AS svlen,
        CASE p_size % 4 WHEN 0 THEN 'INS' WHEN 1 THEN 'DEL' WHEN 2 THEN 'DUP' ELSE 'INV' END AS svtype,
        CASE WHEN p_size % 10 = 0 THEN 'LowQual' ELSE 'PASS' END AS filter, p_brand AS region_label, p_type AS gene FROM {part}""",
    "genotypes": """SELECT l.l_partkey AS site_id, o.o_custkey AS sample_id,
        CASE WHEN min(l.l_tax) < 0.005 THEN NULL WHEN count(*) >= 2 OR max(l.l_linenumber) % 4 = 0 THEN 2 ELSE 1 END AS alt,
        CASE WHEN min(l.l_tax) < 0.005 THEN 0 WHEN count(*) = 1 AND max(l.l_linenumber) % 5 = 1 THEN 1 ELSE 2 END AS called,
        CAST(sum(l.l_quantity) AS BIGINT) AS dp
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey GROUP BY l.l_partkey, o.o_custkey""",
    "regions": """SELECT p_partkey AS region_id,
        CASE WHEN p_partkey % 26 < 22 THEN concat('chr', CAST(p_partkey % 26 + 1 AS VARCHAR(8))) ELSE 'chrX' END AS chrom,
        p_partkey * 480 AS start_pos, p_partkey * 480 + p_size * 400 AS end_pos, p_brand AS region_label FROM {part}""",
    "tr_alleles": """SELECT l.l_partkey AS locus_id, o.o_custkey AS sample_id, l.l_orderkey AS call_id, l.l_linenumber AS call_no,
        CAST(l.l_quantity AS BIGINT) * 3 AS al1,
        CAST(l.l_quantity AS BIGINT) * CASE WHEN l.l_discount > 0.095 AND l.l_tax > 0.075 THEN 30 ELSE 3 END AS al2
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey""",
    "runs": """SELECT o_orderkey AS run_id, o_custkey AS subject_id, o_orderpriority AS stage,
        CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'failed' ELSE 'running' END AS status,
        row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) AS attempt,
        o_orderdate AS started_at FROM {orders}""",
    "jobs": """SELECT l_orderkey AS run_id, l_linenumber AS job_no, concat(l_returnflag, l_linestatus) AS task,
        CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'COMPLETED' END AS state,
        CAST(l_quantity AS INT) AS alloc_cpus, round(l_extendedprice, 0) AS elapsed_s,
        l_discount * 100000 AS max_rss_mb, l_tax * 3600 AS queue_s FROM {lineitem}""",
    "methyl": """SELECT user_id AS sample_id, event_type AS island, count(*) AS cov, avg(value) AS value
        FROM {events} GROUP BY user_id, event_type""",
    # labelled member x region values: one profile value per (member, region label), with a group label
    "profiles": """SELECT o.o_custkey AS sample_id, p.p_brand AS region_label, c.c_mktsegment AS label,
        avg(l.l_discount) AS value, count(*) AS cov
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN {part} p ON l.l_partkey = p.p_partkey
        JOIN {customer} c ON c.c_custkey = o.o_custkey GROUP BY o.o_custkey, p.p_brand, c.c_mktsegment""",
    # named repeat loci with thresholds in copies of a 3 bp motif
    "loci": """SELECT p_partkey AS locus_id, CASE WHEN p_partkey % 26 < 22 THEN concat('chr', CAST(p_partkey % 26 + 1 AS VARCHAR(8)))
        WHEN p_partkey % 26 = 22 THEN 'chrX' WHEN p_partkey % 26 = 23 THEN 'chrY' ELSE 'chrX' END AS chrom,
        CASE WHEN p_size % 3 = 0 THEN 'AR' WHEN p_size % 3 = 1 THEN 'AD' ELSE 'XR' END AS inheritance, 3 AS motif_len,
        p_size / 10 AS benign_min, p_size AS benign_max, p_size + 5 AS intermediate_min, p_size + 10 AS intermediate_max,
        CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size + 11 END AS pathogenic_min,
        CASE WHEN p_size % 9 = 0 THEN 'no' ELSE 'yes' END AS assessable FROM {part}""",
    # relatives: pairs of members that carry an allele at a common site; a member without a row at a site is called hom-ref there, one
    # with fewer than two called alleles is missing.  What hom-ref is counted in follows from each member's own counts.
    "pairs": """WITH g AS (SELECT site_id, sample_id, CASE WHEN called < 2 THEN 3 ELSE alt END AS code FROM {genotypes}), s AS (SELECT count(DISTINCT site_id) AS sites FROM {genotypes}),
        t AS (SELECT sample_id, count(*) AS r, count(CASE WHEN code = 1 THEN 1 END) AS het, count(CASE WHEN code = 2 THEN 1 END) AS hom, count(CASE WHEN code = 3 THEN 1 END) AS miss FROM g WHERE code > 0 GROUP BY sample_id),
        j AS (SELECT a.sample_id AS sample_a, b.sample_id AS sample_b, count(CASE WHEN a.code < 3 AND b.code < 3 THEN 1 END) AS shared, count(CASE WHEN a.code = 1 AND b.code = 1 THEN 1 END) AS hets,
         count(CASE WHEN a.code = b.code AND a.code < 3 THEN 1 END) AS same, count(CASE WHEN a.code = 3 AND b.code = 3 THEN 1 END) AS miss, count(*) AS r, count(CASE WHEN a.code = 2 THEN 1 END) + count(CASE WHEN b.code = 2 THEN 1 END) AS hom
         FROM g a JOIN g b ON a.site_id = b.site_id AND a.sample_id < b.sample_id WHERE a.code > 0 AND b.code > 0 GROUP BY a.sample_id, b.sample_id)
        SELECT j.sample_a, j.sample_b, j.hets AS shared_hets, x.hom + y.hom - j.hom AS ibs0, j.same + s.sites - x.r - y.r + j.r AS ibs2, s.sites - x.miss - y.miss + j.miss AS n, x.het AS hets_a, y.het AS hets_b
        FROM j JOIN t x ON x.sample_id = j.sample_a JOIN t y ON y.sample_id = j.sample_b CROSS JOIN s WHERE j.shared > 0""",
    # cell composition: fractions of a vector's magnitude
    "fractions": """SELECT vec_id AS sample_id, cell, fraction FROM (SELECT v.vec_id, v.cell, abs(v.x) / sum(abs(v.x)) OVER (PARTITION BY v.vec_id) AS fraction
        FROM {cells} v) t""",
}
#: Exploding an array is spelled differently in the two engines.
CELLS = {
    "spark": "SELECT vec_id, CAST(i AS BIGINT) AS cell, CAST(x AS DOUBLE) AS x FROM {embeddings} LATERAL VIEW posexplode(embedding) t AS i, x",
    "duckdb": "SELECT vec_id, CAST(i - 1 AS BIGINT) AS cell, CAST(embedding[i] AS DOUBLE) AS x FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM {embeddings}) t",
}


class Bound:
    """The tables and views of a folder as DataFrames: bound.members, bound.lineitem, ..."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._held, self._bytes = small_tasks(ready(spark)), sf_dir, {}, 0

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in {*TABLES, *VIEWS, "cells"}:
            raise AttributeError(name)
        if name not in self._held:
            if name in TABLES:
                path = f"{self.sf_dir}/{name}.parquet"
                self._held[name] = self.spark.read.parquet(path)
                self._bytes += stored_bytes(self.spark, path)
                enough_parts(self.spark, self._bytes)
            else:
                text = CELLS["spark"] if name == "cells" else VIEWS[name]
                self._held[name] = self.spark.sql(text, **{n: getattr(self, n) for n in needed(text)})
        return self._held[name]

    @cached_property
    def scratch(self) -> str:
        """A fresh folder that driver and executors share."""
        import uuid

        return f"{shared_folder(self.spark)}/{uuid.uuid4().hex[:12]}"


def needed(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


def with_views(sql: str) -> str:
    """The statement with a WITH prefix of the views it names in braces."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in needed(text):
            if name not in TABLES and name not in order:
                body = CELLS["duckdb"] if name == "cells" else VIEWS[name]
                visit(body)
                order.append(name)

    visit(sql)
    plain = lambda text: re.sub(r"\{(\w+)\}", r"\1", text)
    parts = [f"{n} AS ({plain(CELLS['duckdb'] if n == 'cells' else VIEWS[n])})" for n in order]
    body = plain(sql).strip()
    if not parts:
        return body
    if body[:15].upper() == "WITH RECURSIVE ":
        return "WITH RECURSIVE " + ", ".join([*parts, body[15:]])
    return "WITH " + ", ".join(parts) + (", " + body[5:] if body[:5].upper() == "WITH " else " " + body)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a function of Bound as a query, with its oracle statement over tables and views named in braces."""

    def register(make: Callable[[Bound], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = lambda spark, sf_dir: make(Bound(spark, sf_dir))
        if oracle:
            ORACLES[name] = with_views(oracle)
        return make

    return register
