"""The registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontam, langid, lattice, linededup, minhash, mixing, quality, rules, sharding, tokens, toxicity, trie
from .common import scratch, table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 40, map_path=scratch(spark, "slot-map"))


def op5_line_neighbourhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.line_dedup(table(spark, sf_dir, "documents"))
    return out.withColumn("dropped", F.array_join(F.transform("dropped", lambda i: i.cast("string")), ","))


def op6_mixing_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(table(spark, sf_dir, "documents"))


def op7_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_table(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op9_lattice_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_son_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_factorisation_machine,
        op2_weighted_minhash,
        op3_language_mixture,
        op4_virtual_slots,
        op5_line_neighbourhood,
        op6_mixing_tree,
        op7_wavelet_tokens,
        op8_decontamination,
        op9_lattice_neighbours,
        op10_toxicity,
        op11_decision_list,
        op12_son_collocations,
        op13_prefix_trie,
    )
}
_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_CONTAMINATION = f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
 i AS (SELECT item_id, w, len(w) AS n, least(13, len(w)) AS k FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) t WHERE len(w) > 0),
 iw AS (SELECT item_id, k, array_to_string(w[j:j + k - 1], ' ') AS win FROM (SELECT *, unnest(range(1, n - k + 2)) AS j FROM i) t),
 ks AS (SELECT DISTINCT k FROM i),
 dw AS (SELECT doc_id, j, k, array_to_string(w[j:j + k - 1], ' ') AS win FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS j FROM d, ks) t),
 m AS (SELECT DISTINCT doc_id, j, k, item_id FROM dw JOIN iw USING (k, win)),
 h AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(j, j + k)) AS place FROM m) t GROUP BY 1),
 g AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM m GROUP BY 1)
 SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
 coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN h USING (doc_id) LEFT JOIN g USING (doc_id)"""

_LINES = """WITH l AS (SELECT doc_id, i - 1 AS line_no, list_filter(regexp_split_to_array(lower(lines[i]), '[ \\t\\r\\f\\x0B]+'), lambda x: x <> '') AS w
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents) s) t),
 f AS (SELECT w, len(w) AS n, min((doc_id, line_no)) AS o FROM l WHERE len(w) > 0 GROUP BY w),
 c AS (SELECT w, n, o, unnest([n, n - 1]) AS c FROM f WHERE n >= 5),
 h AS (SELECT w, n, o, c, 'front' AS side, w[1:c // 2] AS part FROM c WHERE c >= 5 UNION ALL SELECT w, n, o, c, 'back', w[n - (c - c // 2) + 1:n] FROM c WHERE c >= 5),
 p AS (SELECT DISTINCT a.o AS o, b.o AS m, a.w AS x, b.w AS y, a.n AS n, b.n AS k FROM h a JOIN h b USING (c, side, part) WHERE b.o < a.o AND abs(a.n - b.n) <= 1),
 near AS (SELECT DISTINCT o FROM p WHERE CASE WHEN n = k THEN len(list_filter(range(1, n + 1), lambda i: x[i] <> y[i])) <= 1
  WHEN n = k + 1 THEN len(list_filter(range(1, n + 1), lambda i: list_concat(x[1:i - 1], x[i + 1:n]) = y)) > 0 ELSE len(list_filter(range(1, k + 1), lambda i: list_concat(y[1:i - 1], y[i + 1:k]) = x)) > 0 END),
 j AS (SELECT l.doc_id, l.line_no, len(l.w) = 0 AS blank, f.o IS NOT NULL AND f.o <> (l.doc_id, l.line_no) AS exact, near.o IS NOT NULL AND f.o = (l.doc_id, l.line_no) AS near FROM l LEFT JOIN f ON f.w = l.w AND len(l.w) > 0 LEFT JOIN near ON near.o = f.o)
 SELECT doc_id, count(*) AS n_lines, count(CASE WHEN blank THEN 1 END) AS n_blank, count(CASE WHEN exact THEN 1 END) AS n_exact, count(CASE WHEN near THEN 1 END) AS n_near,
  coalesce(string_agg(CASE WHEN exact OR near THEN CAST(line_no AS VARCHAR) END, ',' ORDER BY line_no), '') AS dropped FROM j GROUP BY 1"""
_VECTORS = """WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
 g AS (SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM v WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
 k AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_inner_product(a.e, b.e) / (a.size * b.size) >= 0.93),
 r AS (SELECT vec_id, vec_id AS c FROM v UNION SELECT k.b, r.c FROM r JOIN k ON k.a = r.vec_id)
 SELECT vec_id, (SELECT count(*) FROM k WHERE k.a = v.vec_id) AS n_links, (SELECT min(c) FROM r WHERE r.vec_id = v.vec_id) AS component_id, vec_id = (SELECT min(c) FROM r WHERE r.vec_id = v.vec_id) AS kept FROM v"""

_PHRASES = """WITH w AS (SELECT lang, regexp_extract_all(piece, '[^ \\t]+') AS w FROM (SELECT coalesce(lang, 'und') AS lang,
   unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n\\x0B\\x0C\\r]')) AS piece FROM documents) t),
 n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
 g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) ks(k)) t),
 f AS (SELECT lang, phrase, k, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 10),
 c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS p FROM f WHERE k > 1),
 s AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
 x AS (SELECT s.lang, s.phrase, s.a, s.cut, l.f AS l, r.f AS r, (CAST(1000000 AS HUGEINT) * s.a * s.a) // (CAST(l.f AS HUGEINT) * r.f) AS score FROM s
   JOIN f l ON l.lang = s.lang AND l.phrase = array_to_string(s.p[1:s.cut], ' ') JOIN f r ON r.lang = s.lang AND r.phrase = array_to_string(s.p[s.cut + 1:s.k], ' ')),
 b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
 o AS (SELECT lang, phrase, max(a) AS around FROM (SELECT lang, a, array_to_string(p[i:i + 1], ' ') AS phrase FROM (SELECT lang, a, p, unnest([1, 2]) AS i FROM c WHERE k = 3) t) t GROUP BY ALL)
 SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n.n, CAST(score AS BIGINT) AS score
  FROM b JOIN n ON n.lang = b.lang LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase WHERE around IS NULL OR 100 * around < 50 * a QUALIFY rank <= 2000"""
_TRIE = """WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, k) - 1 AS i, k, words FROM (SELECT conv_id, turn, coalesce(role, '') AS role,
   sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS k, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words FROM conversations WHERE conv_id IS NOT NULL) t),
 h AS (SELECT conv_id, xor(list_reduce(list_concat([CAST(4294967295 AS UBIGINT)], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS UBIGINT), 0, 0, 0, 0, 0, 0, 0]))),
   lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295) % 4 AS h FROM (SELECT DISTINCT conv_id FROM t) d),
 q AS (SELECT h.conv_id, t.i, k, words FROM h JOIN t ON t.conv_id = h.conv_id - h.conv_id % 20 AND t.i < h.h UNION ALL SELECT h.conv_id, t.i, k, words FROM h JOIN t ON t.conv_id = h.conv_id AND t.i >= h.h),
 m AS (SELECT conv_id, row_number() OVER o AS d, list(k) OVER o AS p, words FROM q WINDOW o AS (PARTITION BY conv_id ORDER BY i ROWS UNBOUNDED PRECEDING) UNION ALL SELECT conv_id, 0, [], 0 FROM h),
 n AS (SELECT p, d, min(conv_id) AS c, count(*) AS members, (count(*) - 1) * any_value(words) AS own FROM m GROUP BY p, d),
 kids AS (SELECT p[1:d - 1] AS p, count(*) AS children FROM n WHERE d > 0 GROUP BY 1),
 sub AS (SELECT p[1:j] AS p, count(CASE WHEN leaf THEN 1 END) AS leaves, CAST(sum(own) AS BIGINT) AS saved FROM (SELECT n.p, n.own, kids.p IS NULL AS leaf, unnest(range(0, d + 1)) AS j FROM n LEFT JOIN kids ON kids.p = n.p) t GROUP BY 1),
 e AS (SELECT p, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM (SELECT conv_id, arg_max(p, d) AS p FROM m GROUP BY conv_id) t GROUP BY p)
 SELECT n.c AS conv_id, n.d AS depth, up.c AS parent_conv_id, n.members AS n_convs, coalesce(children, 0) AS n_children, leaves AS n_leaves, saved AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
  FROM n LEFT JOIN kids ON kids.p = n.p JOIN sub ON sub.p = n.p LEFT JOIN e ON e.p = n.p LEFT JOIN n up ON n.d > 0 AND up.d = n.d - 1 AND up.p = n.p[1:n.d - 1]"""

#: Operators that DuckDB can express; the others are tested against brute force (tests/llm).
ORACLES: dict[str, str] = {
    "op5_line_neighbourhood": _LINES,
    "op8_decontamination": _CONTAMINATION,
    "op9_lattice_neighbours": _VECTORS,
    "op12_son_collocations": _PHRASES,
    "op13_prefix_trie": _TRIE,
}
