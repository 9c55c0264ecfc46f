"""Quality rules: counts by brute force, rules that are learned, odd rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from strandline.llm import rules

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"


def brute(text):
    s = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", s)
    windows = Counter(zip(w, w[1:], w[2:]))
    hit = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in s.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", s)), len(lines) - len(set(lines)), len(hit)


def odd_texts():
    r = random.Random(5)
    out = [None, "", " ", "\n\n", "a", "a b", "a b c", "a b c a b c", "a b c b a b c", "ab\x00c \x00 ab\x00c", "é é é é", "日本 ｗ x  y", "l\nl\n l\nl ", "\n\nx\n\nx", "\x0bx\x0cx\rx x", "x" * 50_000]
    out += ["".join(r.choice("ab \n\t#é") for _ in range(r.randrange(200))) for _ in range(150)]
    return out + [" ".join(r.choice("abc") for _ in range(30_000))]


def labelled(spark, n=900):
    r = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 8))) for _ in range(80)]
        bad = i % 3
        text = " ".join(w + "$#" for w in words) if bad == 1 else ". ".join(w[:1].upper() * 3 for w in words) if bad == 2 else " ".join(words)
        rows.append((i, text, "en", "a", 1))
        labels.append((i, int(not bad), 0))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)


def test_counts_equal_brute_force(spark):
    texts = odd_texts()
    docs = spark.createDataFrame([(i, t, None, None, 1) for i, t in enumerate(texts)], DOCS)
    got = {r["doc_id"]: r for r in rules.judge(docs, spark.createDataFrame([], LABELS)).collect()}
    for i, t in enumerate(texts):
        want = brute(t)
        assert tuple(got[i][c] for c in rules.COUNTS[:5]) == want, t
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert got[i]["base_failed"] == failed and got[i]["kept"] == (not failed)


def test_counts_of_documents_equal_brute_force(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = rules.judge(docs, labels)
    assert out.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = out.collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r)[1:6] == brute(texts[r["doc_id"]])


def test_rules_are_learned_from_the_training_fold_and_hold_outside(spark):
    docs, labels = labelled(spark)
    found = rules.learn(docs, labels)
    assert 2 <= len(found) <= 4 and rules.describe(found)[-1] == "else keep" and rules.learn(docs, labels) == found
    good = {r["doc_id"]: r["quality"] == 1 for r in labels.collect()}
    held = [r for r in rules.judge(docs, labels).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([r["kept"] == good[r["doc_id"]] for r in held]) >= 0.97
    lies = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert rules.learn(docs, lies) == found  # labels of the held-out fold are never read


def test_the_expression_agrees_with_the_rules(spark):
    docs, labels = labelled(spark, 300)
    found = rules.learn(docs, labels)
    got = rules.statistics(docs, ["doc_id"]).withColumn("kept", rules.verdict(found)).collect()
    counts = {c: np.array([r[c] for r in got]) for c in rules.COUNTS}
    met = np.zeros(len(got), bool)
    for rule in found:
        met |= rules.covers(rule, rules.shares_of(counts), len(got))
    failed = (counts["n_words"] < 50) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])
    assert [r["kept"] for r in got] == list(~failed & ~met)


def test_growing_and_pruning():
    bad = np.array([True] * 30 + [False] * 60)
    counts = {c: np.ones(90, np.int64) for c in rules.COUNTS}
    counts["n_words"] = np.full(90, 100)
    counts["n_symbols"] = np.array([40] * 20 + [1] * 10 + [2] * 60)
    counts["n_upper"] = np.array([0] * 20 + [1] * 10 + [0] * 60)
    got = rules.learned(counts, bad)
    assert [len(r) for r in got] == [1, 1] and str(got[0][0]).startswith("symbols >")
    assert rules.learned(counts, np.ones(90, bool)) == [] and rules.learned(counts, np.zeros(90, bool)) == []
    noise = np.random.default_rng(0).random(90) < 0.5
    assert rules.learned({c: np.arange(90) % 7 + 1 for c in rules.COUNTS}, noise) == []


def test_odd_labels_repeated_rows_clashing_names_and_empty_tables(spark):
    docs, labels = labelled(spark, 120)
    empty, none = docs.limit(0), labels.limit(0)
    assert rules.judge(empty, none).count() == 0 and rules.judge(empty, labels).count() == 0 and rules.judge(docs, none).count() == 120
    odd = labels.unionByName(spark.createDataFrame([(None, 1, 1), (5, None, None), (7, 3, 0), (6, 1, 0)], LABELS))
    more = docs.unionByName(docs.where("doc_id < 9")).unionByName(spark.createDataFrame([(None, None, None, None, None), (1, "other text", "de", None, 1)], DOCS))
    assert rules.judge(more, odd).count() == more.count()
    named = docs.withColumns({c: F.lit("x") for c in [*rules.COUNTS, "kept", "base_failed", "__y"]})
    kept = rules.keep_good(named, labels)
    assert kept.columns == named.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rules.judge(docs, labels).where("kept").collect()}
