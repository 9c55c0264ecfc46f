"""Phrases against brute force, whatever the shards, bitmaps and chunks."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import collocations
from strandline.llm.exact_words import interned, runs

DOCS = "doc_id bigint, text string, lang string"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute(rows, support=10, longest=3, top=2000):
    f, n, out = defaultdict(Counter), Counter(), []
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                f[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= support}
        gone = {p[i : i + k] for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= 50 * found[p[i : i + k]]}
        scored = []
        for p, a in found.items():
            if p not in gone:
                s, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def texts(seed, n, vocabulary, length=60):
    r = random.Random(seed)
    words = [w * 2 if r.random() < 0.2 else w for w in vocabulary]
    joints = [" ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", " ! "]
    return [("".join(r.choice(words) + r.choice(joints) for _ in range(r.randrange(length))), r.choice(["en", "en", "en", "de", None, "und"])) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], DOCS)


def found(docs, **how):
    return sorted(tuple(r) for r in collocations.collocations(docs, **how).collect())


@pytest.mark.parametrize("partitions, how", [(7, {}), (1, {"shards": 9}), (5, {"top": 5}), (3, {"longest": 4, "support": 5}), (4, {"longest": 2, "shards": 1})])
def test_phrases_equal_brute_force(spark, partitions, how):
    rows = texts(partitions, 300, ["A", "b", "Ço", "d-e", "f'", "ｗ", "x y", "#", "z\x00"])
    want = brute(rows, how.get("support", 10), how.get("longest", 3), how.get("top", 2000))
    assert len(want) > 10 and found(frame(spark, rows).repartition(partitions), **how) == want


def test_full_bitmaps_and_small_chunks_lose_nothing(spark, monkeypatch):
    rows = texts(3, 300, [a + b for a in "abcdefg" for b in "uvwxyz"])
    monkeypatch.setattr(collocations, "MAX_BITS", 20)
    monkeypatch.setattr(collocations, "CHUNK", 1 << 10)
    assert found(frame(spark, rows).repartition(6), support=4) == brute(rows, 4)


def test_counts_beyond_64_bits(spark):
    many = spark.createDataFrame([("p", 3_000_000_000, 2)], "phrase string, f long, k int").select(F.lit("en").alias("lang"), F.lit("a b").alias("phrase"), "k", "f")
    words = spark.createDataFrame([("en", "a", 5_000_000_000), ("en", "b", 7_000_000_011)], "lang string, phrase string, f long")
    got = collocations.scored(many, words).collect()
    assert [(r["l"], r["r"], r["score"]) for r in got] == [(5_000_000_000, 7_000_000_011, 10**6 * 3_000_000_000**2 // (5_000_000_000 * 7_000_000_011))]


def test_odd_rows_and_empty_tables(spark):
    rows = [(None, None), (None, "en"), ("", "en"), ("a", "en"), ("x" * 200_000 + " " + "x" * 200_000, "en"), (". , ;", "de")] + [("k l m", "en")] * 10 + [("k l", "en")] * 9 + [("y" * 70_000 + " l", None)] * 12
    assert found(frame(spark, rows)) == brute(rows)
    assert found(frame(spark, [])) == [] and found(frame(spark, rows[:3])) == []
    named = frame(spark, rows).withColumns({c: F.lit(1) for c in ("phrase", "h", "f", "k", "n", "score", "part", "shard")})
    assert found(named) == brute(rows)


def test_ties_in_byte_order(spark):
    rows = [(f"{a} {b}", "en") for a, b in (("é", "1"), ("z", "2"), ("Z\U0001f600", "3"), ("�", "4"), ("zz", "5")) for _ in range(12)]
    got = found(frame(spark, rows), top=4)
    assert got == brute(rows, top=4) and [r[2][0] for r in sorted(got, key=lambda r: r[1])] == ["z", "z", "z", "é"]


def test_interned_slices_are_exact():
    data = np.frombuffer(b"ab ab\x00 ab abab\x00", np.uint8)
    starts, ends, doc = runs(data != 32, np.array([0, 9, 9, len(data)]))
    number, distinct = interned(data, starts, ends)
    assert [distinct[int(i)].as_py() for i in number] == [b"ab", b"ab\x00", b"ab", b"abab\x00"] and list(doc) == [0, 0, 0, 2] or list(starts) == [0, 3, 7, 9, 10]
