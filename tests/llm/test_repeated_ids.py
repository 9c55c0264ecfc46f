"""Long texts and repeated ids lose nobody else's rows."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandline.llm import labelled, langid, linededup, minhash

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def test_a_long_text_is_passed_over_alone(spark):
    docs = spark.createDataFrame([(i, prose(i, 4), "en", "a", 1) for i in range(60)], DOCS)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id bigint, quality int, toxic int")
    all_, _ = labelled.labelled_sample(docs, labels, "quality", ["text"], most_bytes=1000)
    want = Counter(r[-1] for r in all_)
    first = spark.createDataFrame([(i,) for i in range(1, 60, 2)], "doc_id bigint").where((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5) != 0)
    first = first.orderBy(F.xxhash64("doc_id")).first()[0]  # heads the hash order of its class
    longer = docs.withColumn("text", F.when(F.col("doc_id") == first, F.repeat(F.lit("x"), 2000)).otherwise(F.col("text")))
    got, _ = labelled.labelled_sample(longer, labels, "quality", ["text"], most_bytes=1000)
    assert Counter(r[-1] for r in got) == want - Counter([1])


def test_rows_that_fit_are_taken_in_order():
    assert [r[1] for r in labelled.fitting([("a", 2, 5), ("a", 1, 90), ("a", 3, 11), ("a", 4, 5), ("b", 1, 11)], 100)] == [1, 2, 4, 1]
    assert labelled.fitting([("a", 1, 101)], 100) == []


def test_a_language_of_one_repeated_id_is_learned(spark):
    one = spark.createDataFrame([(0, "der die das und nicht", "de", "a", 1)], DOCS)
    many = one.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(20000)))).drop("again")
    docs = many.union(spark.createDataFrame([(i, "the of and to in is " + prose(i, 4), "en", "a", 1) for i in range(1, 51)], DOCS))
    assert langid.fit(*langid.language_sample(docs))[0] == ["de", "en"]
    assert {(r["lang_pred"], r["count"]) for r in langid.identify(docs).groupBy("lang_pred").count().collect()} == {("de", 20000), ("en", 50)}


def test_lines_at_one_place_of_a_repeated_id(spark):
    rows = [(1, "a b c d e f"), (1, "u v w x y z"), (2, "u v w x y q"), (3, "a b c d e g")]
    for order in itertools.permutations(rows):
        if order[0] != rows[0] and order[0] != rows[2]:
            continue
        got = {r["doc_id"]: r["n_near"] for r in linededup.line_dedup(spark.createDataFrame(order, "doc_id bigint, text string")).collect()}
        assert got == {1: 0, 2: 1, 3: 1}
        break
    back = {r["doc_id"]: r["n_near"] for r in linededup.line_dedup(spark.createDataFrame(rows[::-1], "doc_id bigint, text string")).collect()}
    assert back == {1: 0, 2: 1, 3: 1}
    alike = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e g")], "doc_id bigint, text string")  # one place: neither is earlier
    assert [r["n_near"] for r in linededup.line_dedup(alike).collect()] == [0]


@pytest.mark.parametrize("turn", [1, -1])
def test_texts_of_one_id_stay_in_their_own_classes(spark, turn):
    a, b = prose(1, 200), prose(2, 200)
    docs = spark.createDataFrame([(1, a, "en", "a", 1), (1, b, "en", "a", 1), (2, b + " xx", "en", "a", 1), (3, a + " yy", "en", "a", 1)][::turn], DOCS)
    of = {(r["doc_id"], r["kept"], r["class_key"]) for r in minhash.near_duplicates(docs).collect()}
    two, three = (next(k for i, _, k in of if i == x) for x in (2, 3))
    assert two != three and of == {(1, True, two), (1, True, three), (2, False, two), (3, False, three)}
    assert sorted(r["text"] for r in minhash.drop_near_duplicates(docs).collect()) == sorted([a, b])


def test_the_row_that_stays_does_not_depend_on_the_order(spark):
    a = prose(1, 100)
    rows = [(1, a, "en", "b", 1), (1, a, "en", "a", 1), (1, a, None, "c", 2), (2, a, "en", "a", 1)]
    kept = [minhash.drop_near_duplicates(spark.createDataFrame(r, DOCS)).collect() for r in (rows, rows[::-1])]
    assert len(kept[0]) == 1 and kept[0] == kept[1]
