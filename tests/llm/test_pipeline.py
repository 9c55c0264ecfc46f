"""The corpus pipeline, stage by stage against brute force on the smallest tables."""

import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from test_llm import brute_classes, brute_language

from strandline.llm import langid
from strandline.llm.queries import tokenizer_path

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of each stage, written and read again as run() does."""
    docs, out = spark.read.parquet(f"{DATA}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, DATA).write.parquet(path)
        out[name] = (docs, spark.read.parquet(path))
        docs = out[name][1]
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def ids(df):
    return Counter(r["doc_id"] for r in df.collect())


def test_stage_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "mixing", "token_shards"]
    for name in list(stages)[:-1]:
        assert stages[name][1].columns == stages["language_id"][0].columns


def test_language_stage(stages):
    docs, kept = stages["language_id"]
    names, table = langid.fit(*langid.language_sample(docs))
    judged = {i: brute_language(t, names, table.astype(float)) for i, t in texts(docs).items()}
    sure = {i for i, x in judged.items() if x and x[1] >= 0.41}
    open_ = {i for i, x in judged.items() if x and 0.39 < x[1] < 0.41}
    assert sure <= ids(kept).keys() <= sure | open_


def test_dedup_stage(stages):
    docs, kept = stages["near_dedup"]
    classes = brute_classes(docs)
    assert ids(kept) == Counter(i for i, c in classes.items() if i == c)


def test_decontamination_stage(spark, stages):
    docs, kept = stages["decontamination"]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = set()
    for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect():
        w = words(r["text"])
        windows |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    sizes, want = {len(x) for x in windows}, []
    for i, t in texts(docs).items():
        w, hit = words(t), set()
        for n in sizes:
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) in windows:
                    hit.update(range(at, at + n))
        if not (hit and 20 * len(hit) >= len(w)):
            want.append(i)
    assert ids(kept) == Counter(want)


def test_mixing_stage(stages):
    docs, mixed = stages["mixing"]
    size = {r["doc_id"]: len(re.findall("[^\\x20\\x09-\\x0D]+", r["text"] or "")) for r in docs.collect()}
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    copies, per, longest = ids(mixed), Counter(), Counter()
    for i, n in size.items():
        per[source[i]] += n
        longest[source[i]] = max(longest[source[i]], n)
        assert copies[i] <= 3
    order = sorted(per, key=lambda s: (s is None, (s or "").encode()))
    weight, goal, left = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, {}, float(sum(size.values()))
    while len(goal) < len(order):  # fill every source in proportion, stop those at three times their size
        rest = [s for s in order if s not in goal]
        unit = left / sum(weight[s] for s in rest)
        full = [s for s in rest if weight[s] * unit > 3 * per[s]]
        for s in full or rest:
            goal[s] = 3.0 * per[s] if full else weight[s] * unit
        left = sum(size.values()) - sum(goal.values())
    taken = Counter()
    for i, k in copies.items():
        taken[source[i]] += k * size[i]
    assert all(abs(taken[s] - goal[s]) <= longest[s] / 2 + 1e-6 for s in order)


def test_token_stage(stages):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    docs, out = stages["token_shards"]
    rows, start = sorted((r["doc_id"], r["text"]) for r in docs.collect()), 0
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in out.collect())
    assert len(got) == len(rows)
    for (i, t), row in zip(rows, got):
        own = [*tok.encode(t, add_special_tokens=False).ids, 2]
        assert row == (i, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += len(own)


def test_run_equals_the_stages(spark, stages):
    columns = ["doc_id", "start", "n_tokens", "ids_crc32"]
    got, want = corpus_pipeline.run(spark, DATA).select(*columns), stages["token_shards"][1].select(*columns)
    assert sorted(got.collect()) == sorted(want.collect())


def test_mixing_and_tokens_take_odd_rows_and_empty_tables(spark):
    shape = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, key string"
    odd = spark.createDataFrame([(None, "a b", None, None, None, 1, "x"), (1, None, "en", "s", 1, 1, "x"), (1, "c d e", "en", "s", 1, None, None), (1, "c d e", "en", "s", 1, None, None), (2, "", None, "s", None, 2, "y")], shape)
    for df in (odd, odd.where("doc_id = 99")):
        mixed = corpus_pipeline.mix_sources(spark, df, DATA)
        assert mixed.columns == df.columns
        taken = mixed.collect()
        assert all(r["text"] for r in taken) and (not taken) == (df.count() == 0)
        assert corpus_pipeline.token_shards(spark, df, DATA).count() == df.count()
