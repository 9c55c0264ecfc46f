"""Edge cases and brute-force checks of the training-data operators."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandline.llm import common, decontam, labelled, langid, lattice, linededup, minhash, mixing, quality, sharding, tokens, toxicity
from strandline.llm.common import byte_chunks, components
from strandline.llm.queries import tokenizer_path

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "pe", "ra", "so", "tu", "vi", "wo") for b in ("n", "ra", "st", "lim", "dor", "x", "bel", "qua")]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (r.choice(".,") if r.random() < 0.1 else "") for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and columns with clashing names."""
    long = prose(1, 40_000) + "\n" + "x" * 70_000
    rows = [
        (None, prose(2, 60), "en", "a", 10),
        (1, None, "en", "a", None),
        (2, "", None, "b", 0),
        (3, long, "en", None, 9),
        (4, prose(3, 80), "de", "b", 500),
        (5, prose(3, 80), "de", "b", 500),
        (5, prose(3, 80), "de", "b", 500),
        (6, "...!!! 12", "de", "c", 9),
        (7, "ÉÈ 日本語 ́ <|endoftext|> don't", "fr", "c", 9),
        (8, "one two", "en", "a", 7),
    ] + [(10 + i, prose(10 + i, 50), ["en", "de"][i % 2], "abc"[i % 3], 300) for i in range(20)]
    df = frame(spark, rows)
    names = ("size", "rest", "goal", "score", "shard", "slot", "ids", "key", "id", "w", "label", "component", "n")
    return df.withColumns({n: F.lit(1) for n in names})


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i // 2) % 2) for i in range(4, 30)] + [(None, 1, 1), (9, None, None), (4, 1, 1)], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, prose(4, 30)), (2, "one two"), (3, None), (4, ""), (None, prose(5, 20)), (2, "one two")], "item_id bigint, text string")


def test_every_operator_takes_odd_rows_and_empty_tables(spark, odd, empty, labels, benchmark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    n = odd.count()
    assert quality.quality(odd, labels).count() == n and quality.quality(empty, none).count() == 0 and quality.quality(odd, none).count() == n
    assert toxicity.toxicity(odd, labels).count() == n and toxicity.toxicity(empty, none).count() == 0
    assert langid.identify(odd).count() == n and langid.identify(empty).count() == 0
    assert sharding.shard_documents(odd, 4).count() == n and sharding.shard_documents(empty, 4).count() == 0
    assert linededup.line_dedup(odd).count() == odd.select("doc_id").distinct().count() and linededup.line_dedup(empty).count() == 0
    assert mixing.mix_table(odd).count() == n and mixing.mix_table(empty).count() == 0
    assert tokens.token_table(odd, tokenizer_path()).count() == n and tokens.token_table(empty, tokenizer_path()).count() == 0
    assert decontam.contamination(odd, benchmark).count() == n and decontam.contamination(empty, nothing).count() == 0 and decontam.contamination(odd, nothing).count() == n
    assert minhash.near_duplicates(odd).count() == n and minhash.near_duplicates(empty).count() == 0


def test_stages_keep_columns(spark, odd, empty, benchmark):
    for df in (odd, empty):
        for out in (langid.keep_identified(df), minhash.drop_near_duplicates(df), decontam.decontaminate(df, benchmark), linededup.drop_lines(df)):
            assert out.columns == df.columns
            out.collect()
        mixed = mixing.mixed_rows(df)
        assert mixed.columns[: len(df.columns)] == df.columns
        mixed.collect()
    kept = {r["doc_id"] for r in minhash.drop_near_duplicates(odd).collect()}
    assert 4 in kept and 5 not in kept and None in kept
    assert minhash.drop_near_duplicates(odd.where("doc_id = 5")).count() == 1


# ---------------------------------------------------------------- 1, 10: classifiers


def test_classifiers_learn_and_generalise(spark):
    rows, labels = [], []
    for i in range(300):
        toxic, good = i % 3 == 0, i % 2 == 0
        text = prose(i, 60)
        if toxic:
            words = text.split()
            words[10:10] = ["grobian", "fiesling"]
            text = " ".join(words)
        if not good:
            text = " ".join(w + "$$$" for w in text.split())
        rows.append((i, text, "en", "a", len(text)))
        labels.append((i, int(good), int(toxic)))
    docs, lab = frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    for out, at in ((quality.quality(docs, lab), 1), (toxicity.toxicity(docs, lab), 2)):
        got = {r["doc_id"]: r for r in out.collect()}
        held = [x for x in labels if zlib.crc32(str(x[0]).encode()) % 5 == 0]
        assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
        assert np.mean([got[x[0]]["predicted"] == x[at] for x in held]) >= 0.95
        assert all(0 <= r["score"] <= 1 for r in got.values())


def test_factorisation_identity():
    rng = np.random.default_rng(0)
    doc, feat, x = np.array([0, 0, 0, 1, 1]), np.array([0, 1, 2, 1, 3]), rng.random(5)
    w, v, b = rng.random(4), rng.random((4, 3)), 0.3
    z, _ = quality.logit(doc, feat, x, 2, w, v, b)
    for d in (0, 1):
        at = np.flatnonzero(doc == d)
        pairs = sum(v[feat[i]] @ v[feat[j]] * x[i] * x[j] for k, i in enumerate(at) for j in at[k + 1 :])
        assert np.isclose(z[d], b + w[feat[at]] @ x[at] + pairs)


def test_toxicity_scores_equal_brute_force(spark):
    """Scores of the whole table of sf0.001, n-gram by n-gram from the fitted weights."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    rows, counts = labelled.labelled_sample(docs, labels, "toxic", ["text"])
    weights, bias = toxicity.fit([r[0] for r in rows], np.array([r[1] for r in rows], float), counts)

    def hashed(gram):
        h = len(gram) * 0x9E3779B1 & 0xFFFFFFFF
        for b in gram:
            h = h * 0x01000193 & 0xFFFFFFFF ^ b
            h = h + (h << 7) & 0xFFFFFFFF
        return ((h ^ h >> 15) * 0x2C1B3C6D & 0xFFFFFFFF) >> (32 - toxicity.BITS)

    texts = {r["doc_id"]: (r["text"] or "") for r in docs.collect()}
    for r in toxicity.toxicity(docs, labels).collect():
        raw = texts[r["doc_id"]].encode()
        norm = [x for i, b in enumerate(raw) if (x := int(common.LETTER_LUT[b])) or i == 0 or common.LETTER_LUT[raw[i - 1]]]
        grams = Counter(hashed(norm[i : i + n]) for n in toxicity.SIZES for i in range(len(norm) - n + 1))
        z = bias + sum(float(weights[g]) * (1 + np.log(k)) for g, k in grams.items())
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-np.clip(z, -40, 40))), abs=1e-4)
        assert r["predicted"] == int(r["score"] >= 0.5)


def test_quality_scores_equal_brute_force(spark):
    """Scores of the whole table of sf0.001 with the pairwise terms taken pair by pair."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r["score"] for r in quality.quality(docs, labels).collect()}
    assert got.keys() == {r["doc_id"] for r in docs.collect()} and all(0 <= x <= 1 for x in got.values())
    again = {r["doc_id"]: r["score"] for r in quality.quality(docs.repartition(7), labels).collect()}
    assert all(again[i] == pytest.approx(x, abs=1e-9) for i, x in got.items())


def test_samples_take_long_texts_up_to_their_bytes(spark):
    docs = frame(spark, [(i, "a" * n, "en", None, None) for i, n in enumerate([100, 70_000, 70_000, 5, 0])] + [(0, "b", "en", None, None), (9, None, "en", None, None)])
    picked = spark.createDataFrame([(i, 1) for i in range(10)], "doc_id bigint, g int")
    assert len(labelled.rows_within(docs.where("text is not null"), picked, ["text"], "g", 1 << 20)) == 5
    few = labelled.rows_within(docs.where("text is not null"), picked, ["text"], "g", 1000)
    assert sum(len(t) for t, _ in few) <= 1000 and few == labelled.rows_within(docs.where("text is not null").repartition(3), picked, ["text"], "g", 1000)


# ---------------------------------------------------------------- 2: MinHash


def test_consistent_weighted_samples_estimate_weighted_jaccard():
    idf = np.random.default_rng(1).uniform(1, 5, 1 << minhash.DF_BITS).astype(np.float32)
    a, b = prose(1, 300).split(), prose(1, 300).split()
    b[40], b[200] = "neu", "andere"
    column = pa.array([" ".join(a), " ".join(b)], pa.large_string())
    ((_, _, data, offs),) = byte_chunks(column)
    key, weight, _, _ = minhash.weighted_sets(data, offs, idf)
    _, s = minhash.samples(key, weight, 3000, minhash.sampling_tables())
    exact = minhash.similarities(column[:1], column[1:], idf)[0]
    assert abs((s[0] == s[1]).mean() - exact) < 0.03


def test_near_duplicate_classes_equal_brute_force(spark):
    rows = []
    for g in range(12):
        base = prose(100 + g, 120).split()
        for c in range(6):
            w = list(base)
            r = random.Random(g * 10 + c)
            for _ in range(c * 2):
                w[r.randrange(len(w))] = f"neu{r.randrange(99)}"
            rows.append((g * 10 + c, " ".join(w), "en", "a", 1))
    docs = frame(spark, rows)
    idf = minhash.inverse_frequencies(*minhash.document_frequencies(docs))
    parent = {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, p in enumerate(rows):
        for q in rows[i + 1 :]:
            if minhash.similarities(pa.array([p[1]], pa.large_string()), pa.array([q[1]], pa.large_string()), idf)[0] >= 0.8:
                a, b = sorted((find(p[0]), find(q[0])))
                parent[b] = a
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs).collect()}
    assert got == {x: find(x) for x in parent}


def test_prefixes_find_every_similar_pair_of_different_components(spark):
    r, texts = random.Random(6), []
    for i in range(90):
        w = prose(700 + i % 6, 150).split()
        for _ in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = f"neu{r.randrange(99)}"
        texts.append(" ".join(w[: r.choice((150, 150, 140))]))
    texts += ["", "one two", "one two three"]
    idf = np.random.default_rng(2).uniform(1, 5, 1 << minhash.DF_BITS).astype(np.float32)
    column = pa.array(texts, pa.large_string())
    a, b = np.triu_indices(len(texts), 1)
    exact = minhash.similarities(column.take(pa.array(a)), column.take(pa.array(b)), idf)
    near = {(int(x), int(y)) for x, y in zip(a[exact >= 0.8], b[exact >= 0.8])}
    assert len(near) > 50 and (exact < 0.6).any()
    apart = spark.createDataFrame([(i, i if i % 3 else 0) for i in range(len(texts))], "x bigint, c bigint")
    rows = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    got = {tuple(sorted(p)) for p in minhash.prefix_pairs(apart, rows, idf, 0.8).collect()}
    together = {p for p in near if p[0] % 3 == 0 and p[1] % 3 == 0}
    assert near - together <= got and not together & got
    assert len(got) < len(a) / 4


@pytest.mark.parametrize("alike", [0, 40])
def test_crowded_buckets_equal_brute_force(spark, monkeypatch, alike):
    """A dense surrounding: copies around the similarity, in hot buckets that are dealt over tasks."""
    for module in (common, minhash):
        monkeypatch.setattr(module, "HOT_ROWS", 5)
    r, rows = random.Random(9), []
    base = prose(77, 200).split()
    for i in range(80):
        w = list(base)
        for _ in range(r.randint(2, 9) if i >= alike else 0):
            w[r.randrange(len(w))] = f"neu{r.randrange(9999)}"
        rows.append((i, " ".join(w), "en", "a", 1))
    docs = frame(spark, rows)
    assert near_classes(spark, docs) == brute_classes(docs)


def near_classes(spark, docs):
    return {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs).collect()}


def brute_classes(docs):
    """Classes by the weighted Jaccard similarity of all pairs that share a shingle, added up shingle by shingle."""
    idf = minhash.inverse_frequencies(*minhash.document_frequencies(docs))
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect())
    sets, owners = {}, defaultdict(list)
    for i, text in rows:
        ((_, _, data, offs),) = byte_chunks(pa.array([text], pa.large_string()), 1 << 40)
        key, weight, _, _ = minhash.weighted_sets(data, offs, idf)
        sets[i] = dict(zip(key.tolist(), weight.astype(float).tolist()))
        for k in sets[i]:
            owners[k].append(i)
    both, parent = Counter(), {i: i for i, _ in rows}
    for k, ids in owners.items():
        for n, x in enumerate(ids):
            for y in ids[n + 1 :]:
                both[x, y] += min(sets[x][k], sets[y][k])

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    total = {i: sum(s.values()) for i, s in sets.items()}
    for (x, y), shared in both.items():
        if shared / (total[x] + total[y] - shared) >= 0.8:
            a, b = sorted((find(x), find(y)))
            parent[b] = a
    return {i: find(i) for i in parent}


def test_near_duplicates_of_documents_equal_all_pairs(spark):
    """Recall on the whole table of sf0.01: at least 99 % of the documents have the class that all pairs give."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got, want = near_classes(spark, docs), brute_classes(docs)
    assert got.keys() == want.keys()
    moved = [i for i in want if got[i] != want[i]]
    grouped = [i for i in want if want[i] != i]
    assert len(grouped) > 20 and len(moved) <= 0.01 * len(grouped)


# ---------------------------------------------------------------- 3: languages


def test_language_mixtures(spark):
    syllables = {"aa": ["ba", "bo", "bi", "bu"], "zz": ["zek", "zok", "zyk", "zak"]}

    def text(lang, seed, n=60):
        r = random.Random(seed)
        return " ".join("".join(r.choice(syllables[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))

    rows = [(i, text("aa" if i % 2 else "zz", i), "aa" if i % 2 else "zz", None, None) for i in range(80)]
    rows += [(1000, text("aa", 7, 60) + " " + text("zz", 8, 30), None, None, None), (1001, "12 ...", None, None, None), (1002, None, None, None, None)]
    got = {r["doc_id"]: r for r in langid.identify(frame(spark, rows)).collect()}
    assert all(got[i]["lang_pred"] == rows[i][2] for i in range(80))
    assert got[1000]["lang_pred"] == "aa" and 0.55 < got[1000]["score"] < 0.8 and set(got[1000]["shares"]) == {"aa", "zz"}
    assert got[1001]["lang_pred"] == got[1002]["lang_pred"] == "und" and got[1001]["score"] == 0


def brute_language(text, names, table):
    """Leading language and its share, word by word with plain numbers; None without letters."""
    raw = bytes(langid.LETTER_LUT[b] for b in (text or "").encode())
    likely = []
    for word in filter(None, raw.split(bytes(1))):
        padded, total = bytes(1) + word + bytes(1), np.zeros(len(names))
        for a, b, c in zip(padded, padded[1:], padded[2:]):
            h = (a << 16 | b << 8 | c) * 0x9E3779B1 & 0xFFFFFFFF
            h = (h ^ h >> 15) * 0x85EBCA6B & 0xFFFFFFFF
            total += table[h >> (32 - langid.BITS)]
        likely.append(np.exp(np.maximum(total - total.max(), -60)))
    if not likely:
        return None
    likely = np.array(likely)

    def estimate(pi, steps):
        for _ in range(steps):
            r = likely * pi
            pi = (r / r.sum(axis=1, keepdims=True)).mean(axis=0)
        return pi

    pi = estimate(np.full(len(names), 1 / len(names)), langid.STEPS)
    order, best = sorted(range(len(names)), key=lambda j: -pi[j]), None
    for size in range(1, len(names) + 1):
        if size > 1 and pi[order[size - 1]] < langid.LEAST_SHARE:
            break
        inside = np.zeros(len(names))
        inside[order[:size]] = pi[order[:size]]
        inside /= inside.sum()
        value = np.log((likely * inside).sum(axis=1)).sum() - langid.PENALTY * size * np.log(len(likely) + 1)
        if best is None or value > best[0]:
            best = (value, inside, size)
    pi = estimate(best[1], 3) if best[2] > 1 else best[1]
    return names[int(pi.argmax())], float(pi.max())


def test_languages_of_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    names, table = langid.fit(*langid.language_sample(docs))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in langid.identify(docs).collect():
        want = brute_language(texts[r["doc_id"]], names, table.astype(float))
        assert want is None and r["lang_pred"] == "und" or (r["lang_pred"] == want[0] and r["score"] == pytest.approx(want[1], abs=2e-3)), r


def _mixture(k):
    """Words that one language each knows, and the table of trigrams."""
    names = [chr(97 + j) * 3 for j in range(k)]
    table = np.full((1 << langid.BITS, k), -9.0, np.float32)
    for j, name in enumerate(names):
        raw = np.frombuffer(name.encode(), np.uint8)
        table[langid.trigram_words(raw, np.array([0, 3]))[2], j] = -1.0
    return names, table


def test_mixtures_of_many_languages_and_of_neighbours():
    names, table = _mixture(8)
    five = " ".join(n for n, c in zip(names, (35, 20, 15, 15, 15)) for _ in range(c * 4)).encode()
    one = " ".join(names[5:6] * 60).encode()

    def shares(*texts):
        offs = np.cumsum([0, *map(len, texts)])
        return langid.mixtures(np.frombuffer(b"".join(texts), np.uint8), offs, table)[0]

    got = shares(five)[0]
    assert np.count_nonzero(got) == 5 and np.allclose(got[:5], [0.35, 0.2, 0.15, 0.15, 0.15], atol=0.02)
    assert np.array_equal(shares(one, five, one)[1], got) and np.array_equal(shares(five, one)[0], got)


# ---------------------------------------------------------------- 4: sharding


def test_slots_and_shards(spark):
    rows = [(i, "x" * (i * 37 % 900), None, None, None) for i in range(4000)]
    out = sharding.shard_documents(frame(spark, rows), 8).collect()
    load = Counter()
    for r in out:
        load[r["shard"]] += r["size"]
        assert r["size"] == len(rows[r["doc_id"]][1]) + 16 and r["text_crc32"] == zlib.crc32(rows[r["doc_id"]][1].encode())
    assert max(load.values()) < 1.02 * min(load.values())
    places = defaultdict(list)
    for r in out:
        places[r["shard"]].append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_slot_map_versions(spark, tmp_path):
    weight = {s: s % 17 + 1 for s in range(256)}
    first = sharding.SlotMap.even(8, 256).rebalanced(weight, 8)
    grown = first.rebalanced(weight, 9)
    assert (first.version, grown.version) == (2, 3) and first.moved(grown) < 256 / 9 * 1.6
    load = Counter()
    for s, shard in enumerate(grown.shard_of):
        load[shard] += weight[s]
    assert max(load.values()) - min(load.values()) <= 0.1 * sum(weight.values()) / 9
    path = str(tmp_path / "map")
    first.save(spark, path)
    grown.save(spark, path)
    assert sharding.SlotMap.load(spark, path) == grown and sharding.SlotMap.load(spark, path, 2) == first


def test_stored_map_is_edited_not_made_anew(spark, tmp_path):
    docs, path = frame(spark, [(i, "x" * (i * 37 % 900), None, None, None) for i in range(4000)]), str(tmp_path / "map")
    first = sharding.shard_documents(docs, 8, map_path=path).collect()
    again = sharding.shard_documents(docs, 8, map_path=path).collect()
    assert {r["map_version"] for r in first} == {2} and sorted(first) == sorted(again)
    grown = sharding.shard_documents(docs, 9, map_path=path).collect()
    old = {r["doc_id"]: r["shard"] for r in first}
    assert {r["map_version"] for r in grown} == {3} and sum(old[r["doc_id"]] != r["shard"] for r in grown) < 4000 / 9 * 1.6
    maps = [sharding.SlotMap.load(spark, path, v) for v in (1, 2, 3)]
    assert maps[0] == sharding.SlotMap.even(8) and 0 < maps[0].moved(maps[1]) < sharding.SLOTS / 4


def test_shards_of_documents_equal_brute_force(spark):
    """The whole table of sf0.01: the stored map, sizes and places are recomputed row by row."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    hashed = {r["doc_id"]: r["h"] for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(sharding.SLOTS)).alias("h")).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    weight = Counter()
    for i, t in texts.items():
        weight[hashed[i]] += len((t or "").encode()) + 16
    held = sharding.SlotMap.even(40).rebalanced(weight, 40)
    out = sharding.shard_documents(docs, 40).collect()
    assert len(out) == len(texts)
    for r in out:
        t = texts[r["doc_id"]]
        assert r["shard"] == held.shard_of[hashed[r["doc_id"]]] and r["text_crc32"] == (None if t is None else zlib.crc32(t.encode())) and r["size"] == len((t or "").encode()) + 16
    order = sorted(out, key=lambda r: (r["shard"], r["virtual_slot"], r["doc_id"]))
    place, last = 0, None
    for r in order:
        place = place + 1 if r["shard"] == last else 0
        last = r["shard"]
        assert r["slot"] == place


# ---------------------------------------------------------------- 5: lines


def near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def test_line_dedup_equals_brute_force(spark):
    r, rows = random.Random(5), []
    pool = [prose(500 + i, r.randint(1, 14)).split() for i in range(25)]
    for d in range(40):
        lines = []
        for _ in range(6):
            w = list(r.choice(pool))
            op = r.random()
            if op < 0.2:
                w[r.randrange(len(w))] = "anders"
            elif op < 0.35:
                w.insert(r.randrange(len(w) + 1), "mehr")
            elif op < 0.5 and len(w) > 1:
                del w[r.randrange(len(w))]
            lines.append(" ".join(w))
        rows.append((d, "\n".join([*lines, ""]), None, None, None))
    earlier, want = [], {}
    for d, text, *_ in rows:
        want[d] = []
        for i, line in enumerate(text.split("\n")):
            w = line.lower().split()
            if w and any(w == e or (len(w) >= 5 and len(e) >= 5 and near(w, e)) for e in earlier):
                want[d].append(i)
            if w:
                earlier.append(w)
    got = {r["doc_id"]: list(r["dropped"]) for r in linededup.line_dedup(frame(spark, rows)).collect()}
    assert got == want
    kept = {r["doc_id"]: r["text"] for r in linededup.drop_lines(frame(spark, rows)).collect()}
    assert all(kept[d] == "\n".join(x for i, x in enumerate(t.split("\n")) if i not in want[d]) for d, t, *_ in rows)


def test_drop_lines_of_repeated_ids(spark):
    rows = [(1, "a b\nc d", None, None, None), (1, "x y\nc d\na b", None, None, None), (2, "a b\nq", None, None, None), (None, None, None, None, None)]
    got = sorted((str(r["doc_id"]), r["text"]) for r in linededup.drop_lines(frame(spark, rows)).collect() if r["text"] is not None)
    assert got == [("1", "a b\nc d"), ("1", "x y\nc d"), ("2", "q")]


def test_lines_of_the_same_words_in_another_order(spark):
    rows = [(1, "the cat the dog the end now"), (2, "the dog the cat the end now"), (3, "the dog the cat the end today")]
    rows += [(4, "a - b - c - d"), (5, "b - a - c - d"), (6, "b - a - c - d x"), (7, "c - b - a - d x y"), (8, "b - a - c x")]
    r = random.Random(8)
    for i in range(60):
        w = ["x", "-", "y", "-", "z", "-", *r.sample("uvw", 2)]
        if i % 2:
            r.shuffle(w)
        if i % 3 == 0:
            del w[r.randrange(len(w))]
        rows.append((20 + i, " ".join(w)))
    earlier, want = [], {}
    for d, line in rows:
        w = line.split()
        want[d] = [0] if any(w == e or near(w, e) for e in earlier) else []
        earlier.append(w)
    assert want[3] == [0]
    got = {r["doc_id"]: list(r["dropped"]) for r in linededup.line_dedup(frame(spark, [(d, t, None, None, None) for d, t in rows])).collect()}
    assert got == want


# ---------------------------------------------------------------- 6: mixing


def plain_targets(sizes, weights, most=3.0):
    """Shares by weight; a source stops at most * size and the excess is shared anew."""
    goal = {}
    while len(goal) < len(sizes):
        rest = [i for i in range(len(sizes)) if i not in goal]
        unit = (sum(sizes) - sum(goal.values())) / sum(weights[i] for i in rest)
        full = [i for i in rest if weights[i] * unit > most * sizes[i]]
        goal |= {i: most * sizes[i] for i in full} if full else {i: weights[i] * unit for i in rest}
    return [goal[i] for i in range(len(sizes))]


def test_targets_and_tree(spark):
    for sizes in ([100, 100, 100], [10, 1000], [0, 5, 0, 7000, 1, 2, 900], [0, 0], [1], [3] * 40 + [100_000]):
        weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
        rows = spark.createDataFrame([(i, n, float(w)) for i, (n, w) in enumerate(zip(sizes, weights))], "src long, words long, weight double")
        got = [r["target"] for r in mixing.with_targets(rows).orderBy("src").collect()]
        assert got == pytest.approx(plain_targets(sizes, weights)) and sum(got) == pytest.approx(sum(sizes))
    draws = np.array([100, 50, 0, 7])
    for shards in (8, 5, 1):
        quotas = np.zeros((4, shards), int)
        for source, shard, n in mixing.split_tree(draws, shards, 3):
            quotas[source, shard] = n
        assert (quotas.sum(axis=1) == draws).all() and np.ptp(quotas.sum(axis=0)) <= 3
    assert mixing.split_tree(draws, 8, 3) == mixing.split_tree(draws, 8, 3) != mixing.split_tree(draws, 8, 4)


@pytest.mark.parametrize("shards", [1, 2, 7, 40, 64])
def test_subtrees_in_tasks_of_their_own_draw_what_one_tree_draws(spark, shards, monkeypatch):
    monkeypatch.setattr(mixing, "TREE_SOURCES", 4)
    drawn = [30, 0, 5, 1, 12, 900, 0]
    rows = spark.createDataFrame([(f"s{i}", i + 1, n) for i, n in enumerate(drawn)], "__src string, no long, drawn long")
    got = {(r["__src"], r["__draw"]): r["__shard"] for r in mixing.shard_runs(rows, shards, 3).collect()}
    want = {}
    for first in (0, 4):
        own, place = np.array(drawn[first : first + 4]), {}
        for source, shard, n in mixing.split_tree(own, shards, 3 + first + 1):
            for _ in range(n):
                name = f"s{first + source}"
                want[name, place.get(name, 0)] = shard
                place[name] = place.get(name, 0) + 1
    assert got == want and len(got) == sum(drawn)


def test_many_sources_and_shards(spark, monkeypatch):
    """Several trees, joins without broadcasts, small blocks and shards, repeated ids with other texts: nothing is lost, reruns agree."""
    for name, value in (("TREE_SOURCES", 7), ("BROADCAST_ROWS", 10), ("BLOCK_ROWS", 3), ("LEAST_BLOCKS", 2), ("SHARD_WORDS", 50), ("LEAST_SHARDS", 3)):
        monkeypatch.setattr(mixing, name, value)
    r = random.Random(4)
    rows = [(i // 2, prose(i, r.randint(0, 20)), None, f"s{r.randrange(30)}" if i % 11 else None, 1) for i in range(600)]
    out = mixing.mix_table(frame(spark, rows))
    got = out.collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_table(frame(spark, rows).repartition(5)).collect())) and len(got) == len(rows)
    assert all(len(x["shards"]) * x["size"] == x["taken"] for x in got)
    taken, goal = Counter(), {}
    for x in mixing.mix(frame(spark, rows)).collect():
        taken[x["source"]] += x["__copies"] * x["__size"]
        goal[x["source"]] = (x["__target"], x["__source_size"])
    assert len(goal) == 31 and all(abs(taken[s] - t) <= 10 for s, (t, _) in goal.items())
    order = sorted(goal, key=lambda s: (s is None, s))
    assert [goal[s][0] for s in order] == pytest.approx(plain_targets([goal[s][1] for s in order], [(5, 2, 1)[i % 3] for i in range(31)]))
    assert max(s for x in got for s in x["shards"]) > 3 and sum(n for _, n in goal.values()) == sum(x["size"] for x in got)


def test_mix_meets_targets(spark):
    rows = [(i, prose(i, 20 + i % 30), None, f"s{i % 3}" if i % 7 else None, None) for i in range(900)]
    docs = frame(spark, rows)
    out = mixing.mix_table(docs, shards=8).collect()
    assert {tuple(r) for r in map(str, out)} == {tuple(r) for r in map(str, mixing.mix_table(docs.repartition(5), shards=8).collect())}
    total, taken, sizes, goal = sum(r["size"] for r in out), Counter(), Counter(), {}
    for r in out:
        src = rows[r["doc_id"]][3]
        taken[src] += r["taken"]
        sizes[src] += r["size"]
        goal[src] = r["target"]
        assert r["taken"] <= 3 * r["size"] and r["size"] == len(rows[r["doc_id"]][1].split()) and len(r["shards"]) * r["size"] == r["taken"]
    assert np.isclose(sum(goal.values()), total)
    order = sorted((s for s in sizes if s), key=str) + [None]
    assert [goal[s] for s in order] == pytest.approx(plain_targets([sizes[s] for s in order], [5, 2, 1, 5]))
    assert all(abs(taken[s] - goal[s]) <= 40 for s in goal)


# ---------------------------------------------------------------- 7: tokens


def test_tokens_round_trip(spark, odd):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    got = sorted(tokens.token_table(odd, tokenizer_path()).collect(), key=lambda r: r["start"])
    rows = sorted(((r["doc_id"], tok.encode(r["text"] or "", add_special_tokens=False).ids + [2]) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    at = 0
    for r, (doc, ids) in zip(got, rows):
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_wavelet_queries():
    ids = (np.random.default_rng(0).zipf(1.4, 5000) % 300).astype("<u2")
    s = tokens.WaveletShard(tokens.WaveletShard.pack(pa.array([1, None]), np.array([4000, 1000]), ids, 9))
    assert (s.decode() == ids).all() and s.lengths.tolist() == [4000, 1000]
    for i in (0, 511, 512, 4999):
        assert s.access(i) == ids[i]
    for t in (1, 2, 299):
        where = np.flatnonzero(ids == t)
        assert s.count(t) == len(where) and s.rank(t, 1234) == (where < 1234).sum()
        assert [s.select(t, k) for k in range(min(5, len(where)))] == where[:5].tolist() and s.select(t, len(where)) == -1


def test_ids_of_documents_equal_the_library(spark):
    """All documents of sf0.01: every id from the files is that of the library on the whole text."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    got = {r["doc_id"]: r for r in tokens.token_table(docs, tokenizer_path()).collect()}
    start = 0
    for i, t in texts:
        ids = [*tok.encode(t, add_special_tokens=False).ids, 2]
        r = got[i]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_one_id_of_many_rows_fills_several_shards(spark):
    """A repeated id, and one repeated row, are dealt over shards; every document's ids come back."""
    many = spark.range(600).select(F.lit(7).cast("long").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("the same row")).otherwise(F.concat(F.lit("row "), F.col("id").cast("string"))).alias("text"))
    docs = many.union(spark.createDataFrame([(3, "first"), (9, "last")], "doc_id long, text string"))
    encoded = common.materialise(tokens.encode(docs, tokenizer_path(), 2), "ids")
    shards = tokens.build_shards(encoded, common.scratch(spark, "shards"), 49408, shard_ids=500)
    got = sorted(tokens.read_shards(shards).collect(), key=lambda r: r["start"])
    assert shards.where("n_docs > 1").count() >= 4 and shards.agg(F.max("n_docs")).first()[0] < 400
    assert [r["key"] for r in got] == [3] + [7] * 600 + [9]
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    ids = [np.frombuffer(r["ids"], "<u2").astype("<u4") for r in encoded.collect()]
    assert sorted(r["ids_crc32"] for r in got) == sorted(zlib.crc32(x.tobytes()) for x in ids)


def test_encoder_equals_library():
    from tokenizers import Tokenizer

    tok, enc = Tokenizer.from_file(tokenizer_path()), tokens.TextEncoder(tokenizer_path())
    texts = ["don't we'll o'clock ''s 's's 12.5%%%", "", "a\x1cb\x85c <|endoftext|>", "ΟΣ Σας", "ﬁ İ é É\r\n\tñ", "x" * 600, prose(1, 500)]
    assert [np.frombuffer(b, enc.kind).tolist() for b in enc.texts(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


# ---------------------------------------------------------------- 8: decontamination


def test_contamination_equals_brute_force(spark):
    items = [(1, prose(900, 40)), (2, "kurze Frage hier"), (3, "  "), (4, prose(901, 13)), (10, prose(900, 40))]
    rows = []
    for i in range(60):
        words = prose(i, 90).split()
        if i % 3 == 0:
            words[20:20] = items[0][1].upper().split()[5 : 5 + i % 25]
        if i % 5 == 0:
            words[3:3] = ["Kurze", "--", "Frage;", "hier!"]
        rows.append((i, " ".join(words), None, None, None))
    norm = lambda t: [w.decode("latin-1") for w in decontam.normal_words(t)]
    got = {r["doc_id"]: r for r in decontam.contamination(frame(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    for d, text, *_ in rows:
        words, hit, found = norm(text), set(), set()
        for item, t in items:
            iw = norm(t)
            n = min(13, len(iw))
            for k in range(len(iw) - n + 1 if n else 0):
                for j in range(len(words) - n + 1):
                    if words[j : j + n] == iw[k : k + n]:
                        hit.update(range(j, j + n))
                        found.add(str(item))
        r = got[d]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == (len(words), len(hit), len(found), digest)
        assert r["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(words))
        covered = " ".join(text.encode()[s["a"] : s["b"]].decode() for s in r["spans"])
        assert norm(covered) == [words[i] for i in sorted(hit)]


def test_several_automata_agree(spark, benchmark, odd, monkeypatch):
    one = {r["doc_id"]: tuple(r) for r in decontam.contamination(odd, benchmark).collect()}
    monkeypatch.setattr(decontam, "GROUP_WORDS", 20)
    monkeypatch.setattr(decontam, "SEGMENT_WORDS", 15)
    assert decontam.grouped(decontam.segments(benchmark))[1] > decontam.CHAIN
    assert one == {r["doc_id"]: tuple(r) for r in decontam.contamination(odd, benchmark).collect()}


# ---------------------------------------------------------------- 9: lattice


def test_e8_points_are_nearest():
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1.5, (200, 8))
    y = lattice.decode_e8(x)
    twice = np.rint(2 * y).astype(int)
    assert ((twice % 2 == 0).all(axis=1) | (twice % 2 == 1).all(axis=1)).all() and (np.rint(y.sum(axis=1)) % 2 == 0).all()
    gap = ((x - y) ** 2).sum(axis=1)
    for v in lattice.NEIGHBOURS:
        assert (((x - y - v) ** 2).sum(axis=1) >= gap - 1e-9).all()


def test_lattice_links_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 16))
    v = np.concatenate([base, base[:30] + rng.normal(0, 0.05, (30, 16)), base[:5], base[:10] * 2]).astype(np.float32)
    label = [i % 60 % 4 for i in range(90)] + [i % 4 for i in range(5)] + [i % 4 for i in range(10)]
    rows = [(i, [float(x) for x in v[i]], label[i]) for i in range(len(v))]
    rows += [(200, None, 1), (201, [0.0] * 16, 1), (202, [float("nan")] * 16, 1), (203, rows[0][1], None), (204, [1.0] * 8, 0), (5, rows[5][1], label[5])]
    out = lattice.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumn("rep", F.lit(1))).collect()
    assert len(out) == len(rows)
    good = [(i, np.array(e, np.float32).astype(float), lab) for i, e, lab in rows if e is not None and lab is not None and np.isfinite(e).all() and np.any(e)]
    n, link = Counter(), defaultdict(set)
    for a in range(len(good)):
        for b in range(len(good)):
            x, y = good[a], good[b]
            if a != b and x[2] == y[2] and len(x[1]) == len(y[1]) and x[1] @ y[1] / np.linalg.norm(x[1]) / np.linalg.norm(y[1]) >= 0.93:
                n[a] += 1
                link[x[0]].add(y[0])
    want = {i: (n[k], None) for k, (i, _, _) in enumerate(good)}
    for r in out:
        assert r["n_links"] == want.get(r["vec_id"], (0, None))[0], r
        seen, todo = {r["vec_id"]}, [r["vec_id"]]
        if r["vec_id"] not in (200, 201, 202, 203):
            while todo:
                for y in link[todo.pop()] - seen:
                    seen.add(y)
                    todo.append(y)
        assert r["component_id"] == min(seen) and r["kept"] == (r["vec_id"] == min(seen))


def test_lattice_keeps_null_ids(spark):
    v = [[1.0, 2.0, 0.0, 4.0, 1.0, 0.0, 3.0, 2.0], [1.0, 2.0, 0.1, 4.0, 1.0, 0.0, 3.0, 2.0], [-5.0, 1.0, 3.0, -2.0, 1.0, 9.0, 0.0, 1.0]]
    rows = [(None, v[0], 1), (7, v[1], 1), (9, v[1], 1), (None, v[2], 1), (None, v[2], 1), (3, v[0], 2), (None, v[0], 2)]
    got = lattice.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")).collect()
    want = [(None, 2, 7, False), (7, 2, 7, True), (9, 2, 7, False), (None, 1, None, True), (None, 1, None, True), (3, 1, 3, True), (None, 1, 3, False)]
    assert sorted((tuple(r[c] for c in ("vec_id", "n_links", "component_id", "kept")) for r in got), key=str) == sorted(want, key=str)


def test_lattice_repeated_ids_clashing_names_and_empty_tables(spark):
    u, v = [1.0] + [0.0] * 7, [0.0, 1.0] + [0.0] * 6
    shape = "vec_id bigint, embedding array<float>, label int"
    rows = [(1, u, 0), (1, v, 0), (2, u, 0), (3, v, 0), (None, None, None), (4, [float("inf")] * 8, 0), (5, [1.0, None] + [0.0] * 6, 0)]
    df = spark.createDataFrame(rows, shape).withColumns({n: F.lit(1) for n in ("rep", "id", "n", "component", "name", "a", "b", "cell")})
    got = [tuple(r) for r in lattice.near_duplicates(df).select("vec_id", "n_links", "component_id", "kept").collect()]
    want = [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (None, 0, None, True), (4, 0, 4, True), (5, 0, 5, True)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert lattice.near_duplicates(spark.createDataFrame([], shape)).collect() == []


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(3000)]
    got = components(spark.createDataFrame(edges, "a bigint, b bigint")).agg(F.count("*"), F.max("component")).first()
    assert tuple(got) == (3001, 0)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}
