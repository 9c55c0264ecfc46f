"""The trie against brute force, however many shards cut it."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strandline.llm import trie

TURNS = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            digest = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()[:16]
            own[c].append(((t is not None, t or 0, role or "", digest), (role or "", text or "")))
    own = {c: [x for _, x in sorted(v)] for c, v in own.items()}
    paths = {c: tuple(own.get(c - int(math.fmod(c, 20)), [])[: zlib.crc32(str(c).encode()) % 4] + v[zlib.crc32(str(c).encode()) % 4 :]) for c, v in own.items()}
    members, children, leaves, saved, out = defaultdict(list), defaultdict(list), {}, {}, []
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        saved[p] = sum(saved[k] for k in children[p]) + (len(members[p]) - 1) * words
        ends = ",".join(str(c) for c in sorted(c for c in members[p] if len(paths[c]) == len(p)))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(conversations, per_shard=trie.SHARD_CONVERSATIONS):
    return sorted((tuple(r) for r in trie.conversation_trie(conversations, per_shard).collect()), key=str)


def alike(seed, n, hot=0):
    """Conversations that share much, and a group of equal ones."""
    r = random.Random(seed)
    rows = [(c, t, r.choice(["u", "a"]), r.choice(["x", "y z", "w  w\tw", ""])) for c in range(n) for t in range(r.randrange(1, 7))]
    return rows + [(1000 * 20 + c, t, "u", f"same {t}") for c in range(hot) for t in range(5)]


@pytest.mark.parametrize("per_shard", [1, 3, 40, 4000])
def test_trie_equals_brute_force(spark, per_shard):
    rows = alike(per_shard, 150, hot=150)  # the group of copies is half of the conversations, and larger than most shards
    assert found(spark.createDataFrame(rows, TURNS), per_shard) == brute(rows)


@pytest.mark.parametrize("per_shard", [5, 4000])
def test_trie_of_conversations_equals_brute_force(spark, per_shard):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    got = trie.conversation_trie(df, per_shard)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert all(t == "bigint" for c, t in got.dtypes if c != "ends_sha256")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_long_lists_of_ends_go_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 4)  # reaches the tasks with the class's code only on one machine; results are the same either way
    rows = alike(9, 5, hot=300)
    assert found(spark.createDataFrame(rows, TURNS), 20) == brute(rows)


def test_splitters_keep_their_bound(spark):
    paths = trie.rebuilt(trie.turn_lists(spark.createDataFrame(alike(2, 400), TURNS))).select("conv_id", F.col("turns.digest").alias("path"), F.col("turns.words").alias("words"))
    cuts = trie.splitters(paths, 10)
    assert 20 <= len(cuts) <= 40 and cuts == sorted(cuts)
    few = trie.splitters(paths, 10, most_turns=60)
    assert len(few) < len(cuts) and sum(len(p) for p, _ in few) <= 60
    bones = trie.skeleton(cuts)
    assert all(above < node for (above, _), node in bones.items()) and len(bones) <= sum(len(p) for p, _ in cuts)


def test_odd_rows_and_empty_tables(spark):
    rows = [(None, 1, "u", "x"), (0, None, None, None), (0, None, "u", "x"), (0, 1, "u", "x"), (0, 1, "u", "x"), (0, 1, "a", "x"), (3, 0, "u", "long " * 20_000), (-5, 1, "u", "x"), (20, 5, None, "x"), (41, 2, "", None), (41, 1, "", "y")]
    rows += [(c, 0, "u", "x") for c in range(60, 90)]  # without turns of their own after the first ones
    df = spark.createDataFrame(rows, TURNS)
    assert found(df) == brute(rows) and found(df, 2) == brute(rows)
    assert found(spark.createDataFrame([], TURNS)) == [] and found(spark.createDataFrame([(None, 1, "u", "x")], TURNS)) == []
    named = df.withColumns({c: F.lit("1") for c in ("turns", "path", "words", "shard", "h", "base", "head", "kind", "skel", "t")})
    assert found(named, 4) == brute(rows)
