"""The prefix trie of conversations by splitters and a skeleton.

A conversation is a path of turn digests (16 bytes of SHA-256 of role and text); every distinct prefix of a path is a node.  Splitters, the
quantiles of a hash sample of paths with their ids, cut the order of all paths into shards, and the trie of the splitters' paths - the
skeleton - is broadcast.  Inside a shard rows are sorted by path and id, and one pass with a stack of open nodes finishes every
node off the skeleton: all its members lie in this shard.  A node on the skeleton may have members in several shards; each of them gives a
partial aggregate, and these are added up by node and then from the leaves of the skeleton to its root.  Splitters hold ids too, so a
group of equal conversations of any size is cut as well.

What is bounded: a conversation is one row of 24 bytes a turn, without its texts; a shard's rows pass one at a time; open nodes are as deep as one conversation, finished children wait for their
parent's smallest member inside their shard; the splitters number ``MOST_SHARDS`` at most, and their paths ``MOST_TURNS`` turns
together (64 MB), else fewer splitters are taken.  The skeleton has at most as many nodes as that, and only it reaches the driver.
The hash over the members that end at a node is taken as their ids pass in order; for skeleton nodes, over their shards' pieces one after
the other.

Defined cases: a null conv_id is left out; null role or text is empty; a null turn comes first; turns of one number are ordered by
role, then by digest; repeated rows are turns of their own; a conversation without turns left ends at the root; an empty table
gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise

#: Conversations a shard has on average, and shards at most.
SHARD_CONVERSATIONS = 4000
MOST_SHARDS = 4096
#: Turns of all splitters together; sampled conversations for each splitter.
MOST_TURNS = 1 << 22
OVERSAMPLE = 8
#: Ids in a piece of a skeleton node's list of ends.
PIECE = 4096

OUTPUT = "kind int, skel int, shard int, piece long, conv_id long, depth long, parent_conv_id long, parent_skel int, n_convs long, n_children long, n_leaves long, saved_tokens long, words long, ends string"
NAMES = [c.split()[0] for c in OUTPUT.split(", ")]
_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
_SCHEMA = pa.schema([(c.split()[0], _ARROW[c.split()[1]]) for c in OUTPUT.split(", ")])
NODE, PARTIAL, ENDS = 0, 1, 2


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))


def turn_lists(conversations: DataFrame) -> DataFrame:
    """conv_id, turns (array of digest and words, in order) of every conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.length(role), F.lit(":"), role, text), 256)), 1, 16)
    rows = conversations.where("conv_id is not null").select("conv_id", F.struct("turn", role.alias("role"), digest.alias("digest"), word_count(text).cast("long").alias("words")).alias("t"))
    rows = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return rows.select("conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))


def rebuilt(turns: DataFrame, group: int = 20, shared: int = 4) -> DataFrame:
    """conv_id, turns with the first h turns taken from the conversation conv_id - conv_id % group; h is crc32(conv_id) % shared.

    The remainder of a negative id is that of SQL, with the id's sign.
    """
    first = turns.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, shared - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")
    rows = turns.withColumns({"base": F.col("conv_id") - F.col("conv_id") % group, "h": h}).join(first, "base", "left")
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    head = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("h")))
    return rows.select("conv_id", F.concat(head, own).alias("turns"))


def splitters(paths: DataFrame, per_shard: int, most_turns: int = MOST_TURNS) -> list[tuple[list[bytes], int]]:
    """Sorted (path, conv_id) that cut the paths (conv_id, path, words) into shards; the cuts only decide who works on what."""
    n = paths.count()
    shards = min(MOST_SHARDS, -(-n // per_shard))
    if shards < 2:
        return []
    share = min(1.0, OVERSAMPLE * shards / n)
    sample = lambda part: paths.where(F.xxhash64("conv_id") / F.lit(2.0**64) + 0.5 < part)
    turns = sample(share).agg(F.sum(F.size("path") + 1)).first()[0] or 0
    share *= min(1.0, most_turns / max(1, turns))
    rows = sorted((list(map(bytes, r["path"])), r["conv_id"]) for r in sample(share).select("path", "conv_id").collect())
    shards = min(shards, len(rows))
    return [rows[i * len(rows) // shards] for i in range(1, shards)]


def skeleton(cuts: list[tuple[list[bytes], int]]) -> dict[tuple[int, bytes], int]:
    """(node, digest) to node of the trie of the splitters' paths; the root is 0, and nodes are numbered after their parents."""
    trie: dict[tuple[int, bytes], int] = {}
    for path, _ in cuts:
        node = 0
        for digest in path:
            node = trie.setdefault((node, digest), len(trie) + 1)
    return trie


class _Open:
    """A node with its members so far."""

    __slots__ = ("skel", "depth", "words", "least", "members", "children", "leaves", "saved", "ends", "waiting")

    def __init__(self, skel: int | None, depth: int, words: int):
        self.skel, self.depth, self.words = skel, depth, words
        self.least, self.members, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends = [] if skel is not None else None  # ids of a skeleton node, else a hash once a member ends here
        self.waiting: list[tuple] = []  # finished children


NOTHING = hashlib.sha256(b"").hexdigest()


class _Shard:
    """One pass over a shard's sorted rows; finished rows are in out."""

    def __init__(self, shard: int, trie: dict[tuple[int, bytes], int]):
        self.shard, self.trie, self.piece, self.out = shard, trie, 0, []
        self.path: list[bytes] = []
        self.open = [_Open(0, 0, 0)]

    def add(self, conv: int, path: list[bytes], words: list[int]) -> None:
        same, most = 0, min(len(path), len(self.path))
        while same < most and path[same] == self.path[same]:
            same += 1
        while len(self.open) > same + 1:
            self.close()
        for depth in range(same, len(path)):
            above = self.open[-1]
            skel = None if above.skel is None else self.trie.get((above.skel, path[depth]))
            self.open.append(_Open(skel, depth + 1, words[depth]))
        self.path = path
        end = self.open[-1]
        end.members += 1
        end.least = conv if end.least is None else min(conv, end.least)
        if end.skel is None:
            if end.ends is None:
                end.ends = hashlib.sha256(str(conv).encode())
            else:
                end.ends.update(f",{conv}".encode())
        else:
            end.ends.append(conv)
            if len(end.ends) >= PIECE:
                self.flush(end)

    def flush(self, node: _Open) -> None:
        if node.ends:
            self.out.append((ENDS, node.skel, self.shard, self.piece, *[None] * 9, ",".join(map(str, node.ends))))
            self.piece += 1
            node.ends = []

    def close(self) -> None:
        node = self.open.pop()
        above = self.open[-1] if self.open else None
        if above is not None:
            above.members += node.members
            above.least = node.least if above.least is None else min(node.least, above.least)
        if node.skel is not None:
            self.flush(node)
            if node.members:
                self.out.append((PARTIAL, node.skel, self.shard, None, node.least, node.depth, None, None, node.members, node.children, node.leaves, node.saved, node.words, None))
            return
        leaves = node.leaves if node.children else 1
        saved = node.saved + (node.members - 1) * node.words
        ends = node.ends.hexdigest() if node.ends is not None else NOTHING
        above.children += 1
        above.leaves += leaves
        above.saved += saved
        for row in node.waiting:
            self.out.append((NODE, None, None, None, row[0], row[1], node.least, None, *row[2:6], None, row[6]))
        row = (node.least, node.depth, node.members, node.children, leaves, saved, ends)
        if above.skel is None:
            above.waiting.append(row)
        else:
            self.out.append((NODE, None, None, None, row[0], row[1], None, above.skel, *row[2:6], None, row[6]))

    def finish(self) -> None:
        while self.open:
            self.close()


def _batches(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SCHEMA.types)], schema=_SCHEMA)


def pieces(paths: DataFrame, cuts: list[tuple[list[bytes], int]]) -> DataFrame:
    """Rows of OUTPUT: nodes off the skeleton, partial aggregates of skeleton nodes, and pieces of their lists of ends."""
    model = paths.sparkSession.sparkContext.broadcast((cuts, skeleton(cuts)))  # MOST_TURNS digests at most

    def place(batches):
        cuts = model.value[0]
        for batch in batches:
            keys = zip(batch.column(1).to_pylist(), batch.column(0).to_pylist())
            shard = pa.array([bisect.bisect_right(cuts, (p, c)) for p, c in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shard], [*batch.schema.names, "shard"])

    def walk(batches):
        trie, now = model.value[1], None
        for batch in batches:
            for conv, path, words, shard in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.shard != shard:
                    if now is not None:
                        now.finish()
                        yield _batches(now.out)
                    now = _Shard(shard, trie)
                now.add(conv, path, words)
            if now is not None and now.out:
                yield _batches(now.out)
                now.out = []
        if now is not None:
            now.finish()
            yield _batches(now.out)

    placed = paths.mapInArrow(place, "conv_id long, path array<binary>, words array<long>, shard int")
    dealt = placed.repartition(max(1, len(cuts) + 1), "shard").sortWithinPartitions("shard", "path", "conv_id")
    return dealt.mapInArrow(walk, OUTPUT)


def ends_of_skeleton(rows: DataFrame) -> dict[int, str]:
    """Skeleton node to the hash over its pieces, in the order of shards; a hash has to take them one after the other."""

    def run(batches):
        now, state = None, None
        for batch in batches:
            for skel, ends in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                if skel != now:
                    if now is not None:
                        yield now, state.hexdigest()
                    now, state = skel, hashlib.sha256(ends.encode())
                else:
                    state.update(f",{ends}".encode())
        if now is not None:
            yield now, state.hexdigest()

    def packed(batches):
        for skel, digest in run(batches):
            yield pa.RecordBatch.from_arrays([pa.array([skel], pa.int32()), pa.array([digest])], ["skel", "ends"])

    parts = rows.where(F.col("kind") == ENDS).select("skel", "shard", "piece", "ends")
    parts = parts.repartition("skel").sortWithinPartitions("skel", "shard", "piece")
    return {r["skel"]: r["ends"] for r in parts.mapInArrow(packed, "skel int, ends string").collect()}


def skeleton_nodes(rows: DataFrame, cuts: list[tuple[list[bytes], int]]) -> list[tuple]:
    """(skel, conv_id, depth, parent's conv_id, n_convs, n_children, n_leaves, saved_tokens, ends) of each skeleton node."""
    parent = {node: above for (above, _), node in skeleton(cuts).items()}
    sums = rows.where(F.col("kind") == PARTIAL).groupBy("skel").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("words").alias("words"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    part = {r["skel"]: r.asDict() for r in sums.collect()}
    ends = ends_of_skeleton(rows)
    for node in sorted(part, reverse=True):  # children have higher numbers than their parents
        own = part[node]
        own["n_leaves"] = own["n_leaves"] if own["n_children"] else 1
        own["saved_tokens"] += (own["n_convs"] - 1) * own["words"]
        if node:
            above = part[parent[node]]
            above["n_children"] += 1
            above["n_leaves"] += own["n_leaves"]
            above["saved_tokens"] += own["saved_tokens"]
    return [
        (n, p["conv_id"], p["depth"], part[parent[n]]["conv_id"] if n else None, p["n_convs"], p["n_children"], p["n_leaves"], p["saved_tokens"], ends.get(n, NOTHING))
        for n, p in sorted(part.items())
    ]


def prefix_trie(turns: DataFrame, per_shard: int = SHARD_CONVERSATIONS) -> DataFrame:
    """One row per node of the trie of turns (conv_id, turns: array of digest and words): conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    path = lambda field: F.transform("turns", lambda t: t[field])
    paths = materialise(turns.select("conv_id", path("digest").alias("path"), path("words").alias("words")), "paths")
    cuts = splitters(paths, per_shard)
    rows = materialise(pieces(paths, cuts), "pieces")
    bones = skeleton_nodes(rows, cuts)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    kinds = [T.IntegerType(), *[T.LongType()] * 7, T.StringType()]
    bones = turns.sparkSession.createDataFrame(bones, T.StructType([T.StructField(c, k) for c, k in zip(["skel", *columns], kinds)]))
    above = F.broadcast(bones.select(F.col("skel").alias("parent_skel"), F.col("conv_id").alias("above")))  # a row for each skeleton node
    nodes = rows.where(F.col("kind") == NODE).withColumnRenamed("ends", "ends_sha256").join(above, "parent_skel", "left")
    nodes = nodes.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")).select(*columns)
    return nodes.unionByName(bones.select(*columns))


def conversation_trie(conversations: DataFrame, per_shard: int = SHARD_CONVERSATIONS) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return prefix_trie(rebuilt(turn_lists(conversations)), per_shard)
