"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source's documents are hashed into blocks of about ``BLOCK_ROWS`` documents; a seeded hash puts the blocks of a source in
a random order.  A source's target in words becomes block draws: whole passes over all its blocks, then blocks of one more
pass until the target is met.  The last block is entered document by document; a document is taken if at least half of it is
still due.  A tree then splits the draws among the output shards: each node gives its left half an exact number of draws,
shared among the sources by a multivariate-hypergeometric draw, so every shard's quotas are whole numbers that add up.  A
source's shards take consecutive runs of its permuted draws - disjoint by construction - and rows are ordered inside each
shard by a seeded hash.  All random numbers come from the seed, so reruns agree.

Blocks grow in number with a source's rows and shards with all words, so neither grows in size.  Sources, blocks and draws are
tables; sums of two numbers per round reach the driver while targets are levelled.  Trees are drawn inside tasks, each for
``TREE_SOURCES`` sources at most (the shards' totals are then at most one apart per tree and level); the upper levels of a tree are one
task, each of its subtrees is another.

Defined cases: a null or blank text has size 0 and nothing is taken; a null source is a source of its own, sorted last;
repeated rows are separate documents; an empty table gives an empty mix; a source without words has target 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
#: Documents of a block, and the least number of blocks that a source is hashed into.
BLOCK_ROWS = 2_000
LEAST_BLOCKS = 1_024
#: Words of a shard (some 50 MB of text), and the least number of shards.
SHARD_WORDS = 8_000_000
LEAST_SHARDS = 64
#: Sources of one tree.
TREE_SOURCES = 10_000
#: Rows of a source or block table that may be broadcast.
BROADCAST_ROWS = 200_000
WORD = "[^\\x20\\x09-\\x0D]+"


def with_targets(sources: DataFrame, weights=WEIGHTS, most: float = MOST_PASSES) -> DataFrame:
    """sources (src, words, weight) with target: shares of all words by weight, none above most * words.

    The level is what a unit of weight gets.  Sources that are full at a level stop there and the rest is shared anew, which
    only raises the level; each round is one aggregation of the source table, until the level stays.
    """
    full = lambda level: F.col("weight") * level > most * F.col("words")
    total, weight = sources.agg(F.sum("words"), F.sum("weight")).first()
    level, before = (total / weight if weight else 0.0), None
    while level != before:
        stopped, open_ = sources.agg(F.sum(F.when(full(level), most * F.col("words")).otherwise(0.0)), F.sum(F.when(full(level), 0.0).otherwise(F.col("weight")))).first()
        level, before = (max(level, (total - stopped) / open_) if open_ else level), level
    return sources.withColumn("target", F.when(full(level), most * F.col("words").cast("double")).otherwise(F.col("weight") * float(level)))


def split_nodes(draws: np.ndarray, low: int, high: int, seed: int, width: int = 1) -> list[tuple[int, int, int, int]]:
    """(source number, lo, hi, quota) of the quotas above 0 of the nodes below (low, high) with width shards at most: exact, summing to
    the draws of each source; the totals of shards are at most one apart per level.  A node's draw depends on seed, lo, hi and its own
    counts alone, so a subtree can be split by itself."""
    out: list[tuple[int, int, int, int]] = []
    todo = [(np.flatnonzero(draws), draws[draws > 0].astype(np.int64), low, high)]
    while todo:
        at, counts, lo, hi = todo.pop()
        if not len(at):
            continue
        if hi - lo <= width:
            out += [(int(s), lo, hi, int(c)) for s, c in zip(at, counts)]
            continue
        mid = (lo + hi) // 2
        n = int(counts.sum()) * (mid - lo) // (hi - lo)
        left = np.random.default_rng([seed, lo, hi]).multivariate_hypergeometric(counts, n, method="marginals") if n else counts * 0
        for part, a, b in ((left, lo, mid), (counts - left, mid, hi)):
            todo.append((at[part > 0], part[part > 0], a, b))
    return sorted(out)


def split_tree(draws: np.ndarray, shards: int, seed: int) -> list[tuple[int, int, int]]:
    """(source number, shard, quota) of the quotas above 0 of a whole tree."""
    return [(s, lo, n) for s, lo, _, n in split_nodes(draws, 0, shards, seed)]


def shard_runs(per_source: DataFrame, shards: int, seed: int) -> DataFrame:
    """(__src, __draw, __shard): the shard of every draw.  per_source: __src, no (place in code-point order, from 1), drawn.

    The upper half of a tree's levels is drawn in one task, each subtree below in a task of its own: a task holds about the square root
    of shards for each of its sources, and draws what one task for the whole tree would.
    """
    width = max(1, int(shards**0.5))
    nodes = "tree long, no long, __src string, low int, high int, n long, begin long"

    def split(rows: pd.DataFrame, low: int, high: int, least: int, of: str) -> pd.DataFrame:
        rows = rows.sort_values("no", ignore_index=True)
        own_seed = seed + int(rows["tree"].iloc[0]) * TREE_SOURCES + 1
        out = pd.DataFrame(split_nodes(rows[of].to_numpy(np.int64), low, high, own_seed, least), columns=["at", "low", "high", "n"])
        at = out["at"].to_numpy(np.int64)
        begin = out.groupby("at")["n"].cumsum() - out["n"] + rows["begin"].to_numpy(np.int64)[at]
        return pd.DataFrame({"tree": rows["tree"].to_numpy()[at], "no": rows["no"].to_numpy()[at], "__src": rows["__src"].to_numpy()[at], "low": out["low"], "high": out["high"], "n": out["n"], "begin": begin})

    def upper(rows: pd.DataFrame) -> pd.DataFrame:
        return split(rows, 0, shards, width, "drawn")

    def lower(rows: pd.DataFrame) -> pd.DataFrame:
        return split(rows, int(rows["low"].iloc[0]), int(rows["high"].iloc[0]), 1, "n")

    trees = per_source.withColumns({"tree": F.floor((F.col("no") - 1) / TREE_SOURCES), "begin": F.lit(0).cast("long")})
    runs = trees.groupBy("tree").applyInPandas(upper, nodes).groupBy("tree", "low").applyInPandas(lower, nodes)
    draws = F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("n") - 1)).alias("__draw")
    return runs.select("__src", draws, F.col("low").alias("__shard"))


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _small(table: DataFrame) -> DataFrame:
    """The table, to be broadcast if its counted rows are few."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def mix(docs: DataFrame, shards: int | None = None, seed: int = 7, weights=WEIGHTS, most: int = MOST_PASSES, size: str | None = None, text_hash: str | None = None) -> DataFrame:
    """docs with __size, __source_size, __target, __copies (times the document is taken) and __shards (one per copy).

    size, text_hash: columns that already hold the word count and a hash of the text.
    """
    source = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("t"))  # a null source sorts last
    counted = materialise(docs.groupBy(source.alias("__src")).agg(F.greatest(F.lit(LEAST_BLOCKS), F.ceil(F.count("*") / BLOCK_ROWS)).cast("int").alias("__blocks")), "sources")
    rows = docs.withColumns(
        {
            "__size": F.col(size) if size else word_count(F.col("text")),
            "__src": source,
            "__order": F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source"), F.col(text_hash) if text_hash else F.xxhash64("text")),
        }
    )
    rows = rows.join(_small(counted), "__src").withColumn("__block", F.pmod(F.xxhash64(F.lit(seed + 1), F.col("__order")), F.col("__blocks")).cast("int")).drop("__blocks")
    blocks = rows.groupBy("__src", "__block").agg(F.sum("__size").alias("words"))
    turn = Window.partitionBy("__src").orderBy(F.xxhash64(F.lit(seed + 2), F.col("__src"), F.col("__block")), "__block")
    blocks = blocks.select(
        "__src",
        "__block",
        "words",
        (F.row_number().over(turn) - 1).cast("long").alias("nth"),
        F.sum("words").over(turn.rowsBetween(Window.unboundedPreceding, 0)).alias("until"),
    )
    blocks = materialise(blocks, "blocks")
    sources = blocks.groupBy("__src").agg(F.sum("words").alias("words"), F.count("*").alias("n_blocks"))
    sources = sources.withColumn("no", F.row_number().over(Window.orderBy("__src")).cast("long"))  # one row a source
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("no") - 1) % len(weights)).cast("int"))
    facts = with_targets(materialise(sources.withColumn("weight", weight), "sources"), weights, most)
    passes = F.when(F.col("words") > 0, F.least(F.lit(most), F.floor(F.col("target") / F.col("words")))).otherwise(0)
    facts = facts.withColumn("passes", passes.cast("long")).withColumn("due", F.col("target") - F.col("passes") * F.col("words"))
    facts = materialise(facts.withColumnRenamed("words", "source_words"), "facts")
    blocks = blocks.join(_small(facts), "__src").withColumns(
        {
            "whole": F.col("passes") + (F.col("until") <= F.col("due")).cast("int"),
            "entered": (F.col("due") < F.col("until")) & (F.col("due") > F.col("until") - F.col("words")),
        }
    )
    # Draws are numbered pass by pass; the entered block is drawn once more than the whole ones.
    blocks = materialise(blocks.withColumn("drawn", F.col("whole") + F.col("entered").cast("long")), "drawn")
    per_source = blocks.groupBy("__src", "no").agg(F.sum("drawn").alias("drawn"))
    shards = shards or max(LEAST_SHARDS, -(-int(facts.agg(F.sum("source_words")).first()[0] or 0) // SHARD_WORDS))
    draws = blocks.where("drawn > 0").select("__src", "__block", "n_blocks", "nth", F.posexplode(F.sequence(F.lit(1).cast("long"), "drawn")).alias("pass", "_"))
    draws = draws.select("__src", "__block", "pass", (F.col("pass") * F.col("n_blocks") + F.col("nth")).alias("__draw"))
    of_shards = draws.join(shard_runs(per_source, shards, seed), ["__src", "__draw"]).groupBy("__src", "__block")
    of_shards = of_shards.agg(F.transform(F.array_sort(F.collect_list(F.struct("pass", "__shard"))), lambda s: s["__shard"]).alias("__shards"))
    rest = F.when(F.col("entered"), F.col("due") - (F.col("until") - F.col("words"))).alias("__rest")
    plan = blocks.select("__src", "__block", F.col("source_words").alias("__source_words"), F.col("target").alias("__goal"), F.col("whole").alias("__whole"), rest)
    plan = plan.join(of_shards, ["__src", "__block"], "left").withColumn("__shards", F.coalesce("__shards", F.array().cast("array<int>")))
    rows = rows.join(_small(materialise(plan, "plan")), ["__src", "__block"])
    inside = Window.partitionBy("__src", "__block").orderBy("__order", "__size").rowsBetween(Window.unboundedPreceding, -1)
    plain = rows.where("__rest is null").withColumn("__copies", F.col("__whole"))
    cut = (  # one block of each source
        rows.where("__rest is not null")
        .withColumn("__before", F.coalesce(F.sum("__size").over(inside), F.lit(0)))
        .withColumn("__copies", F.col("__whole") + (F.col("__before") + F.col("__size") / 2 <= F.col("__rest")).cast("long"))
        .drop("__before")
    )
    out = plain.unionByName(cut).withColumn("__copies", F.when(F.col("__size") > 0, F.col("__copies")).otherwise(F.lit(0)))
    return out.select(
        *docs.columns,
        "__size",
        F.col("__source_words").alias("__source_size"),
        F.col("__goal").alias("__target"),
        "__copies",
        F.expr("slice(__shards, 1, cast(__copies as int))").alias("__shards"),
        "__order",
    )


def mixed_rows(docs: DataFrame, shards: int | None = None, seed: int = 7) -> DataFrame:
    """The mix itself: one row per copy, the columns of docs, __shard and __turn (the shuffled order inside the shard)."""
    taken = mix(docs, shards, seed).where("__copies > 0")
    copies = taken.select(*docs.columns, "__order", F.posexplode("__shards").alias("__pass", "__shard"))
    return copies.select(*docs.columns, "__shard", F.xxhash64(F.lit(seed + 3), "__shard", "__order", "__pass").alias("__turn"))


def mix_table(docs: DataFrame, shards: int | None = None, seed: int = 7) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, shards.  Texts are read once, for word counts and hashes."""
    sizes = materialise(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash")), "sizes")
    return mix(sizes, shards, seed, size="size", text_hash="text_hash").select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__copies") * F.col("__size")).alias("taken"),
        F.col("__shards").alias("shards"),
    )
