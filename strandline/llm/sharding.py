"""Sharding by fixed virtual slots (DataFrame functions only).

Records are hashed by their id into ``slots`` virtual slots, a number that never changes.  Bytes and rows are added up
per slot (a table of at most ``slots`` rows), and a versioned map says which shard holds which slot.  Growing, shrinking
or rebalancing edits the map: whole slots move, records are never hashed again.

Law ``bytes``: a map that starts out even (version 1: equal runs of slots) is rebalanced by the slots' bytes, as any later map
is: overfull shards give slots away, the lightest shards take them, and the edited map is stored as the next version, so the
shards' bytes come out near equal.  A place inside a shard is the rows of the shard's earlier slots plus the place inside
the slot, so no task ever sorts a whole shard.

Defined cases: a null text counts as empty with a null checksum; a null doc_id is hashed like a value; repeated rows
share a slot and get places of their own; an empty table gives an empty result.  Equal texts of different ids are hashed
apart, so a large group of copies is spread over all slots.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 4096
ROW_BYTES = 16


@dataclass(frozen=True)
class SlotMap:
    """Which shard holds each slot; edits give a map of the next version."""

    version: int
    shards: int
    shard_of: tuple[int, ...]

    @classmethod
    def even(cls, shards: int, slots: int = SLOTS) -> SlotMap:
        """A map before any data: consecutive runs of slots of equal number."""
        return cls(1, shards, tuple(slot * shards // slots for slot in range(slots)))

    def rebalanced(self, weight: dict[int, int], shards: int, tolerance: float = 0.002) -> SlotMap:
        """The next version for new weights or another number of shards, moving few slots.

        Slots of closed shards are free; a shard above the mean gives its heaviest slots that leave it within the tolerance
        of the mean; free slots go to the lightest shards, heaviest first.  A slot may overfill its new shard, so this is
        repeated as long as the fullest shard gets lighter.
        """
        of = lambda slot: weight.get(slot, 0)
        out, mean = list(self.shard_of), sum(weight.values()) / shards
        free, best, kept = [slot for slot, shard in enumerate(out) if shard >= shards], None, list(out)
        if not free:  # the map itself is the one to better: else it stays as it is
            held = [0] * shards
            for slot, shard in enumerate(out):
                held[shard] += of(slot)
            best = max(held)
        while True:
            load, own = [0] * shards, [[] for _ in range(shards)]
            for slot in set(range(len(out))).difference(free):
                own[out[slot]].append(slot)
                load[out[slot]] += of(slot)
            for shard in range(shards):
                for slot in sorted(own[shard], key=lambda s: (-of(s), s)):
                    if of(slot) and load[shard] - of(slot) >= mean * (1 - tolerance):
                        free.append(slot)
                        load[shard] -= of(slot)
            heap = [(x, s) for s, x in enumerate(load)]
            heapq.heapify(heap)
            for slot in sorted(free, key=lambda s: (-of(s), s)):
                x, out[slot] = heap[0]
                heapq.heapreplace(heap, (x + of(slot), out[slot]))
            fullest = max(x for x, _ in heap)
            if best is not None and fullest >= best:
                return SlotMap(self.version + 1, shards, tuple(kept))
            best, kept, free = fullest, list(out), []

    def moved(self, other: SlotMap) -> int:
        return sum(a != b for a, b in zip(self.shard_of, other.shard_of))

    def save(self, spark: SparkSession, path: str) -> None:
        """Append this version to the map table: version, shards, slot, shard."""
        slots = spark.range(len(self.shard_of)).select(
            F.lit(self.version).alias("version"), F.lit(self.shards).alias("shards"), F.col("id").alias("slot"), looked_up(self.shard_of, F.col("id")).cast("int").alias("shard")
        )
        slots.coalesce(1).write.mode("append").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        """The newest version, or the one asked for (a table of a fixed number of rows per version)."""
        rows = spark.read.parquet(path)
        version = version or rows.agg(F.max("version")).first()[0]
        got = rows.where(F.col("version") == version).orderBy("slot").collect()
        return cls(version, got[0]["shards"], tuple(r["shard"] for r in got))


def looked_up(values, index: Column) -> Column:
    """values[index] for a fixed, short list of whole numbers, as one constant."""
    constant = F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")
    return F.element_at(constant, (index + 1).cast("int"))


def newest_map(spark: SparkSession, path: str | None, shards: int, slots: int) -> SlotMap:
    """The newest version of the map table; an even map, stored as its first version, where there is none."""
    folder = path and spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder and folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return SlotMap.load(spark, path)
    first = SlotMap.even(shards, slots)
    if path:
        first.save(spark, path)
    return first


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots))


def slot_statistics(rows: DataFrame) -> DataFrame:
    """Rows and bytes of each virtual slot."""
    return rows.groupBy("virtual_slot").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))


def sized(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        slot_of(F.col("doc_id"), slots).alias("virtual_slot"),
    )


def shard_documents(docs: DataFrame, shards: int, slots: int = SLOTS, held: SlotMap | None = None, map_path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (place in the shard), grown_shard, virtual_slot, map_version.

    held: a map to keep as it is.  map_path: where the map table is kept, every version of it; without one it starts with an
    even map.  The newest version there is rebalanced by the slots' bytes (and to the number of shards), and if slots move, the
    edited map is stored as the next version.
    """
    stats = {r["virtual_slot"]: (r["rows"], r["bytes"]) for r in slot_statistics(sized(docs, slots)).collect()}  # at most `slots` rows
    if held is None:
        held = newest_map(docs.sparkSession, map_path, shards, slots)
        edited = held.rebalanced({k: v[1] for k, v in stats.items()}, shards)
        if edited.shards != held.shards or edited.moved(held):
            held = edited
            if map_path:
                held.save(docs.sparkSession, map_path)
                held = SlotMap.load(docs.sparkSession, map_path)
    before, filled = [0] * slots, [0] * held.shards
    for slot, shard in enumerate(held.shard_of):
        before[slot] = filled[shard]
        filled[shard] += stats.get(slot, (0, 0))[0]
    place = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size"))
    return sized(docs, slots).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        looked_up(held.shard_of, F.col("virtual_slot")).cast("int").alias("shard"),
        (looked_up(before, F.col("virtual_slot")) + place - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        F.lit(held.version).alias("map_version"),
    )
