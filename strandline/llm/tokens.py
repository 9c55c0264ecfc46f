"""Token ids in wavelet-matrix shards.

``encode`` turns whole texts into packed token ids with the tokenizers library.  ``build_shards`` range-partitions documents by id
and writes one compressed shard per partition: a document table and the wavelet matrix of the ids, one succinct bit-plane
per bit of the vocabulary.  ``WaveletShard`` opens one shard and answers ``access``, ``rank`` (occurrences before a
place), ``select`` (place of the k-th occurrence), ``count`` and ``decode`` from it.

Defined cases: a null text is empty; an empty text has only the end id; a null doc_id sorts first; repeated doc_ids stay
separate documents, next to each other; an empty table gives no shard and no row.  A shard is a row of a Parquet table
(one file per partition), so any store that Spark can write to will do and a lost task is simply written again.
"""

from __future__ import annotations

import io
import os
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_chunks, materialise, scratch, small_batches

MAGIC = b"WMX1"
#: Ids per shard aimed at: 8 MB of ids before compression.
SHARD_IDS = 4_000_000
SUPER = 512
#: Bytes of text given to the library at a time, so that few of its encodings are held.
CHUNK_TEXT = 1 << 18

# ---------------------------------------------------------------- tokenizer


class TextEncoder:
    """Packed ids of whole texts, each text encoded by the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")

    def texts(self, texts: list[str]) -> list[bytes]:
        found = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]


_encoders: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """The worker's encoder: kept between the tasks of a reused Python worker."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


def encode(docs: DataFrame, path: str, end_id: int | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, ids (packed little-endian ids, the end id appended).

    A worker holds the tokens of texts of CHUNK_TEXT bytes together, or of one longer text.
    """

    def run(batches):
        enc = encoder(path)
        end = b"" if end_id is None else np.array([end_id], enc.kind).tobytes()
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for lo, hi, _, _ in byte_chunks(texts, CHUNK_TEXT):
                ids = [b + end for b in enc.texts(texts.slice(lo, hi - lo).fill_null("").to_pylist())]
                yield pa.RecordBatch.from_arrays([keys.slice(lo, hi - lo), pa.array(ids, pa.binary())], ["key", "ids"])

    rows = small_batches(docs).select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, ids binary")


# ---------------------------------------------------------------- wavelet matrix


def wavelet_pack(ids: np.ndarray, bits: int) -> bytes:
    """Compressed bit-planes, highest bit first, each with the ones before every block of 512 bits."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    cur, parts, head = ids, [], []
    for bit in range(bits - 1, -1, -1):
        b = (cur >> np.array(bit, cur.dtype)) & np.array(1, cur.dtype) != 0
        plane = np.packbits(b)
        ones = np.zeros(-(-len(plane) * 8 // SUPER) * SUPER // 8, np.uint8)
        ones[: len(plane)] = np.bitwise_count(plane)
        blocks = ones.reshape(-1, SUPER // 8).sum(axis=1, dtype=np.uint32)
        ranks = (np.cumsum(blocks, dtype=np.uint32) - blocks).astype("<u4")
        low = cur[~b]
        cur = np.concatenate([low, cur[b]])
        for raw in (plane.tobytes(), ranks.tobytes()):
            parts.append(squeeze(raw))
        head.append((len(low), len(parts[-2]), len(parts[-1])))
    return struct.pack("<QB", len(ids), bits) + b"".join(struct.pack("<QQQ", *h) for h in head) + b"".join(parts)


class WaveletShard:
    """One shard file: documents (ids and lengths) and the wavelet matrix of their token ids."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet shard")
        (size,) = struct.unpack_from("<Q", data, 4)
        table = pa.ipc.open_stream(io.BytesIO(data[12 : 12 + size])).read_all()
        self.keys, self.lengths = table.column("key"), table.column("n").to_numpy()
        at = 12 + size
        self.n, self.bits = struct.unpack_from("<QB", data, at)
        at += 9
        heads = [struct.unpack_from("<QQQ", data, at + 24 * i) for i in range(self.bits)]
        at += 24 * self.bits
        self.zeros, self._packed, self._planes = [h[0] for h in heads], [], {}
        for _, a, b in heads:
            self._packed.append((data[at : at + a], data[at + a : at + a + b]))
            at += a + b

    @staticmethod
    def pack(keys: pa.Array, lengths: np.ndarray, ids: np.ndarray, bits: int) -> bytes:
        sink = io.BytesIO()
        t = pa.table({"key": keys, "n": pa.array(lengths, pa.int64())})
        with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_table(t)
        return MAGIC + struct.pack("<Q", len(sink.getvalue())) + sink.getvalue() + wavelet_pack(ids, bits)

    def plane(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        if level not in self._planes:
            grow = zstandard.ZstdDecompressor().decompress
            a, b = self._packed[level]
            self._planes[level] = (np.frombuffer(grow(a), np.uint8), np.frombuffer(grow(b), "<u4"))
        return self._planes[level]

    def _rank1(self, level: int, i: int) -> int:
        plane, ranks = self.plane(level)
        block = min(i // SUPER, len(ranks) - 1) if len(ranks) else 0
        if not i:
            return 0
        bits = np.unpackbits(plane[block * SUPER // 8 : (i + 7) // 8])[: i - block * SUPER]
        return int(ranks[block]) + int(bits.sum())

    def access(self, i: int) -> int:
        """The i-th token id."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.bits):
            one = int(self.plane(level)[0][i >> 3] >> (7 - (i & 7)) & 1)
            r = self._rank1(level, i)
            i, value = (self.zeros[level] + r, value << 1 | 1) if one else (i - r, value << 1)
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        lo, hi = 0, i
        for level in range(self.bits):
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            lo, hi = (self.zeros[level] + a, self.zeros[level] + b) if token >> (self.bits - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, token: int, i: int) -> int:
        """Occurrences of the token among the first i ids."""
        lo, hi = self._range(token, min(max(i, 0), self.n)) if 0 <= token < 1 << self.bits else (0, 0)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _select_bit(self, level: int, one: int, k: int) -> int:
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            r = self._rank1(level, mid + 1)
            if (r if one else mid + 1 - r) > k:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def select(self, token: int, k: int) -> int:
        """The place of the k-th occurrence (from 0), -1 if there are fewer."""
        if k < 0 or k >= self.count(token):
            return -1
        at = self._range(token, self.n)[0] + k
        for level in range(self.bits - 1, -1, -1):
            one = token >> (self.bits - 1 - level) & 1
            at = self._select_bit(level, one, at - self.zeros[level] if one else at)
        return at

    def decode(self) -> np.ndarray:
        """All ids, by undoing the stable partitions from the lowest plane up."""
        kind = np.dtype("<u2" if self.bits <= 16 else "<u4")
        cur = np.zeros(self.n, kind)
        for level in range(self.bits - 1, -1, -1):
            b = np.unpackbits(self.plane(level)[0], count=self.n).view(bool)
            back = np.empty(self.n, kind)
            back[~b], back[b] = cur[: self.zeros[level]], cur[self.zeros[level] :]
            back |= b.astype(kind) << np.array(self.bits - 1 - level, kind)
            cur = back
        return cur


# ---------------------------------------------------------------- Spark jobs


def build_shards(encoded: DataFrame, path: str, vocabulary: int, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write shards in ascending key order to path; returns shard, n_docs, n_ids, payload.

    encoded should be a table (see materialise): range partitioning reads it twice, once to sample the keys.
    """
    wide = vocabulary > 1 << 16
    bits = max(1, (vocabulary - 1).bit_length())
    kind = np.dtype("<u4" if wide else "<u2")
    total = encoded.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    parts = max(1, -(-total // (shard_ids * kind.itemsize)))

    def run(batches):
        from pyspark import TaskContext

        keys, lengths, ids = [], [], []
        for batch in batches:
            keys.append(batch.column(0))
            col = batch.column(1).cast(pa.large_binary())
            offs = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
            if len(col) and col.buffers()[2] is not None:
                data = np.frombuffer(col.buffers()[2], np.uint8)[offs[0] : offs[-1]]
                ids.append(np.frombuffer(data.tobytes(), kind))
            lengths.append(np.diff(offs) // kind.itemsize)
        if not keys or not sum(map(len, keys)):
            return
        n, ids = np.concatenate(lengths), np.concatenate(ids) if ids else np.zeros(0, kind)
        payload = WaveletShard.pack(pa.chunked_array(keys).combine_chunks(), n, ids, bits)
        columns = [[TaskContext.get().partitionId()], [len(n)], [int(n.sum())], [payload]]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.large_binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["shard", "n_docs", "n_ids", "payload"])

    # a key of many rows is cut by its rows' ids, equal rows by their place in the table: their order makes no difference
    order = [F.col("key").asc_nulls_first(), "tie", "row"]
    rows = encoded.select("key", "ids", F.xxhash64("ids").alias("tie"), F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("key", "ids")
    shape = "shard long, n_docs long, n_ids long, payload binary"
    ordered.mapInArrow(run, shape).write.parquet(path)
    return encoded.sparkSession.read.schema(shape).parquet(path)


def read_shards(shards: DataFrame, key_type: str = "long") -> DataFrame:
    """One row per document from the shard files: key, start, n_tokens, ids_crc32."""
    w = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard, no payload
    base = shards.select("shard", F.coalesce(F.sum("n_ids").over(w), F.lit(0)).alias("base"))

    def run(frames):
        for f in frames:
            for shard, payload in zip(f["shard"], f["payload"]):
                s = WaveletShard(payload)
                ids = s.decode().astype("<u4")
                ends = np.cumsum(s.lengths)
                crc = [zlib.crc32(ids[b - n : b].data) for b, n in zip(ends, s.lengths)]
                yield pd.DataFrame({"shard": shard, "key": s.keys.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get), "place": ends - s.lengths, "n_tokens": s.lengths, "ids_crc32": crc})

    rows = shards.select("shard", "payload").mapInPandas(run, f"shard long, key {key_type}, place long, n_tokens long, ids_crc32 long")
    few = shards.select("shard").count() <= 1_000_000  # 16 bytes each
    return rows.join(F.broadcast(base) if few else base, "shard").select(
        "key", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", "shard", F.col("place").alias("place_in_shard")
    )


def token_table(docs: DataFrame, path: str, end_id: int = 2, vocabulary: int | None = None, out: str | None = None) -> DataFrame:
    """Encode, write the shards, read them back: doc_id, start, n_tokens, ids_crc32, shard, place_in_shard."""
    from tokenizers import Tokenizer

    vocabulary = vocabulary or Tokenizer.from_file(path).get_vocab_size()
    encoded = materialise(encode(docs, path, end_id), "ids", "zstd")
    shards = build_shards(encoded, out or scratch(docs.sparkSession, "shards"), vocabulary)
    return read_shards(shards, dict(encoded.dtypes)["key"]).withColumnRenamed("key", "doc_id")
