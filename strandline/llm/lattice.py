"""Embedding near-duplicates by E8 lattice hashing.

Valid vectors are grouped into classes of equal vectors of a label first.  Each class's unit vector is turned by seeded
random rotations and cut into groups of eight coordinates: each group is a random projection to eight dimensions and gives
one table.  The projection is scaled and decoded to its nearest point of the lattice E8; that point is the vector's cell.  The index holds each
vector in its own cell, a query also probes the neighbouring cells whose walls are nearest.  Vectors that share a cell of
a table are compared by their exact cosine in double precision.

The scale follows from the similarity bound and the number of dimensions, never from the data.

Defined cases: vectors that are null, zero or hold null or non-finite components, and rows without a label, link with
nothing and are their own component; vectors of different lengths never link; repeated rows are vectors of their own that
link with each other, and so do rows of one vec_id with different vectors, if these are near; a null vec_id takes part and is
no candidate for the smallest vec_id of a component (which is null where no other is); extra columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, materialise, mix64, split_join

COSINE = 0.93
TABLES = 16
PROBES = 2
#: Length, in lattice units (minimal distance is sqrt 2), of a projected difference at the similarity bound.
REACH = 0.9


def _minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: (+-1, +-1, 0...) and (+-1/2)^8 with an even number of minus signs."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) / 2 for s in itertools.product((1.0, -1.0), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


NEIGHBOURS = _minimal_vectors()


def _decode_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: round, and if the sum is odd turn the worst coordinate the other way."""
    y = np.rint(x)
    off = x - y
    odd = np.flatnonzero(y.sum(axis=1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(axis=1)
    y[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return y


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points of rows of eight numbers: the better of D8 and D8 + 1/2."""
    a, b = _decode_d8(x), _decode_d8(x - 0.5) + 0.5
    nearer = ((x - b) ** 2).sum(axis=1) < ((x - a) ** 2).sum(axis=1)
    return np.where(nearer[:, None], b, a)


def rotations(dim: int, tables: int, seed: int) -> np.ndarray:
    """[tables, 8, dim]: rows of random orthonormal matrices, eight for each table."""
    wide = max(8, -(-dim // 8) * 8)
    out, turn = [], 0
    while len(out) < tables:
        q, r = np.linalg.qr(np.random.default_rng([seed, turn, dim]).standard_normal((wide, wide)))
        q = (q * np.sign(np.diag(r)))[:, :dim]
        out += [q[i : i + 8] for i in range(0, wide, 8)]
        turn += 1
    return np.array(out[:tables])


def cells(unit: np.ndarray, turn: np.ndarray, cosine: float, reach: float, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed cell of each unit vector in one table, and of the neighbouring cells to probe: [n], [n, probes]."""
    dim = unit.shape[1]
    scale = reach / np.sqrt((2 - 2 * cosine) * 8 / max(dim, 8))
    x = unit @ turn.T * scale
    own = decode_e8(x)
    side = (x - own) @ NEIGHBOURS.T
    near = np.argpartition(-side, probes - 1, axis=1)[:, :probes] if probes else np.zeros((len(x), 0), int)
    beside = own[:, None, :] + NEIGHBOURS[near]

    def named(points: np.ndarray) -> np.ndarray:
        twice = np.rint(points * 2).astype(np.int64).view(np.uint64)
        h = np.full(points.shape[:-1], 1469598103934665603, np.uint64)
        for i in range(8):
            h = mix64(h ^ twice[..., i] * np.uint64(0x9E3779B97F4A7C15))
        return h.view(np.int64)

    return named(own), named(beside)


def usable(embedding: str = "embedding"):
    """Not null, every component a finite number, not zero."""
    v = F.col(embedding)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows of equal length together: (row numbers, float64 matrix)."""
    sizes = np.diff(np.asarray(column.offsets)).astype(np.int64)
    flat = np.asarray(column.values).astype(np.float64)
    at = np.asarray(column.offsets)[:-1]
    return [(rows, flat[at[rows][:, None] + np.arange(d)]) for d in np.unique(sizes) for rows in [np.flatnonzero(sizes == d)]]


def cell_rows(classes: DataFrame, cosine: float, tables: int, probes: int, reach: float, seed: int) -> DataFrame:
    """rep, label, dim, cell, own: the cells of each class; own is false for probed neighbours."""

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            rep, label = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            for rows, m in _matrix(batch.column(2)):
                dim = m.shape[1]
                turns = held.setdefault(dim, rotations(dim, tables, seed))
                unit = m / np.abs(m).max(axis=1)[:, None]
                unit /= np.sqrt((unit**2).sum(axis=1))[:, None]
                for lo in range(0, len(rows), 2048):
                    part = rows[lo : lo + 2048]
                    for t in range(tables):
                        own, beside = cells(unit[lo : lo + 2048], turns[t], cosine, reach, probes)
                        salt = np.int64(t * 1_000_003 + dim)
                        all_ = np.concatenate([own[:, None], beside], axis=1) ^ salt
                        n = all_.shape[1]
                        flag = np.zeros(all_.shape, bool)
                        flag[:, 0] = True
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.repeat(rep[part], n)), pa.array(np.repeat(label[part], n)), pa.array(all_.ravel()), pa.array(flag.ravel())], ["rep", "label", "cell", "own"]
                        )

    rows = classes.select("rep", "label", "embedding")
    return rows.mapInArrow(run, f"rep long, label {dict(rows.dtypes)['label']}, cell long, own boolean")


def links(classes: DataFrame, cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES, reach: float = REACH, seed: int = 3) -> DataFrame:
    """Pairs of classes (a < b) that share a cell and have the cosine or more."""
    rows = materialise(cell_rows(classes, cosine, tables, probes, reach, seed), "cells")
    own = rows.where("own").select("label", "cell", F.col("rep").alias("x"))
    pairs = rows.select("label", "cell", F.col("rep").alias("y")).join(own, ["label", "cell"]).where("x != y")
    pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    left = classes.select(F.col("rep").alias("a"), F.col("embedding").alias("va"))
    right = classes.select(F.col("rep").alias("b"), F.col("embedding").alias("vb"))

    def verify(batches):
        for batch in batches:
            va, vb = batch.column(2), batch.column(3)
            keep = np.zeros(len(batch), bool)
            sizes = np.diff(np.asarray(va.offsets)) == np.diff(np.asarray(vb.offsets))
            rows = np.flatnonzero(sizes)
            for part, m in _matrix(va.take(pa.array(rows))):
                at = rows[part]
                n = np.concatenate([x for x in [_matrix(vb.take(pa.array(at)))[0][1]]])
                m, n = m / np.abs(m).max(axis=1)[:, None], n / np.abs(n).max(axis=1)[:, None]
                dot = np.einsum("ij,ij->i", m, n)
                keep[at] = dot / np.sqrt(np.einsum("ij,ij->i", m, m) * np.einsum("ij,ij->i", n, n)) >= cosine
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in (batch.column(0), batch.column(1))], ["a", "b"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "va", "vb").mapInArrow(verify, "a long, b long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """vec_id, n_links, component_id, kept - one row per row of vectors."""
    v = vectors.select("vec_id", "embedding", "label")
    good = v.where(usable() & F.col("label").isNotNull())
    # a class is a label and a vector, known by the SHA-256 of both and never by a vec_id, which may be null or repeated; it is numbered
    # once and for all in the table of classes
    members = good.withColumn("key", F.unhex(F.sha2(F.to_json(F.struct("label", "embedding")), 256)))
    sizes = members.groupBy("key").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    sizes = materialise(sizes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    pairs = materialise(links(sizes.select("rep", "label", "embedding"), cosine, tables, probes), "pairs")
    both = pairs.union(pairs.select("b", "a"))
    n = sizes.select("rep", "key", "n", "id")
    others = both.join(n.select(F.col("rep").alias("b"), "n"), "b").groupBy("a").agg(F.sum("n").alias("others"))
    per_class = (
        n.join(others.withColumnRenamed("a", "rep"), "rep", "left")
        .join(components(pairs).withColumnRenamed("node", "rep"), "rep", "left")
        .select("key", "id", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    )
    per_class = materialise(per_class, "per_class")
    named = per_class.groupBy("component").agg(F.min("id").alias("component_id"))
    per_class = materialise(per_class.join(named, "component").select("key", "n_links", "component_id"), "named")
    linked = split_join(members.select("vec_id", "key"), per_class, "key")
    alone = v.where(~usable() | F.col("label").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.select("vec_id", "n_links", "component_id").unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
