"""Near duplicates among embeddings by cosine, from products of int8 tiles.

1. Vectors with equal components are one node with a number of copies.
2. Each node is filed in ``bands`` buckets by the signs of its products with
   random planes.  Buckets hold about ``BUCKET`` nodes whatever the input's
   size: the number of planes follows the count of nodes, and the number of
   bands follows from it, so that a pair at the threshold shares no bucket with
   a probability of at most ``MISS`` (closer pairs: far less).  That bound holds
   for any data, as planes separate two vectors in proportion to their angle.
3. In a bucket, tiles of vectors scaled to int8 are multiplied.  x = s q + e
   with |e| known for each vector, so x.y lies within |e_x| (1 + |e_y|) + |e_y|
   of s_x s_y q_x.q_y.  Pairs certainly below the threshold go, those certainly
   above count, and the few between are recomputed in double precision.
   Products of int8 in float32 (float64 for long vectors) are exact integers.
4. A pair that shares several buckets counts in its first.  A bucket gives, per
   vector, the number of its partners and one link towards its local group, so
   pairs never leave the task; groups meet by ``near.components``.

A bucket of more than ``MOST`` nodes (near copies of one vector) is dealt to
parts, and every pair of parts is a group of its own, so none grows with the data.

Sides are told by integer products, so they are the same in every task.  With up to ``BUCKET`` nodes there is one bucket: all pairs are compared.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing and are their own component.  Vectors of different
length don't link.  Rows with equal vectors link with each other, also under one
id; the component is the smallest id in it (null if all are null), and a
row is kept if it has that id.  Any scale is taken (each vector is divided by its
largest component first).  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import importable, materialise, type_of
from .near import components

THRESHOLD = 0.95
MISS = 1e-6
BUCKET = 2048
MOST = 8192
TILE = 512
SEED = 20240813


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of finite, non-zero vectors at length 1, in double precision."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def quantise(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors as int8 values, their scale, and the length of what each loses (with a margin for rounding)."""
    scale = np.abs(u).max(axis=1) / 127
    q = np.rint(u / scale[:, None])
    lost = u - q * scale[:, None]
    return q.astype(np.int8), scale, np.sqrt(np.einsum("ij,ij->i", lost, lost)) + 1e-12


@lru_cache(maxsize=8)
def planes(dim: int, n: int) -> np.ndarray:
    """n random planes with integer coordinates, so that products with integer vectors are exact."""
    return np.rint(np.random.default_rng([SEED, dim]).standard_normal((n, dim)) * 4096).T


def band_codes(u: np.ndarray, bits: int, bands: int) -> np.ndarray:
    """The bucket number of each unit vector in every band."""
    if not bits:
        return np.zeros((len(u), bands), np.int64)
    side = np.rint(u * 32767) @ planes(u.shape[1], bits * bands) >= 0
    return side.reshape(len(u), bands, bits) @ (1 << np.arange(bits, dtype=np.int64))


def layout(nodes: int, threshold: float, miss: float, lost: float = 0.001) -> tuple[int, int]:
    """Planes per band and bands.  ``lost``: what rounding may take from a vector's direction before its sides are told."""
    bits = max(0, math.ceil(math.log2(max(1, nodes) / BUCKET)))
    same = 1 - (math.acos(threshold) + 2 * math.asin(lost)) / math.pi
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-same ** bits))) if bits else 1


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values (non-finite where null), and where each row's begin and end."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)
    if values.dtype.kind != "f":
        values = values.astype(np.float64)
    begin, end = ends[:-1].copy(), ends[1:].copy()
    gone = ~np.asarray(column.is_valid())
    end[gone] = begin[gone]
    return values, begin, end


def read_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """key, name (16 bytes that stand for the components, null if the vector can't link), vec (raw bytes)."""
    kind = rows.schema[vector].dataType.elementType.simpleString()
    rows = rows.select(F.col(key), F.col(vector).cast("array<float>" if kind == "float" else "array<double>").alias("_v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, begin, end = _vectors(batch["_v"])
            names, vecs = [], []
            for a, b in zip(begin.tolist(), end.tolist(), strict=True):
                x = values[a:b]
                if b > a and np.isfinite(x).all() and x.any():
                    raw = (x + 0).tobytes()  # -0 becomes 0
                    names.append(hashlib.blake2b(raw, digest_size=16).digest())
                    vecs.append(raw)
                else:
                    names.append(None)
                    vecs.append(None)
            yield pa.RecordBatch.from_arrays([batch[key], pa.array(names, pa.binary()), pa.array(vecs, pa.binary())],
                                             [key, "name", "vec"])

    return rows.mapInArrow(run, f"`{key}` {type_of(rows, key)}, name binary, vec binary")


def _matrix(column: pa.Array, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def filed(nodes: DataFrame, bits: int, bands: int, dtype: str, carry: tuple[str, ...] = ("node", "copies", "vec")) -> DataFrame:
    """dim, bucket and the columns to carry: every node once per band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                width = np.array([len(v) for v in part["vec"].to_pylist()])
                for w in np.unique(width).tolist():
                    own = part.filter(pa.array(width == w))
                    n = own.num_rows
                    codes = band_codes(unit(_matrix(own["vec"], dtype)), bits, bands)
                    at = pa.array(np.repeat(np.arange(n), bands))
                    bucket = (np.arange(bands, dtype=np.int64) << 40) + codes
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n * bands, w, np.int32)), pa.array(bucket.ravel()),
                         *[own[c].take(at) for c in carry]], ["dim", "bucket", *carry])

    types = {"node": "long", "copies": "long", "vec": "binary"}
    return (nodes.select(*dict.fromkeys([*carry, "vec"]))
            .mapInArrow(run, ", ".join(["dim int, bucket long", *[f"{c} {types[c]}" for c in carry]])))


def cells(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Adds part, low and high: the pairs of parts of large buckets, each a group; one part if a bucket is small.

    sizes: dim, bucket of every row of rows.
    """
    large = (sizes.groupBy("dim", "bucket").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > MOST)
             .select(F.col("dim").alias("_dim"), F.col("bucket").alias("_bucket"),
                     F.ceil(F.col("_n") * 2 / MOST).cast("int").alias("_parts")))
    return (rows.join(large, (F.col("dim") == F.col("_dim")) & (F.col("bucket") == F.col("_bucket")), "left")
            .withColumn("_parts", F.coalesce("_parts", F.lit(1)))
            .withColumn("part", F.pmod(F.xxhash64("node"), "_parts").cast("int"))
            .withColumn("_with", F.explode(F.expr("sequence(0, _parts - 1)")))
            .withColumn("low", F.least("part", "_with")).withColumn("high", F.greatest("part", "_with"))
            .drop("_dim", "_bucket", "_parts", "_with"))


class Tiles:
    """The vectors of one group, the links found among them, and their local groups."""

    def __init__(self, vecs: np.ndarray, copies: np.ndarray, band: int, bits: int, threshold: float):
        self.u = unit(vecs)
        self.q, self.scale, self.lost = quantise(self.u)
        # an integer below 2 ** 24 is exact in float32
        self.wide = self.q.astype(np.float32 if 127 * 127 * vecs.shape[1] < 1 << 24 else np.float64)
        self.copies, self.band, self.bits, self.threshold = copies, band, bits, threshold
        self.links = np.zeros(len(vecs), np.int64)
        self.label = np.arange(len(vecs))
        self.recomputed = 0

    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in a and b of the pairs at or above the threshold."""
        near = (self.wide[a] @ self.wide[b].T) * self.scale[a][:, None] * self.scale[b]
        slack = self.lost[a][:, None] * (1 + self.lost[b]) + self.lost[b] + 1e-9
        i, j = np.nonzero(near + slack >= self.threshold)
        unsure = np.flatnonzero(near[i, j] - slack[i, j] < self.threshold)
        ok = np.ones(len(i), bool)
        for s in range(0, len(unsure), 1 << 16):
            k = unsure[s:s + (1 << 16)]
            ok[k] = np.einsum("ij,ij->i", self.u[a[i[k]]], self.u[b[j[k]]]) >= self.threshold
        self.recomputed += len(unsure)
        return a[i[ok]], b[j[ok]]

    def compare(self, a: np.ndarray, b: np.ndarray, bands: int, same: bool) -> None:
        """Counts the links of all pairs of a tile of a and a tile of b that no earlier band has counted."""
        for s in range(0, len(a), TILE):
            for t in range(0, s + 1 if same else len(b), TILE):
                i, j = self.pairs(a[s:s + TILE], b[t:t + TILE])
                if same:
                    i, j = i[i > j], j[i > j]
                if self.band and len(i):
                    found, at = np.unique(np.concatenate([i, j]), return_inverse=True)
                    codes = band_codes(self.u[found], self.bits, bands)[:, :self.band]
                    ci, cj = at[:len(i)], at[len(i):]
                    new = np.ones(len(i), bool)
                    for k in range(self.band):
                        new &= codes[ci, k] != codes[cj, k]
                    i, j = i[new], j[new]
                if len(i):
                    self.links += np.bincount(i, self.copies[j], len(self.links)).astype(np.int64)
                    self.links += np.bincount(j, self.copies[i], len(self.links)).astype(np.int64)
                    self.join(i, j)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            x, y = self.label[i], self.label[j]
            if (x == y).all():
                return
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while (after := self.label[self.label]).tobytes() != self.label.tobytes():
                self.label = after


def partners(rows: DataFrame, bits: int, bands: int, threshold: float, dtype: str) -> DataFrame:
    """node, links, near: rows linked with it (in one group), and a node of its local group."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        bucket, low, high = (key[k].as_py() for k in (1, 2, 3))
        order = np.argsort(table["node"].to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        node, part = table["node"].to_numpy(), table["part"].to_numpy()
        found = Tiles(_matrix(table["vec"], dtype), table["copies"].to_numpy(), bucket >> 40, bits, threshold)
        a, b = np.flatnonzero(part == low), np.flatnonzero(part == high)
        if len(a) and len(b):
            found.compare(a, b, bands, low == high)
        has = np.flatnonzero(found.links)
        return pa.table({"node": node[has], "links": found.links[has], "near": node[found.label[has]]})

    return (rows.select("dim", "bucket", "low", "high", "part", "node", "copies", "vec")
            .groupBy("dim", "bucket", "low", "high").applyInArrow(run, "node long, links long, near long"))


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD,
                    miss: float = MISS) -> DataFrame:
    """key, n_links, component_id, kept for every row: see the module's text."""
    importable(rows.sparkSession)
    dtype = "float32" if rows.schema[vector].dataType.elementType.simpleString() == "float" else "float64"
    read = materialise(read_vectors(rows, key, vector), "vectors")
    nodes = materialise(
        read.filter("name IS NOT NULL").groupBy("name")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(key).alias("least"), F.first("vec").alias("vec"))
        .withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    bits, bands = layout(nodes.count(), threshold, miss)
    dealt = cells(filed(nodes, bits, bands, dtype), filed(nodes, bits, bands, dtype, ()))
    found = materialise(partners(dealt, bits, bands, threshold, dtype), "partners")
    degree = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.filter("node <> near").select(F.col("node").alias("later"), F.col("near").alias("earlier")))
    told = (nodes.drop("vec").join(degree, "node", "left")
            .join(joined.withColumnRenamed("rep", "node"), "node", "left")
            .withColumn("root", F.coalesce("root", "node")))
    least = told.filter(F.col("links").isNotNull()).groupBy("root").agg(F.min("least").alias("component"))
    told = (told.join(least, "root", "left")
            .select("name", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                    F.coalesce("component", "least").alias("component_id")))
    alone = (read.filter("name IS NULL")
             .select(key, F.lit(0).cast("long").alias("n_links"), F.col(key).alias("component_id")))
    return (read.filter("name IS NOT NULL").select(key, "name").join(told, "name")
            .select(key, "n_links", "component_id").unionByName(alone)
            .withColumn("kept", F.col(key).eqNullSafe(F.col("component_id"))))
