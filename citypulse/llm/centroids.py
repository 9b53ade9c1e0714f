"""Centroid clustering over blocks of vectors in the order of a space-filling curve.

Vectors are made integers, so that distances and means are exact and do not depend on the order of
summation. They are rotated to the axes along which the first centroids differ most, put in the order of a
Hilbert curve over the leading axes, and stored in blocks of ``BLOCK`` neighbours with the least and
greatest coordinate of each axis and the sum of the block. Over such a box the difference of the squared
distances to two centroids is linear, so its greatest value is known without the vectors: a centroid is
no candidate of a block if another one is nearer all over the box. A block with one candidate adds its sum to that
one unseen; the vectors of the others are compared exactly with the block's candidates, all at once.

A round is one pass over the blocks; only sums by centroid and component reach the driver.

Defined results: vectors that are null, have another number of components, or null or non-finite ones
are left out, and so are those with a component of more than ``WIDEST`` units, whose distances need not fit a
long; rows without a key are clustered but start no centroid; repeated rows each count and are each
returned; among rows of one key the least vector comes first; with fewer vectors than centroids there
are as many centroids as vectors with a key (with none at all the result is empty), and equal ones may stand side by side, of which the first gets the vectors; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.llm.registry import query
from citypulse.llm.storage import stored, table

#: Vectors of a block; axes and bits of the curve; greatest size of a component in units.
BLOCK, CURVE_AXES, CURVE_BITS, WIDEST = 256, 8, 7, 1 << 27
#: Up to this size of components, sums of products are exact in double precision.
NARROW = 1 << 22


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each point (rows of integers of ``bits`` bits) on the Hilbert curve, by Skilling's transform."""
    x = points.astype(np.int64).T.copy()
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(len(x)):
            turned = (x[i] >> level) & 1 == 1
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= flip
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for row in x:
            out = (out << 1) | ((row >> level) & 1)
    return out


def kept_units(vectors: DataFrame, dim: int, scale: int, key: str, vector: str) -> DataFrame:
    """(key, units) of the vectors that are kept: each component times ``scale``, rounded down."""
    finite = F.forall(F.col("v"), lambda x: x.isNotNull() & (F.abs(x * scale) <= WIDEST))  # NaN is greater than any number
    read = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v")).filter(F.size("v") == dim)
    return read.filter(finite).select("key", F.transform("v", lambda x: F.floor(x * scale).cast("int")).alias("units"))


def first_centroids(units: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors whose hashed key is least, in this order."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256).alias("h")
    rows = units.filter(F.col("key").isNotNull()).select(hashed, "units").orderBy("h", "units").limit(k).collect()
    return np.array([r.units for r in rows], np.int64)


class Frame(NamedTuple):
    """Axes along which the first centroids differ, and the range of the curve on the leading ones."""

    axes: np.ndarray
    low: np.ndarray
    step: np.ndarray

    def rotated(self, units: np.ndarray) -> np.ndarray:
        return units.astype(np.float64) @ self.axes.T

    def place(self, units: np.ndarray) -> np.ndarray:
        cell = np.floor((self.rotated(units)[:, : len(self.low)] - self.low) / self.step)
        return hilbert(np.clip(cell, 0, (1 << CURVE_BITS) - 1), CURVE_BITS)


def frame_of(centroids: np.ndarray) -> Frame:
    axes = np.linalg.svd(centroids - centroids.mean(axis=0))[2]
    on = (centroids @ axes.T)[:, :CURVE_AXES]
    reach = np.maximum(on.max(axis=0) - on.min(axis=0), 1.0) / 2
    low = on.min(axis=0) - reach
    return Frame(axes, low, 4 * reach / (1 << CURVE_BITS))


def _matrix(column: pa.Array) -> np.ndarray:
    size = len(column)
    return column.flatten().to_numpy().reshape(size, -1) if size else np.zeros((0, 0), np.int32)


BLOCKS = "keys array<{key}>, units binary, n int, low array<double>, high array<double>, total array<long>"


def blocks_of(units: DataFrame, frame: Frame) -> DataFrame:
    """Blocks of vectors that are neighbours on the curve. Equal vectors may be in many blocks and partitions."""
    kind = units.schema["key"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(frame.place(_matrix(batch.column(1))))], ["key", "units", "row", "place"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            cuts = [*range(0, batch.num_rows, BLOCK), batch.num_rows]
            rows = []
            for i, j in zip(cuts, cuts[1:], strict=False):
                y = frame.rotated(x[i:j])
                rows.append((batch.column(0).slice(i, j - i).to_pylist(), x[i:j].astype(np.int32).tobytes(), j - i, y.min(axis=0).tolist(), y.max(axis=0).tolist(), x[i:j].sum(axis=0, dtype=np.int64).tolist()))
            if rows:
                columns = zip(*rows, strict=True)
                kinds = [pa.list_(batch.schema.field(0).type), pa.binary(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["keys", "units", "n", "low", "high", "total"])

    # The number of the row keeps equal vectors, however many, from all being dealt to one partition.
    numbered = units.withColumn("row", F.monotonically_increasing_id())
    placed = numbered.mapInArrow(place, f"key {kind}, units array<int>, row long, place long")
    ordered = placed.repartitionByRange("place", "row").sortWithinPartitions("place", "row")
    return ordered.mapInArrow(pack, BLOCKS.format(key=kind))


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray, frame: Frame) -> np.ndarray:
    """For each box (rows of least and greatest rotated coordinates) which centroids can be the nearest of a vector in it."""
    k = len(centroids)
    on = frame.rotated(centroids)
    square = (on * on).sum(axis=1)
    apart = (on[:, None, :] - on[None, :, :]).reshape(k * k, -1)
    least = low @ np.maximum(apart, 0).T + high @ np.minimum(apart, 0).T
    # Greatest difference over the box of the squared distances to the first and to the second of each pair.
    most = (square[:, None] - square[None, :]).reshape(-1) - 2 * least
    size = max(1.0, *(float(np.abs(a).max(initial=0)) for a in (low, high, on)))
    nearer = most < -1e-9 * size * size * low.shape[1]
    return ~nearer.reshape(-1, k, k).any(axis=1)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors."""
    narrow = max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) <= NARROW
    x, c = (a.astype(np.float64 if narrow else np.int64) for a in (x, centroids))
    return ((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]).astype(np.int64)


def _decided(batch: pa.RecordBatch, centroids: np.ndarray, frame: Frame) -> Iterator[tuple[int, np.ndarray]]:
    """Each block of a batch with its candidates."""
    low, high = _matrix(batch.column("low")), _matrix(batch.column("high"))
    for row, near in enumerate(candidates(low, high, centroids, frame)):
        yield row, np.flatnonzero(near)


def _vectors(batch: pa.RecordBatch, row: int, dim: int) -> np.ndarray:
    return np.frombuffer(batch.column("units")[row].as_buffer(), np.int32).reshape(-1, dim)


def moved(blocks: DataFrame, centroids: np.ndarray, frame: Frame) -> np.ndarray:
    """The centroids after one round: rounded-down means of the vectors nearest to each; those without vectors stay."""
    k, dim = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
            for row, near in _decided(batch, centroids, frame):
                if len(near) == 1:
                    n[near[0]] += batch.column("n")[row].as_py()
                    total[near[0]] += batch.column("total")[row].values.to_numpy()
                    continue
                x = _vectors(batch, row, dim)
                own = near[distances(x, centroids[near]).argmin(axis=1)]
                n += np.bincount(own, minlength=k)
                for c in np.unique(own):
                    total[c] += x[own == c].sum(axis=0, dtype=np.int64)
            cluster, place = np.divmod(np.arange(k * dim), dim)
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in (cluster, place, n[cluster], total.reshape(-1))], ["cluster", "place", "n", "total"])

    parts = blocks.mapInArrow(add, "cluster long, place long, n long, total long")
    sums = parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    out = centroids.copy()
    for row in sums.filter("n > 0").collect():
        out[row.cluster, row.place] = int(row.total) // row.n
    return out


def assigned(blocks: DataFrame, centroids: np.ndarray, frame: Frame) -> DataFrame:
    """(key, cluster, distance) of every vector."""
    dim = centroids.shape[1]
    kind = blocks.schema["keys"].dataType.elementType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, near in _decided(batch, centroids, frame):
                d = distances(_vectors(batch, row, dim), centroids[near])
                own = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("keys")[row].values, pa.array(near[own].astype(np.int32)), pa.array(d[np.arange(len(own)), own])], ["key", "cluster", "distance"]
                )

    return blocks.mapInArrow(assign, f"key {kind}, cluster int, distance long")


def clusters(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, seed: int = 1, key: str = "vec_id", vector: str = "embedding"
) -> tuple[DataFrame, np.ndarray]:
    """(key, cluster, distance) of every kept vector after ``rounds`` rounds, and the centroids."""
    units = kept_units(vectors, dim, scale, key, vector)
    centroids = first_centroids(units, k, seed)
    if not len(centroids):
        empty = units.filter(F.lit(False)).select(F.col("key").alias(key), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return empty, np.zeros((0, dim), np.int64)
    frame = frame_of(centroids)
    blocks = stored(blocks_of(units, frame), "blocks")
    for _ in range(rounds):
        centroids = moved(blocks, centroids, frame)
    return stored(assigned(blocks, centroids, frame).withColumnRenamed("key", key), "assigned"), centroids


def _sql(k: int, rounds: int, dim: int, scale: int, seed: int) -> str:
    floor_mean = "(t - ((t % n) + n) % n) // n"
    parts = [f"""
WITH e AS (SELECT row_number() OVER () AS id, vec_id, embedding FROM embeddings WHERE len(embedding) = {dim}
  AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x) AND abs({scale} * x::double) <= {WIDEST})) = {dim}),
v AS (SELECT id, vec_id, unnest(range({dim})) AS place, unnest(list_transform(embedding, lambda x: floor({scale} * x::double)::bigint)) AS x FROM e),
f AS (SELECT id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c FROM e ORDER BY sha256('{seed}:' || vec_id) LIMIT {k}),
c0 AS (SELECT c, place, x FROM f JOIN v USING (id))"""]
    for r in range(rounds + 1):
        parts.append(f"""
d{r} AS (SELECT id, c, sum((v.x - c{r}.x) * (v.x - c{r}.x))::bigint AS d FROM v JOIN c{r} USING (place) GROUP BY id, c),
a{r} AS (SELECT id, c, d FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, c) AS k FROM d{r}) x WHERE k = 1)""")
        if r < rounds:
            parts.append(f"""
m{r} AS (SELECT c, place, sum(x) AS t, count(*) AS n FROM a{r} JOIN v USING (id) GROUP BY c, place),
c{r + 1} AS (SELECT c, place, coalesce({floor_mean}, x)::bigint AS x FROM c{r} LEFT JOIN m{r} USING (c, place))""")
    parts.append(f"""
s AS (SELECT c, sha256(string_agg(x::varchar, ',' ORDER BY place)) AS centroid_sha256 FROM c{rounds} GROUP BY c)""")
    return ",".join(parts) + f"""
SELECT vec_id, c::integer AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::bigint AS cluster_inertia,
  (sum(d) OVER ())::bigint AS inertia, centroid_sha256 FROM a{rounds} JOIN e USING (id) JOIN s USING (c)"""


@query("op11_centroid_clustering", _sql(16, 3, 64, 64, 1))
def centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and distance of every vector, and the sums of distances."""
    found, centroids = clusters(table(spark, sf_dir, "embeddings"))
    sums = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in centroids.tolist()]

    def own(values: list[int | str | None], kind: str) -> Column:
        """The value of the row's cluster, of a literal for each centroid: nothing is joined or sent."""
        return F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1).cast(kind)

    return found.select(
        "vec_id", "cluster", "distance", own([sums.get(c) for c in range(len(centroids))], "long").alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"), own(digests, "string").alias("centroid_sha256"),
    )
