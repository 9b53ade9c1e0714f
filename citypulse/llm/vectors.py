"""Near-duplicate vectors by randomly rotated binary codes with stored correction factors.

A unit vector is rotated at random and kept as the signs of its coordinates, together with f, its inner
product with the unit vector of these signs. With another unit vector q, <signs, q> / f estimates
the inner product without bias, and differs from it by at most sqrt(1 - f^2) / f * sqrt(1 - cos^2).
q itself is rounded to 4 bits a coordinate at random, without bias; how far that moved it is kept,
too. From both follows a bound that no pair at the threshold exceeds: pairs whose estimate lies
below it are excluded, all others are computed again from the vectors.

Pairs meet where the signs of several rotations agree in all bits of a key. Bits in a key, and keys,
follow from the number of vectors so that buckets stay small, and so that a pair at the threshold misses
all keys with a probability of at most ``MISS``; closer pairs miss less. Components come first, by
forests of buckets; then the links of each vector are counted within its component, block by block.

Defined results: a vector that is null, empty, zero, or has null or non-finite components has no link;
vectors of different length have none either; equal vectors are one class until the end; repeated
rows of one vec_id with the same vector are one vector, with different vectors the least in array
order counts; a null vec_id is left out; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.llm import buckets
from citypulse.llm.registry import query
from citypulse.llm.storage import stored, table

#: Probability that a pair at the threshold is in no bucket; rows of a block in which links are counted.
MISS, COUNT_BLOCK = 1e-9, 1000
LEVELS = 15


@lru_cache(maxsize=512)
def rotation(dim: int, number: int) -> np.ndarray:
    """A random rotation, the same wherever it is made."""
    q, r = np.linalg.qr(np.random.default_rng([dim, number]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def keys_for(n: int, least: float) -> tuple[int, int]:
    """Bits of a key and number of keys for n vectors."""
    bits = min(60, math.ceil(math.log2(max(n, 2))) + 4)
    agree = (1 - math.acos(least) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log1p(-agree))


def units(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and unit vectors in double precision, for each length of vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    begin = np.cumsum(size) - size
    for dim in np.unique(size).tolist():
        rows = np.flatnonzero(size == dim)
        v = flat[begin[rows][:, None] + np.arange(dim)]
        yield rows, v / np.linalg.norm(v, axis=1)[:, None]


def _keys(vectors: DataFrame, bits: int, keys: int) -> DataFrame:
    """(sig, class, flags) for each key: all rows look for others and are whole."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.int64(1) << np.arange(bits, dtype=np.int64)
        for batch in batches:
            for rows, v in units(batch.column(1)):
                dim = v.shape[1]
                signs, number = np.zeros((len(rows), 0), bool), 0
                own = batch.column(0).take(pa.array(rows))
                for k in range(keys):
                    while signs.shape[1] < bits:
                        signs = np.concatenate([signs, v @ rotation(dim, number).T > 0], axis=1)
                        number += 1
                    code = signs[:, :bits] @ weight
                    signs = signs[:, bits:]
                    # The key also tells which one it is, and the length of the vectors.
                    with np.errstate(over="ignore"):
                        sig = (code ^ np.int64(k * 1_000_003 + dim)) * np.int64(-7046029254386353131) + np.int64(k)
                    yield pa.RecordBatch.from_arrays([pa.array(sig), own, pa.array(np.full(len(rows), 3, np.int32))], ["sig", "h1", "flags"])

    return vectors.mapInArrow(sign, buckets.MEMBERS)


CODES = "class long, band int, dim int, signs binary, factor double, rounded binary, low double, step double, moved double"


def coded(v: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signs, factor, 4-bit coordinates, their lowest value and step, and how far rounding moved the vector."""
    dim = v.shape[1]
    x = v @ rotation(dim, 0).T
    signs = x > 0
    factor = np.abs(x).sum(axis=1) / math.sqrt(dim)
    low = x.min(axis=1)
    step = np.maximum((x.max(axis=1) - low) / LEVELS, 1e-12)
    place = (x - low[:, None]) / step[:, None]
    up = np.random.default_rng(seed).random(place.shape) < place - np.floor(place)
    rounded = np.clip(np.floor(place) + up, 0, LEVELS).astype(np.uint8)
    moved = np.linalg.norm(low[:, None] + rounded * step[:, None] - x, axis=1)
    return signs, factor, rounded, low, step, moved


def _codes(vectors: DataFrame) -> DataFrame:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, v in units(batch.column(1)):
                signs, factor, rounded, low, step, moved = coded(v)
                packed = np.packbits(signs, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(np.zeros(len(rows), np.int32)), pa.array(np.full(len(rows), v.shape[1], np.int32)), pa.array([s.tobytes() for s in packed], pa.binary()), pa.array(factor), pa.array([r.tobytes() for r in rounded], pa.binary()), pa.array(low), pa.array(step), pa.array(moved)],
                    [c.split()[0] for c in CODES.split(", ")],
                )

    return vectors.mapInArrow(code, CODES)


def estimates(signs: np.ndarray, factor: np.ndarray, rounded: np.ndarray) -> np.ndarray:
    """Estimated inner products of coded vectors with rounded ones, row by row."""
    unit = np.where(signs, 1.0, -1.0) / math.sqrt(signs.shape[1])
    return np.einsum("ij,ij->i", unit, rounded) / factor


def lowest(factor: np.ndarray, moved: np.ndarray, least: float) -> np.ndarray:
    """The lowest estimate that a pair at or above the threshold can have."""
    return least - np.sqrt(np.maximum(1 - factor**2, 0)) / factor * math.sqrt(1 - least**2) - moved / factor - 1e-9


def _excluding(least: float):  # noqa: ANN202
    """Test of pairs by the estimates of each one's code for the other."""

    def prepare(batch: pa.RecordBatch) -> buckets.Test:
        dims = batch.column(5).to_numpy()
        factor, low, step, moved = (batch.column(k).to_numpy() for k in (7, 9, 10, 11))
        signs, rounded, place = {}, {}, np.zeros(len(dims), np.int64)
        for dim in np.unique(dims).tolist():
            rows = np.flatnonzero(dims == dim)
            own, near = (b"".join(batch.column(k).take(pa.array(rows)).to_pylist()) for k in (6, 8))
            signs[dim] = np.unpackbits(np.frombuffer(own, np.uint8).reshape(len(rows), -1), axis=1)[:, :dim].astype(bool)
            rounded[dim] = low[rows][:, None] + np.frombuffer(near, np.uint8).reshape(len(rows), dim) * step[rows][:, None]
            place[rows] = np.arange(len(rows))

        def test(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            out = dims[i] == dims[j]
            for dim in np.unique(dims[i]).tolist():
                at = np.flatnonzero((dims[i] == dim) & out)
                for k in range(0, len(at), 1 << 14):
                    own = at[k : k + (1 << 14)]
                    for x, y in ((i[own], j[own]), (j[own], i[own])):
                        out[own] &= estimates(signs[dim][place[x]], factor[x], rounded[dim][place[y]]) >= lowest(factor[x], moved[y], least)
            return out

        return test

    return prepare


def _exact(pairs: DataFrame, vectors: DataFrame, least: float) -> DataFrame:
    """Pairs whose cosine, computed from the vectors in double precision, reaches the threshold."""
    both = pairs.join(vectors.select(F.col("class").alias("b"), F.col("vector").alias("y")), "b")
    both = both.join(vectors.select(F.col("class").alias("a"), F.col("vector").alias("x")), "a").select("a", "b", "x", "y")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for rows, x in units(batch.column(2)):
                y = np.stack([batch.column(3)[int(r)].values.to_numpy() for r in rows]).astype(np.float64)
                y /= np.linalg.norm(y, axis=1)[:, None]
                good[rows] = np.einsum("ij,ij->i", x, y) >= least
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(good))

    return both.mapInArrow(compute, buckets.PAIR)


def _counted(members: DataFrame, least: float) -> DataFrame:
    """Links of each class within its component: members (component, class, copies, vector) in blocks, each with each."""
    sized = members.groupBy("component").agg(F.ceil(F.count("*") / COUNT_BLOCK).cast("int").alias("blocks"))
    dealt = members.join(sized, "component").withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    # Block i meets block j in the cell (i, j): once as the rows that are counted for, once as those counted.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    counted_for = dealt.withColumn("other", other).select("component", F.col("own").alias("i"), F.col("other").alias("j"), "class", "copies", "vector", F.lit(True).alias("counted"))
    counted = dealt.withColumn("other", other).select("component", F.col("other").alias("i"), F.col("own").alias("j"), "class", "copies", "vector", F.lit(False).alias("counted"))

    def count(rows: pa.Table) -> pa.Table:
        (_, v), *_ = units(rows.column("vector"))
        ids, copies, left = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("class", "copies", "counted"))
        near = (v[left] @ v[~left].T >= least) & (ids[left][:, None] != ids[~left][None, :])
        return pa.table({"class": pa.array(ids[left]), "links": pa.array((near * copies[~left]).sum(axis=1))})

    # Dealt out by block: by component alone, a large one would be one task.
    cells = counted_for.unionByName(counted).repartition("component", "i", "j")
    parts = cells.groupBy("component", "i", "j").applyInArrow(count, "class long, links long")
    return parts.groupBy("class").agg(F.sum("links").alias("links"))


def near_duplicates(table_: DataFrame, least: float = 0.95, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept for every vector; ``least`` is the cosine from which two link."""
    rows = table_.filter(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("vec_id")).agg(F.min(F.col(vector).cast("array<double>")).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    valid = F.coalesce(F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = stored(rows.withColumn("vector", F.when(valid, F.col("vector"))), "vectors")
    classes = stored(rows.filter("vector is not null").groupBy("vector").agg(F.min("vec_id").alias("class"), F.count("*").alias("copies")).select("class", "vector", "copies"), "classes")
    vectors = classes.select("class", "vector")
    bits, keys = keys_for(classes.count(), least)
    members = stored(buckets.shared(_keys(vectors, bits, keys)).select("sig", F.col("h1").alias("class"), "flags"), "members")
    codes = stored(_codes(vectors), "codes")
    linked = stored(buckets.linked(members, codes, _excluding(least), lambda pairs: _exact(pairs, vectors, least)), "linked")
    in_component = classes.join(linked.withColumnRenamed("node", "class"), "class")
    links = stored(_counted(in_component, least), "links")
    by_class = classes.join(linked.withColumnRenamed("node", "class"), "class", "left").join(links, "class", "left")
    found = by_class.select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "class").alias("component_id"))
    out = rows.join(found, "vector", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


@query("op1_embedding_dedup")
def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors from a cosine of 0.95 on."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
