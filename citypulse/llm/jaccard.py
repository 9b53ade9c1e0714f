"""Exact set-similarity join of documents on word shingles, by universe partition and pigeonhole.

Two sets of sizes a and b are similar only if at most H = (a + b) (1 - s) / (1 + s) elements are in
one of them alone. Sets are grouped in size bands; a pair is looked for in the band of its smaller
set, so a set is placed in its own band and, if it may be the larger one, in the band below. In
each band the universe of hashes is cut into segments. If one-deletion segments count twice and all
others once, weights of H + 1 make sure that a similar pair agrees in a segment, or up to one
element in a one-deletion segment. Which segments keep one-deletion neighbourhoods is chosen by
cost: index rows against expected false candidates, from the number of sets in the band.

A set leaves out its smallest segments, which unrelated sets have in common most often: an empty one with each set
that has it empty, too. There are a few segments more than needed, and a set that is small for its band has
fewer elements apart from a similar one than the segments are made for. If two similar sets agree in m segments,
each of the two leaves out at most m - 1. Which of two segments is left out first follows from the number of
elements there and from its place, so where both agree both have the same order, and the last one of
those in that order is left out by neither.

Candidates meet in buckets of equal segment content. A parity sketch bounds from below in how many
elements two sets differ, and what it cannot exclude is verified on the words themselves; see
``buckets`` for how a group of copies is linked without all its pairs. Equal sets are one class.

Defined results: a null or empty text, or one without words, has an empty set and no link; a text
of fewer words than a shingle is one shingle; every row is a document and has a row of the result,
also with a null doc_id or one that other rows have, with the same text or another; the smallest doc_id of a
component leaves nulls out, and is null where there is nothing else; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.llm import buckets
from citypulse.llm.registry import query
from citypulse.llm.storage import stored, table
from citypulse.llm.words import U64, gram_starts, grams, mix, slices, words
from citypulse.operators.lookup import map_column

#: Ratio of the sizes in a band, bits of a sketch per element.
BAND, SKETCH_BITS = 1.5, 2
#: Share of their elements that unrelated sets are expected to have in common, and the cost of testing a
#: candidate by its sketch, where an index row costs 1.
UNRELATED, CANDIDATE_COST = 0.05, 0.02
#: Text whose sets are made together, which takes some 30 times as much memory; a longer document is looked at alone.
TEXT_BYTES = 1 << 20
#: Pairs whose ids are broadcast to find their texts: at most 2 million numbers, 16 MB.
SENT_PAIRS = 1_000_000


class Band(NamedTuple):
    """Sizes ``low`` to ``high``; ``segments``, of which the first ``deletions`` are one-deletion ones; ``spare`` more than are needed."""

    low: int
    high: int
    segments: int
    deletions: int
    spare: int
    bits: int


def difference(a: int, b: int, share: Fraction) -> int:
    """The most elements that two similar sets of these sizes have apart."""
    return math.floor((a + b) * (1 - share) / (1 + share))


def bands(sizes: dict[int, int], share: Fraction, unrelated: float = UNRELATED) -> list[Band]:
    """Bands that cover the given sizes (size -> number of sets), each with its cheapest allocation."""
    out, low, most = [], 1, max(sizes, default=0)
    while low <= most:
        high = max(low, math.floor(low * BAND))
        apart = difference(high, math.floor(high / share), share)
        n = sum(c for size, c in sizes.items() if low <= size <= math.floor(high / share))
        out.append(allocated(low, high, apart, n, unrelated))
        low = high + 1
    return out


def allocated(low: int, high: int, apart: int, population: int, unrelated: float) -> Band:
    mean, best = (low + high) / 2, None
    spare = 1 + apart // 16 if apart > 2 else 0
    for twice in range((apart + 1) // 2 + 1):
        once = apart + 1 - 2 * twice + spare
        each = mean / (once + twice)
        rows = once + twice * (1 + each)
        false = CANDIDATE_COST * population * (once * unrelated**each + twice * (1 + each) * unrelated ** max(each - 1, 0))
        if best is None or rows + false < best[0]:
            best = rows + false, once, twice
    _, once, twice = best
    return Band(low, high, once + twice, twice, spare, 64 * math.ceil(SKETCH_BITS * high / 64))


class Sets(NamedTuple):
    """Distinct hashes of consecutive documents, sorted within each; ``first`` as for words."""

    values: np.ndarray
    first: np.ndarray


def shingles(column: pa.Array, size: int) -> Sets:
    w = words(column, lower=True)
    n = len(w.first) - 1
    at = gram_starts(w.first, size)
    all_grams = grams(w.hashes, size)
    value = all_grams[at] if len(at) else np.zeros(0, U64)
    doc = np.repeat(np.arange(n), np.maximum(w.counts - size + 1, 0))
    for k in range(1, size):  # texts of k words
        short = np.flatnonzero(w.counts == k)
        if len(short):
            value = np.r_[value, mix(grams(w.hashes, k)[w.first[short]] + U64(k))]
            doc = np.r_[doc, short]
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[keep], doc[keep]
    return Sets(value, np.searchsorted(doc, np.arange(n + 1)))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each group of consecutive ones; wraps."""
    total = np.zeros(len(first), U64)
    total[1:] = np.cumsum(values, dtype=U64)[first[1:] - 1] if len(values) else 0
    total[first == 0] = 0
    return total[1:] - total[:-1]


def row_hash(doc: Column, text: Column) -> list[Column]:
    """``r1, r2``: 128 bits that tell rows apart by key and text, either of which may be null."""
    key, whole = F.coalesce(doc.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))
    return [F.xxhash64(F.lit(seed), doc.isNull(), text.isNull(), key, whole).alias(f"r{seed}") for seed in (1, 2)]


def _digests(docs: DataFrame, size: int) -> DataFrame:
    """Size and 128-bit hash of the set of each document (doc_id, r1, r2, text)."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(3), TEXT_BYTES):
                part = batch.slice(a, b - a)
                s = shingles(part.column(3), size)
                h1, h2 = (_sums(mix(s.values ^ U64(seed)), s.first) for seed in (11, 23))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(np.diff(s.first)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))],
                    ["doc_id", "r1", "r2", "n_shingles", "h1", "h2"],
                )

    return docs.mapInArrow(digest, "doc_id long, r1 long, r2 long, n_shingles long, h1 long, h2 long")


def placements(s: Sets, kinds: list[Band], share: Fraction) -> Iterator[tuple[int, np.ndarray]]:
    """For each band the rows of the sets placed in it."""
    size = np.diff(s.first)
    for k, band in enumerate(kinds):
        if difference(band.high, math.floor(band.high / share), share) > 0:
            rows = np.flatnonzero((size >= band.low) & (size * share.numerator <= band.high * share.denominator))
            if len(rows):
                yield k, rows


def picked(s: Sets, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of some of the sets, the set of each value, and where each begins."""
    size = (s.first[1:] - s.first[:-1])[rows]
    first = np.r_[0, np.cumsum(size)]
    at = np.arange(first[-1]) + np.repeat(s.first[rows] - first[:-1], size)
    return s.values[at], np.repeat(np.arange(len(rows)), size), first


def most_apart(size: np.ndarray, band: Band, share: Fraction) -> np.ndarray:
    """The most elements that a set of each size has apart from a similar one that it meets in the band."""
    other = np.where(size > band.high, band.high, size * share.denominator // share.numerator)
    return (size + other) * (share.denominator - share.numerator) // (share.denominator + share.numerator)


def signatures(s: Sets, k: int, band: Band, rows: np.ndarray, share: Fraction) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set, signature, flags) of each segment that is not left out; flags: 1 the set looks for others here, 2 it is a whole segment."""
    value, own, begin = picked(s, rows)
    segment = (((value >> U64(32)) * U64(band.segments)) >> U64(32)).astype(np.int64)
    cell = own * band.segments + segment  # grows along the sorted values
    cells = len(rows) * band.segments
    first = np.searchsorted(cell, np.arange(cells + 1))
    inner = mix(value ^ U64(37))
    count = np.diff(first)
    name = mix((np.arange(cells) % band.segments + (k + 1) * 1_000_003).astype(U64))
    total = _sums(inner, first)
    whole = mix(total + name)
    # One-deletion segments weigh twice, so only the others may be left out.
    order = np.argsort(count.reshape(len(rows), -1)[:, band.deletions :], axis=1, kind="stable")
    left_out = band.segments + band.deletions - 1 - most_apart(np.diff(begin), band, share)
    row, place = np.nonzero(np.arange(order.shape[1]) < left_out[:, None])
    kept = np.ones((len(rows), band.segments), bool)
    kept[row, order[row, place] + band.deletions] = False
    at = np.flatnonzero(kept)
    out = [(at // band.segments, whole[at], np.full(len(at), 3 + 4 * k, np.int32))]
    if band.deletions:
        at = np.flatnonzero(segment < band.deletions)
        less = mix(total[cell[at]] - inner[at] + name[cell[at]])
        out.append((own[at], less, np.full(len(at), 1 + 4 * k, np.int32)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def sketches(s: Sets, band: Band, rows: np.ndarray) -> np.ndarray:
    """Parity of the number of elements in each of ``bits`` cells, packed; one row per set."""
    value, own, _ = picked(s, rows)
    cell = own * band.bits + (mix(value ^ U64(53)) % U64(band.bits)).astype(np.int64)
    odd = (np.bincount(cell, minlength=len(rows) * band.bits) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(rows), band.bits), axis=1)


def _index(docs: DataFrame, size: int, kinds: list[Band], share: Fraction) -> DataFrame:
    """Segment signatures of the sets: (signature, class hash, flags)."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = np.zeros(0, U64)
            for a, b in slices(batch.column(1), TEXT_BYTES):
                s = shingles(batch.column(1).slice(a, b - a), size)
                h1 = _sums(mix(s.values ^ U64(11)), s.first)
                _, distinct = np.unique(h1, return_index=True)
                distinct = distinct[~np.isin(h1[distinct], seen)]  # copies in a batch come once
                seen = np.r_[seen, h1[distinct]]
                for k, rows in placements(s, kinds, share):
                    rows = np.intersect1d(rows, distinct)
                    if not len(rows):
                        continue
                    owner, signature, flags = signatures(s, k, kinds[k], rows, share)
                    yield pa.RecordBatch.from_arrays([pa.array(signature.view(np.int64)), pa.array(h1[rows][owner].view(np.int64)), pa.array(flags)], ["sig", "h1", "flags"])

    return docs.mapInArrow(index, buckets.MEMBERS)


def _sketched(docs: DataFrame, size: int, kinds: list[Band], share: Fraction) -> DataFrame:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1), TEXT_BYTES):
                s = shingles(batch.column(1).slice(a, b - a), size)
                n = np.diff(s.first)
                for k, rows in placements(s, kinds, share):
                    packed = sketches(s, kinds[k], rows)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(a, b - a).take(pa.array(rows)), pa.array(np.full(len(rows), k), pa.int32()), pa.array(n[rows]), pa.array([p.tobytes() for p in packed], pa.binary())],
                        ["class", "band", "n", "sketch"],
                    )

    return docs.mapInArrow(sketch, "class long, band int, n long, sketch binary")


def _excluding(share: Fraction):  # noqa: ANN202
    """Test of pairs by their sizes and by the parity sketches, whose distance is never above that of the sets."""

    def prepare(batch: pa.RecordBatch) -> buckets.Test:
        n = batch.column(5).to_numpy()
        sketch = batch.column(6)
        width = np.diff(np.frombuffer(sketch.buffers()[1], np.int32)[sketch.offset : sketch.offset + len(sketch) + 1])
        by_width, place = {}, np.zeros(len(width), np.int64)
        for w in np.unique(width).tolist():
            rows = np.flatnonzero(width == w)
            by_width[w] = np.frombuffer(b"".join(sketch.take(pa.array(rows)).to_pylist()), np.uint64).reshape(len(rows), -1)
            place[rows] = np.arange(len(rows))

        def test(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            a, b = n[i], n[j]
            out = np.minimum(a, b) * share.denominator >= np.maximum(a, b) * share.numerator
            most = (a + b) * (share.denominator - share.numerator) // (share.denominator + share.numerator)
            for w in np.unique(width[i]).tolist():
                at = np.flatnonzero((width[i] == w) & out)
                for k in range(0, len(at), 1 << 16):
                    own = at[k : k + (1 << 16)]
                    apart = np.bitwise_count(by_width[w][place[i[own]]] ^ by_width[w][place[j[own]]]).sum(axis=1, dtype=np.int64)
                    out[own] = apart <= most[own]
            return out

        return test

    return prepare


def _verified(pairs: DataFrame, texts: DataFrame, size: int, share: Fraction) -> DataFrame:
    """The pairs whose sets of shingles, taken from the words themselves, are similar."""

    def shingle_set(text: str | None) -> set:
        w = (text or "").encode().lower().split()
        return {tuple(w)} if 0 < len(w) < size else set(zip(*(w[i:] for i in range(size)), strict=False))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, set()
        for batch in batches:
            good = []
            for a, x, y in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if a != last:
                    last, left = a, shingle_set(x.as_py())
                right = shingle_set(y.as_py())
                both = len(left & right)
                good.append(both * share.denominator >= (len(left) + len(right) - both) * share.numerator)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    asked = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    if pairs.limit(SENT_PAIRS + 1).count() <= SENT_PAIRS:
        # So few ids that they can be sent to the texts; of more, all texts are dealt out.
        texts = texts.join(F.broadcast(asked), "class", "left_semi")
    left = texts.select(F.col("class").alias("a"), F.col("text").alias("x"))
    right = texts.select(F.col("class").alias("b"), F.col("text").alias("y"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")
    return both.mapInArrow(verify, buckets.PAIR)


def similar(docs: DataFrame, share: Fraction = Fraction(4, 5), size: int = 5, doc: str = "doc_id", text: str = "text", unrelated: float = UNRELATED) -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id and component_id (least doc_id of the same set, and of the
    component), and ``first`` (null, doc_id, r1, r2): the row that stands for its component.

    ``size`` words a shingle; similar sets have intersection >= share * union.
    """
    key, words_ = F.col(doc).cast("long"), F.col(text)
    docs = docs.select(key.alias("doc_id"), *row_hash(key, words_), words_.alias("text"))
    digests = stored(_digests(docs, size), "digests")
    sizes = {r.n_shingles: r["count"] for r in digests.groupBy("n_shingles").count().collect()}  # one row per size of a text
    kinds = bands(sizes, share, unrelated)
    row = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "r1", "r2")
    classes = digests.filter("n_shingles > 0").groupBy("n_shingles", "h1", "h2").agg(F.min(row).alias("first"))
    # Classes are numbered once: their least doc_id may be null, or that of another class, too.
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "classes")

    # Buckets of two sets or more. The class of a hash comes in once the lonely signatures are gone.
    index = _index(docs.select("doc_id", "text"), size, kinds, share)
    members = buckets.shared(index)
    members = stored(members.join(classes.select("h1", "class"), "h1").select("sig", "class", "flags").distinct(), "members")
    wanted = members.select("class").distinct().join(classes.select("class", "first.r1", "first.r2"), "class")
    texts = docs.select("r1", "r2", "text").join(wanted, ["r1", "r2"]).dropDuplicates(["r1", "r2"]).select("class", "text")
    texts = stored(texts, "texts")
    sketched = stored(_sketched(texts, size, kinds, share), "sketches")
    linked = buckets.linked(members, sketched, _excluding(share), lambda pairs: _verified(pairs, texts, size, share))
    by_class = classes.join(linked.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    by_class = stored(by_class.withColumnRenamed("first", "own"), "components")
    least = by_class.groupBy("component").agg(F.min("own").alias("least"))
    by_class = map_column(by_class, "component", least, "component", "least", "first", split_hot=True)
    out = digests.join(by_class.select("n_shingles", "h1", "h2", "own", "first"), ["n_shingles", "h1", "h2"], "left")
    alone = F.col("n_shingles") == 0
    return out.select(
        "doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("own.doc_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"), "first",
    )


@query("op10_jaccard_join")
def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles are similar to nine tenths."""
    out = similar(table(spark, sf_dir, "documents"), Fraction(9, 10), 3)
    return out.select("doc_id", "n_shingles", "component_id", "class_id")
