"""Periodic runs of words by seeds on diagonals.

A run is a longest stretch of consecutive words with smallest period q whose length is at least
``least`` and at least ``power`` periods. Shifted by q it agrees with itself over all but its last q words,
so with lags dealt into classes lo <= q < 2 lo, every run of a class holds two equal k-grams q apart, k being
the least overlap that the class guarantees. k is at least q, so the second is the next place in
the document where the first recurs (a nearer one would give the run a smaller period). One index of
k-grams a class therefore yields all seeds as pairs of neighbouring occurrences: as many pairs as
words, not as many as pairs of equal words. Each seed is extended along its diagonal to both sides; a
table of the furthest word covered at each lag keeps the other seeds of a stretch from being extended
again. The k-grams are compared exactly, and those that occur once are dropped before longer ones are formed.

Defined results: a null text has no words; equal texts have equal runs, each row its own; texts of
any length are taken whole, one row at a time beyond 4 MB; equal exponents are told apart by the smaller start, then the smaller
period; an empty table gives an empty result; other columns are kept, those with the names of the
results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.llm.registry import query
from citypulse.llm.sequences import Recurring, Sequences, doubled, recurring, recurring_words, sequences
from citypulse.llm.storage import table
from citypulse.llm.words import slices

LEAST, POWER = 6, 4
RUN = "struct<start:long,length:long,period:long>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def overlap(low: int, least: int, power: int) -> int:
    """Words over which each run with a period of ``low`` or more agrees with itself, at least; it grows with ``low``."""
    return min(max(least - q, (power - 1) * q) for q in range(low, low + least))


def _seeds(grams: Recurring, low: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and lags of neighbouring occurrences whose lag is in the class; the first of each row of them."""
    at, nearest = grams.at[:-1], np.diff(grams.at)
    good = (np.diff(grams.rank) == 0) & (nearest >= low) & (nearest < 2 * low)
    at, lag = at[good], nearest[good]
    order = np.lexsort((at, lag))
    at, lag = at[order], lag[order]
    follows = np.concatenate([[False], (np.diff(at) == 1) & (np.diff(lag) == 0)]) if len(at) else np.zeros(0, bool)
    return at[~follows], lag[~follows]


def _agreeing(left: np.ndarray, right: np.ndarray) -> int:
    """Length of the common prefix."""
    at, step = 0, 64
    while at < len(right):
        other = left[at : at + step][: len(right) - at] != right[at : at + step]
        k = int(other.argmax())
        if other[k]:
            return at + k
        at, step = at + len(other), 2 * step
    return at


def runs_of(words: Sequences, least: int = LEAST, power: int = POWER) -> np.ndarray:
    """All runs as rows (document, start, length, period), by document, start and period."""
    if power < 3 or least < 1:
        raise ValueError("runs of fewer than three periods are not determined by neighbouring occurrences")
    ids, n = words.ids, len(words.ids)
    doc = words.documents()
    begin, stop = words.first[:-1], words.first[1:]
    size, low = 1, 1
    grams = recurring_words(words)
    found: list[tuple[int, int, int, int]] = []
    while len(grams.at):
        k = overlap(low, least, power)
        while 2 * size <= k and len(grams.at):
            grams = doubled(grams, n, size)
            size *= 2
        wide = doubled(grams, n, k - size) if k > size else grams
        furthest: dict[int, int] = {}
        for at, lag in zip(*(x.tolist() for x in _seeds(wide, low)), strict=True):
            if at < furthest.get(lag, -1):
                continue
            d = int(doc[at])
            first, last = int(begin[d]), int(stop[d])
            end = at + _agreeing(ids[at : last - lag], ids[at + lag : last])
            start = at - _agreeing(ids[first:at][::-1], ids[first + lag : at + lag][::-1])
            furthest[lag] = end
            length = end - start + lag
            if length >= max(least, power * lag):
                found.append((d, start - first, length, lag))
        low *= 2
    return np.array(sorted((d, s, q, length) for d, s, length, q in found), np.int64).reshape(-1, 4)[:, [0, 1, 3, 2]]


def dropped(words: Sequences, runs: np.ndarray) -> np.ndarray:
    """Words that any run holds after its first period."""
    step = np.zeros(len(words.ids) + 1, np.int64)
    start = words.first[runs[:, 0]] + runs[:, 1]
    np.add.at(step, start + runs[:, 3], 1)
    np.add.at(step, start + runs[:, 2], -1)
    return np.cumsum(step)[:-1] > 0


def periodic_runs(docs: DataFrame, least: int = LEAST, power: int = POWER, text: str = "text") -> DataFrame:
    """The columns of ``docs`` without its text, ``n_words``, ``runs`` by start and period, and ``collapsed``: the
    words that are left when of each run only the first period stays."""
    new = ("n_words", "runs", "collapsed")
    others = [c for c in docs.columns if c not in (text, *new)]
    plain = docs.select(F.col(text).alias("collapsed"), *others)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields[1:]] + ["n_words long", f"runs array<{RUN}>", "collapsed string"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column(0)):
                part = batch.slice(i, j - i)
                words = sequences(part.column(0))
                runs = runs_of(words, least, power)
                ends = np.searchsorted(runs[:, 0], np.arange(part.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], fields=list(_RUN)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(words.counts), lists, words.joined(~dropped(words, runs)).cast(pa.string())], [*others, *new]
                )

    return plain.mapInArrow(find, schema)


def most_repeated(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; the first of equal ones. Null without runs."""

    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def with_repeated_tail(docs: DataFrame) -> DataFrame:
    """``docs`` with the tail of every tenth document (by the hash of its doc_id) made periodic, as the query's contract says."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n, g = F.col("n"), F.col("g")
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    repeated = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))), " ")
    planted = docs.withColumn("w", F.when(h % 10 == 0, words)).withColumns({"n": F.size("w").cast("long"), "g": F.floor(h / 10)})
    planted = planted.withColumns({"a": F.when(n > 0, a), "p": F.when(n > 0, p)})
    return planted.withColumn("text", F.when(n > 0, repeated).otherwise(F.col("text"))).drop("w", "n", "g", "a", "p")


@query("op13_periodic_runs")
def periodic_runs_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, every tenth with a periodic tail."""
    docs = with_repeated_tail(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs(docs).withColumn("best", most_repeated(F.col("runs")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    best = F.col("best")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
