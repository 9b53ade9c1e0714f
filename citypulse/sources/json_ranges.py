"""Members of one large JSON document, read by many tasks.

The text source splits a file at any separator, so a document of one line comes as fragments that end in a
closing brace or a comma, in ranges of bytes that different tasks read. What a fragment means depends on what came
before it: whether it begins inside a string, and how deep it is nested. Each range says what it changes, for
either beginning (a pass that returns a row a range); a running sum over the ranges of a file
gives every range its beginning, and the second pass cuts the members out. A member that crosses a border of ranges
comes in pieces, which are joined at the end: at most two pieces a range.

Documents must be valid JSON in UTF-8. Text between two cuts is given as it stands; what is no member of the wanted
kind is for the caller to tell.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE, SLASH = ord('"'), ord("\\")


def _fragments(spark: SparkSession, path: str, separator: str) -> DataFrame:
    place = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")
    return spark.read.option("lineSep", separator).text(path).select("value", *place)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """Rows of a batch by the range they belong to, in order."""
    keys = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
    at = 0
    for key, group in itertools.groupby(keys):
        end = at + len(list(group))
        yield key, at, end
        at = end


def _bytes(values: pa.Array, separator: str) -> np.ndarray:
    """All fragments one after the other, each with its separator again."""
    return np.frombuffer(b"".join(v + separator.encode() for v in values.cast(pa.binary()).to_pylist()), np.uint8)


def _quotes(data: np.ndarray) -> np.ndarray:
    """Quotes that no odd row of backslashes stands before. A fragment never begins within an escape."""
    at = np.arange(len(data))
    before = np.concatenate([[-1], np.maximum.accumulate(np.where(data != SLASH, at, -1))[:-1]])
    return (data == QUOTE) & ((at - 1 - before) % 2 == 0)


def _steps(data: np.ndarray) -> np.ndarray:
    step = np.zeros(256, np.int64)
    step[[ord("{"), ord("[")]] = 1
    step[[ord("}"), ord("]")]] = -1
    return step[data]


def _summary(fragments: DataFrame, separator: str) -> dict[tuple[str, int], tuple[bool, int]]:
    """Whether each range begins inside a string, and how deep. One row a range reaches the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list[int]] = {}
        for batch in batches:
            for key, i, j in _runs(batch):
                data = _bytes(batch.column(0).slice(i, j - i), separator)
                quote = _quotes(data)
                odd = (np.cumsum(quote) - quote) % 2 == 1
                step = _steps(data)
                clear, within = int(step[~odd].sum()), int(step[odd].sum())
                own = found.setdefault(key, [0, 0, 0])
                if own[0]:
                    clear, within = within, clear
                found[key] = [(own[0] + int(quote.sum())) % 2, own[1] + clear, own[2] + within]
        if found:
            rows = [(*key, *own) for key, own in found.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["path", "start", "odd", "clear", "within"])

    rows = fragments.mapInArrow(sums, "path string, start long, odd long, clear long, within long").collect()
    out: dict[tuple[str, int], tuple[bool, int]] = {}
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r.path, r.start)), lambda r: r.path):
        inside, depth = False, 0
        for r in group:
            out[r.path, r.start] = inside, depth
            depth += r.within if inside else r.clear
            inside ^= bool(r.odd)
    return out


def members(spark: SparkSession, path: str, depth: int, separator: str = "}") -> DataFrame:
    """``value``: the texts between cuts at a depth of nesting, that is what an array or object there lists.

    ``separator`` is ``}`` or ``,``: fragments end there, so members should have some of it.
    """
    fragments = _fragments(spark, path, separator)
    begins = _summary(fragments, separator)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of the range at hand: state, text since the last cut, whether a cut came yet.
        key, inside, level, rest, seen = None, False, 0, b"", False

        def rows(out: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["path", "start", "part", "value"])

        def border() -> list[tuple]:
            """What the range leaves to the next one: the first part of a member, or a middle one."""
            if key is None or not (level >= depth):
                return []
            return [(*key, 3 if seen else 2, rest.decode())]

        for batch in batches:
            out = []
            for own, i, j in _runs(batch):
                if own != key:
                    out += border()
                    key, rest, seen = own, b"", False
                    inside, level = begins[own]
                data = _bytes(batch.column(0).slice(i, j - i), separator)
                quote = _quotes(data)
                odd = (np.cumsum(quote) - quote + inside) % 2 == 1
                step = np.where(odd, 0, _steps(data))
                after = level + np.cumsum(step)
                cuts = np.flatnonzero(~odd & (((step == 1) & (after == depth)) | ((step == -1) & (after == depth - 1)) | ((data == ord(",")) & (after == depth))))
                text, at, open_ = data.tobytes(), 0, level >= depth
                for c in cuts.tolist():
                    if open_:
                        # The first member of a range that began inside one is the end of that.
                        out.append((*key, 0 if seen else 1, (rest + text[at:c]).decode()))
                    rest, at, seen, open_ = b"", c + 1, True, bool(after[c] >= depth)
                rest = rest + text[at:] if open_ else b""
                inside, level = bool((inside + int(quote.sum())) % 2), int(after[-1])
            if out:
                yield rows(out)
        if last := border():
            yield rows(last)

    # part: 0 a whole member, 1 the end of one, 2 a middle, 3 a beginning.
    found = fragments.mapInArrow(cut, "path string, start long, part int, value string")
    order = Window.partitionBy("path").orderBy("start", "part")
    pieces = found.filter("part > 0").withColumn("member", F.sum(F.when(F.col("part") == 3, 1).otherwise(0)).over(order))
    joined = pieces.groupBy("path", "member").agg(F.array_sort(F.collect_list(F.struct("start", "part", "value"))).alias("parts"))
    return found.filter("part = 0").select("value").unionByName(joined.select(F.array_join(F.transform("parts", lambda p: p["value"]), "").alias("value")))
