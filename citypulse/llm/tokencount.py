"""Token counts of documents in flat, unindexed token files, by scanning for end-of-document identifiers.

A token file is a run of fixed-width integers without header or index; a document ends with the
separator identifier and may begin in one file and end in a later one. A file of more than ``WHOLE_BYTES``
is cut into ranges of ``BLOCK_TOKENS`` that tasks read by themselves; a smaller one is one range, searched in
blocks. What a range knows is how many separators it holds and where the first and the last are; a prefix
scan over the ranges in order of path and place says which document each separator ends and where it
began. It runs in two levels: within groups of neighbouring ranges, and over one row for each group.

Ranges are read with pyarrow.fs. In a store that only Spark can open, every file is read whole, and is limited to 2 GiB.

``write_tokens`` makes such files from texts: each document is one record of the text sink, whose line
separator has the bytes of the separator identifier.

Defined results: an empty text is a document without tokens, as a null one is; tokens after the last
separator are a document that has not ended (``ended`` false); a document begins right after the
separator before it, even where that is the end of a file; empty files and folders have no
documents; a file whose length is no multiple of the width is an error.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citypulse.llm.registry import query
from citypulse.llm.storage import shared_folder, stored, table

#: Big-endian 16-bit identifiers; the separator is free in the vocabulary, and its two bytes, C4 80, are UTF-8 for one character.
DTYPE, SEPARATOR = ">u2", 50304
BLOCK_TOKENS = 1 << 20
#: Files up to this size are read by Spark in one piece.
WHOLE_BYTES = 64 << 20


def tokenizer(ranks: dict[bytes, int]) -> object:
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def default_ranks() -> dict[bytes, int]:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def write_tokens(docs: DataFrame, path: str, ranks: dict[bytes, int] | None = None, text: str = "text", documents_per_file: int = 20_000) -> None:
    """Write the tokens of a column as flat files of at most so many documents. ``ranks``: a byte-level vocabulary."""
    sent = docs.sparkSession.sparkContext.broadcast(ranks or default_ranks())  # one vocabulary, not data

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(sent.value)
        for batch in batches:
            tokens = [np.array(own.encode_ordinary(t.as_py() or ""), DTYPE).tobytes() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.binary())], ["tokens"])

    tokens = docs.select(text).mapInArrow(encode, "tokens binary")
    separator = np.array([SEPARATOR], DTYPE).tobytes().decode()
    tokens.select(F.col("tokens").cast("string")).write.option("lineSep", separator).option("maxRecordsPerFile", documents_per_file).text(path)


def scan_blocks(tokens: np.ndarray, separator: int, block: int = BLOCK_TOKENS) -> tuple[np.ndarray, np.ndarray]:
    """Places of all separators in a file and where the document that each one ends begins, -1 before the first.

    Blocks are searched one by one; the carry of the scan is the end of the last document before the block.
    """
    places = [np.flatnonzero(tokens[i : i + block] == separator) + i for i in range(0, len(tokens), block)]
    carry, starts = -1, []
    for own in places:
        begin = np.empty_like(own)
        begin[1:] = own[:-1] + 1
        if len(own):
            begin[0] = carry
            carry = own[-1] + 1
        starts.append(begin)
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *places]), np.concatenate([empty, *starts])


DOCUMENTS = "path string, at long, number long, start long, n_tokens long, opens boolean"


def _scanned(raw: DataFrame, dtype: str, separator: int) -> DataFrame:
    """Rows of ``_rows`` of whole files."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = np.dtype(dtype).itemsize
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                data = content.as_buffer()
                if data is None or data.size % width:
                    raise ValueError(f"{path.as_py()}: no whole number of {width}-byte tokens")
                yield _rows(path.as_py(), 0, np.frombuffer(data, dtype), separator)

    return raw.select(F.col("path").cast("string"), "content").mapInArrow(scan, DOCUMENTS)


def _rows(path: str, at: int, tokens: np.ndarray, separator: int) -> pa.RecordBatch:
    """(path, place of the range, number in it, start, tokens, whether it opens the range), and one row with number -1 for the rest."""
    ends, starts = scan_blocks(tokens, separator)
    opens = starts < 0
    begin = np.maximum(starts, 0)
    rest = int(ends[-1]) + 1 if len(ends) else 0
    n = len(ends)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([path] * (n + 1)), pa.array(np.full(n + 1, at)), pa.array(np.r_[np.arange(n), -1]), pa.array(np.r_[begin, rest] + at),
            pa.array(np.r_[ends - begin, len(tokens) - rest]), pa.array(np.r_[opens, n == 0]),
        ],
        ["path", "at", "number", "start", "n_tokens", "opens"],
    )


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def _readable(path: str) -> bool:
    """Whether pyarrow knows the store of a path."""
    try:
        _opened(path)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def _scanned_ranges(large: DataFrame, n_bytes: int, dtype: str, separator: int) -> DataFrame:
    """Rows of ``_rows`` of each range of large files, ``n_bytes`` in all."""
    width, block = np.dtype(dtype).itemsize, BLOCK_TOKENS
    ranges = n_bytes // (block * width) + 1
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(block * width).cast("long")))
    tasks = min(ranges, max(4 * large.sparkSession.sparkContext.defaultParallelism, ranges // 32))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length, begin in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if length % width:
                    raise ValueError(f"{path}: no whole number of {width}-byte tokens")
                store, name = _opened(path)
                with store.open_input_file(name) as f:
                    f.seek(begin)
                    data = f.read(min(block * width, length - begin))
                if len(data) != min(block * width, length - begin):
                    raise ValueError(f"{path}: shorter than listed")
                yield _rows(path, begin // width, np.frombuffer(data, dtype), separator)

    # The number of tasks is given, else these short rows would be put together in one.
    return large.select(F.col("path").cast("string"), "length", at.alias("begin")).repartition(tasks, "path", "begin").mapInArrow(scan, DOCUMENTS)


def count_tokens(spark: SparkSession, path: str, dtype: str = DTYPE, separator: int = SEPARATOR) -> DataFrame:
    """One row per document: doc_no, path and start (in the file it begins in), n_tokens without the separator, ended."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    large = raw.filter(F.col("length") > WHOLE_BYTES).select("path", "length")
    n_bytes, any_path = large.agg(F.sum("length"), F.min(F.col("path").cast("string"))).first()
    if any_path is not None and _readable(any_path):
        whole = _scanned(raw.filter(F.col("length") <= WHOLE_BYTES), dtype, separator)
        scanned = stored(whole.unionByName(_scanned_ranges(large, n_bytes, dtype, separator)), "scanned")
    else:
        scanned = stored(_scanned(raw, dtype, separator), "scanned")
    rests = scanned.filter("number = -1").select("path", "at", F.col("n_tokens").alias("rest"), F.col("start").alias("rest_at"))
    ends = scanned.filter("number >= 0").groupBy("path", "at").agg(F.count("*").alias("n_ends"))
    files = rests.join(ends, ["path", "at"], "left").withColumn("n_ends", F.coalesce("n_ends", F.lit(0)))
    # First level: sums of groups of ranges. Second level: one row for each group.
    ranged = stored(files.repartitionByRange("path", "at").withColumn("part", F.spark_partition_id()), "ranges")
    one = Window.partitionBy("part").orderBy("path", "at")
    before = one.rowsBetween(Window.unboundedPreceding, -1)
    # Tokens that stand open at the end of a range: its rest, and that of the ranges before it back to the last separator.
    last_end = F.max(F.when(F.col("n_ends") > 0, F.struct("path", "at", "rest", "rest_at")))
    parts = ranged.groupBy("part").agg(F.sum("n_ends").alias("part_ends"), last_end.alias("last"), F.min("path").alias("first_path"))
    open_rows = ranged.join(parts.select("part", "last"), "part").filter(F.col("last").isNull() | (F.struct("path", "at") >= F.struct("last.path", "last.at")))
    parts = parts.join(open_rows.groupBy("part").agg(F.sum("rest").alias("open")), "part")
    totals = {r["part"]: r for r in parts.orderBy("part").collect()}  # one row for each range
    rows, ended, carry, origin, origin_at = [], 0, 0, None, 0
    for part in sorted(totals):
        r = totals[part]
        rows.append((part, ended, carry, origin, origin_at))
        ended += r["part_ends"]
        if r["last"] is None:
            carry += r["open"]
            if origin is None:
                origin, origin_at = r["first_path"], 0
        else:
            carry, origin, origin_at = r["open"], r["last"]["path"], r["last"]["rest_at"]
    offsets = spark.createDataFrame(rows, "part int, ended_before long, carried long, origin string, origin_at long")
    # The last range with a separator before each, and the rests of all ranges since: the difference of two running sums.
    placed = (
        ranged.join(offsets, "part")
        .withColumn("ends_before", F.col("ended_before") + F.coalesce(F.sum("n_ends").over(before), F.lit(0)))
        .withColumn("rests_before", F.coalesce(F.sum("rest").over(before), F.lit(0)))
    )
    base = F.last(F.when(F.col("n_ends") > 0, F.struct(F.col("rests_before").alias("rests"), "path", "rest_at")), ignorenulls=True).over(before)
    placed = placed.withColumn("base", base).withColumn(
        "open_before", F.when(F.col("base").isNull(), F.col("carried") + F.col("rests_before")).otherwise(F.col("rests_before") - F.col("base.rests"))
    )
    begin_path = F.when(F.col("base").isNotNull(), F.col("base.path")).otherwise(F.coalesce("origin", F.first("path").over(one.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    begin_at = F.when(F.col("base").isNotNull(), F.col("base.rest_at")).otherwise(F.coalesce("origin_at", F.lit(0)))
    placed = placed.select("path", "at", "ends_before", "open_before", begin_path.alias("begin_path"), begin_at.alias("begin_at"))
    own = scanned.filter("number >= 0").join(placed, ["path", "at"])
    joined = F.col("opens")
    out = own.select(
        (F.col("ends_before") + F.col("number")).alias("doc_no"),
        F.when(joined, F.col("begin_path")).otherwise(F.col("path")).alias("path"),
        F.when(joined, F.col("begin_at")).otherwise(F.col("start")).alias("start"),
        (F.col("n_tokens") + F.when(F.col("opens"), F.col("open_before")).otherwise(0)).alias("n_tokens"),
        F.lit(True).alias("ended"),
    )
    if carry:
        out = out.unionByName(spark.createDataFrame([(ended, origin, origin_at, carry, False)], "doc_no long, path string, start long, n_tokens long, ended boolean"))
    return out


@query("op5_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, from flat token files of all documents."""
    path = f"{shared_folder(spark)}/tokens"
    write_tokens(table(spark, sf_dir, "documents"), path)
    return count_tokens(spark, path).select("doc_no", F.element_at(F.split("path", "/"), -1).alias("file"), "start", "n_tokens", "ended")
