"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` turns documents into index shards: for each block of documents, the postings (word
positions) of its terms, the words of each document, and its ids. ``search`` runs phrases against
the shards in blocks: in every shard a phrase starts from the postings of its rarest term, moved
back by the term's place in the phrase, and meets those of the next rarer terms until none is left
or all have agreed (an exact match). ``near`` keeps the starts near which enough of the terms
stand within a slop.

Terms are 64-bit hashes of lower-cased words. The index may be limited to the terms of a benchmark,
if these are few enough to be sent to all tasks; else it holds all terms.

Defined results: a null or empty text has no words and matches nothing; an item without words has
no window; a text of any length is one row of its shard, taken whole; repeated documents and items count each for itself: every row has a result of its own, also
where doc_id is null or repeated; empty tables give empty or unmatched results; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.llm.registry import query
from citypulse.llm.storage import stored, table
from citypulse.llm.words import ALNUM, slices, words

WINDOW = 13
#: Windows that are sent to all tasks at once (each of at most 13 hashes: 12 MB), and terms that an index may be limited to.
BLOCK_WINDOWS, MOST_TERMS = 100_000, 1_000_000
#: A near match has this share of a window's terms, each at most so many words from its place; windows looked for at once.
NEAR_SHARE, NEAR_SLOP, NEAR_ROWS = 0.8, 2, 1000

#: ``base`` numbers the first row of a shard; the rows of all shards have different numbers.
SHARD = "base long, digests binary, doc_ids binary, doc_nulls binary, first binary, terms binary, sizes binary, places binary"
PARTS = ("doc_ids", "doc_nulls", "first", "terms", "sizes", "places")


def windows(items: DataFrame, item: str = "item_id", text: str = "text", width: int = WINDOW) -> DataFrame:
    """Every window of ``width`` consecutive words of each item; a shorter item is one window. One row each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = words(batch.column(1), ALNUM, lower=True)
            rows, terms = [], []
            for k, (a, b) in enumerate(zip(w.first[:-1], w.first[1:], strict=True)):
                for i in range(a, max(b - width + 1, a + (b > a))):
                    rows.append(k)
                    terms.append(w.hashes[i : min(i + width, b)].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(terms, pa.list_(pa.int64()))], ["item_id", "terms"])

    kind = items.schema[item].dataType.simpleString()
    return items.select(F.col(item).alias("item_id"), text).mapInArrow(cut, f"item_id {kind}, terms array<long>")


def build_index(docs: DataFrame, terms: np.ndarray | None = None, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Index shards of documents; ``terms`` (sorted) limits which terms are kept, not which words are counted.

    The shards are stored, so the numbers of their rows are the same in every search.
    """
    spark = docs.sparkSession
    only = spark.sparkContext.broadcast(terms) if terms is not None else None

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = only.value if only else None
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 40
        for batch in batches:
            for a, b in slices(batch.column(1)):
                w = words(batch.column(1).slice(a, b - a), ALNUM, lower=True)
                ids = batch.column(0).slice(a, b - a)
                place = np.arange(len(w.hashes), dtype=np.int32)
                found = w.hashes
                if wanted is not None:
                    keep = np.zeros(len(found), bool)
                    if len(wanted):
                        keep = wanted[np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)] == found
                    found, place = found[keep], place[keep]
                order = np.argsort(found, kind="stable")
                found, place = found[order], place[order]
                cut = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(found) else np.zeros(0, int)
                digests = b"".join(batch.column(2).slice(a, b - a).to_pylist())
                parts = [ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), w.first.astype(np.int64), found[cut], np.diff(np.r_[cut, len(found)]).astype(np.int32), place]
                columns = [pa.array([base], pa.int64()), pa.array([digests], pa.binary()), *(pa.array([p.tobytes()], pa.binary()) for p in parts)]
                yield pa.RecordBatch.from_arrays(columns, ["base", "digests", *PARTS])
                base += b - a

    return stored(docs.select(F.col(doc).cast("long"), text, F.unhex(text_digest(F.col(text)))).mapInArrow(index, SHARD), "index")


def text_digest(text: F.Column) -> F.Column:
    """What a row is known by outside the index: rows of one text have one result. A null text is as an empty one."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


class Shard:
    """Postings of one shard as one sorted array of (term, place)."""

    def __init__(self, row: dict) -> None:
        self.base, self.digests = row["base"], row["digests"]
        kinds = (np.int64, np.bool_, np.int64, np.uint64, np.int32, np.int32)
        self.ids, self.nulls, self.first, self.terms, self.sizes, self.places = (np.frombuffer(row[p], k) for p, k in zip(PARTS, kinds, strict=True))
        self.begin = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        self.keys = (np.repeat(np.arange(len(self.terms), dtype=np.int64), self.sizes) << 32) | self.places

    def lookup(self, terms: np.ndarray) -> np.ndarray:
        """Place of each term in this shard, or -1."""
        if not len(self.terms):
            return np.full(terms.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def has(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        key = (term << 32) | place
        return self.keys[np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)] == key

    def within(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether a term (-1: none) stands at a place from ``low`` to ``high``."""
        if not len(self.keys):
            return np.zeros(len(term), bool)
        at = np.searchsorted(self.keys, (term << 32) | low)
        return (term >= 0) & (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] <= ((term << 32) | high))

    def starts(self, term: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and possible start for all postings of one term per row."""
        size = self.sizes[term].astype(np.int64)
        row = np.repeat(np.arange(len(term)), size)
        own = np.cumsum(size) - size
        at = np.arange(int(size.sum())) - np.repeat(own, size) + np.repeat(self.begin[term], size)
        return row, self.places[at].astype(np.int64) - offset[row]

    def document(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, place, side="right") - 1


def phrases(shard: Shard, terms: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row of each phrase and place of its start, for all exact occurrences. ``terms``: one row per phrase, padded."""
    at = shard.lookup(terms)
    width = np.arange(terms.shape[1])
    used = width < sizes[:, None]
    rows = np.flatnonzero(((at >= 0) | ~used).all(axis=1) & (sizes > 0))
    if not len(rows):
        return rows, rows
    at, used, size = at[rows], used[rows], sizes[rows]
    often = np.where(used, shard.sizes[at], np.iinfo(np.int32).max)
    rank = np.argsort(often, axis=1, kind="stable")
    row, start = shard.starts(at[np.arange(len(rows)), rank[:, 0]], rank[:, 0])
    last = start + size[row] - 1
    inside = (start >= 0) & (last < shard.first[-1])
    row, start, last = row[inside], start[inside], last[inside]
    inside = shard.document(start) == shard.document(last)
    row, start = row[inside], start[inside]
    for k in range(1, terms.shape[1]):
        offset = rank[row, k]
        good = (k >= size[row]) | shard.has(at[row, offset], start + offset)
        row, start = row[good], start[good]
        if not len(row):
            break
    return rows[row], start


def near(shard: Shard, terms: np.ndarray, sizes: np.ndarray, slop: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """As ``phrases``, where ``share`` of the terms stand at most ``slop`` words from their place in the phrase.

    A phrase starts from each of its rarest terms of which at least one must be present: all but the
    number that may be missing. Then terms are looked for from the rarest on, and a start goes as soon as it
    misses more than it may.
    """
    found = [_near(shard, terms[i : i + NEAR_ROWS], sizes[i : i + NEAR_ROWS], slop, share, i) for i in range(0, len(terms), NEAR_ROWS)]
    both = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return both[0], both[1]


def _near(shard: Shard, terms: np.ndarray, sizes: np.ndarray, slop: int, share: float, first: int) -> np.ndarray:
    at = shard.lookup(terms)
    used = np.arange(terms.shape[1]) < sizes[:, None]
    need = np.ceil(sizes * share - 1e-9).astype(int)
    rows = np.flatnonzero(((at >= 0) & used).sum(axis=1) >= np.maximum(need, 1))
    if not len(rows):
        return np.zeros((2, 0), np.int64)
    at, used, size, spare = at[rows], used[rows], sizes[rows], (sizes - need)[rows]
    often = np.where(used, np.where(at >= 0, shard.sizes[np.maximum(at, 0)], 0), np.iinfo(np.int32).max)
    rank = np.argsort(often, axis=1, kind="stable")
    leads = np.arange(terms.shape[1]) <= spare[:, None]
    own, k = np.nonzero(leads & (np.take_along_axis(at, rank, 1) >= 0) & np.take_along_axis(used, rank, 1))
    lead = rank[own, k]
    line, base = shard.starts(at[own, lead], lead)
    pairs = np.stack([np.repeat(own[line], 2 * slop + 1), (base[:, None] + np.arange(-slop, slop + 1)).ravel()])
    row, start = np.unique(pairs, axis=1)
    good = (start >= 0) & (start + size[row] <= shard.first[-1])
    row, start = row[good], start[good]
    own = shard.document(start)
    good = own == shard.document(start + size[row] - 1)
    row, start, own = row[good], start[good], own[good]
    missed = np.zeros(len(row), int)
    for k in range(terms.shape[1]):
        offset = rank[row, k]
        asked = k < size[row]
        place = start + offset
        missed += asked & ~shard.within(at[row, offset], np.maximum(place - slop, shard.first[own]), np.minimum(place + slop, shard.first[own + 1] - 1))
        good = missed <= spare[row]
        row, start, own, missed = row[good], start[good], own[good], missed[good]
        if not len(row):
            break
    return np.stack([rows[row] + first, start])


def _blocks(wins: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Windows in blocks of bounded size: items, whether null, padded terms, sizes. Read one by one, never all at once."""
    rows, n = [], 0
    for row in wins.toLocalIterator():
        rows.append(row)
        n += 1
        if n == BLOCK_WINDOWS:
            yield _block(rows)
            rows, n = [], 0
    if rows:
        yield _block(rows)


def _block(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(r.terms) for r in rows])
    terms = np.zeros((len(rows), sizes.max()), np.int64)
    for k, r in enumerate(rows):
        terms[k, : len(r.terms)] = r.terms
    return np.array([r.item_id or 0 for r in rows], np.int64), np.array([r.item_id is None for r in rows]), terms.view(np.uint64), sizes


MATCHES = "row_id long, text_sha256 string, doc_id long, n_words long, places array<int>, items array<long>, near_items array<long>"


def search(index: DataFrame, wins: DataFrame, slop: int | None = None, share: float = NEAR_SHARE) -> DataFrame:
    """For each indexed row: its number, digest of the text, doc_id, words, places of words inside occurring windows, ids of the items these are from.

    ``slop`` adds the items of which a window is near (see ``near``).
    """
    spark = index.sparkSession
    out, n = None, 0
    for block in _blocks(wins):
        n += 1
        sent = spark.sparkContext.broadcast(block)

        def look(batches: Iterator[pa.RecordBatch], sent: object = sent) -> Iterator[pa.RecordBatch]:
            items, nulls, terms, sizes = sent.value
            for batch in batches:
                for row in batch.to_pylist():
                    yield _matches(Shard(row), items, nulls, terms, sizes, slop, share)

        part = index.mapInArrow(look, MATCHES)
        out = part if out is None else out.unionByName(part)
    if out is None:

        def none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    yield _matches(Shard(row), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros((0, 1), np.uint64), np.zeros(0, int), None, share)

        out = index.mapInArrow(none, MATCHES)

    def union(column: str) -> F.Column:
        return F.array_sort(F.array_distinct(F.flatten(F.collect_list(column)))).alias(column)

    if n < 2:
        return out
    # A row of the index has one row for each block of windows.
    one = [F.max(c).alias(c) for c in ("text_sha256", "doc_id", "n_words")]
    return out.groupBy("row_id").agg(*one, union("places"), union("items"), union("near_items"))


def _matches(shard: Shard, items: np.ndarray, nulls: np.ndarray, terms: np.ndarray, sizes: np.ndarray, slop: int | None, share: float) -> pa.RecordBatch:
    row, start = phrases(shard, terms, sizes)
    doc = shard.document(start)
    span = sizes[row]
    hit = np.unique(np.repeat(start, span) + np.arange(int(span.sum())) - np.repeat(np.cumsum(span) - span, span))
    owner = shard.document(hit)
    pairs = np.unique(np.stack([doc, items[row]])[:, ~nulls[row]], axis=1)
    close = np.zeros((2, 0), int)
    if slop is not None:
        r, s = near(shard, terms, sizes, slop, share)
        close = np.unique(np.stack([shard.document(s), items[r]])[:, ~nulls[r]], axis=1)
    n = len(shard.ids)

    def lists(own: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(own, np.arange(n + 1)), pa.int32()), pa.array(values, kind))

    return pa.RecordBatch.from_arrays(
        [
            pa.array(shard.base + np.arange(n), pa.int64()),
            pa.array([shard.digests[i : i + 32].hex() for i in range(0, 32 * n, 32)], pa.string()),
            pa.array(shard.ids, pa.int64(), mask=shard.nulls),
            pa.array(np.diff(shard.first), pa.int64()),
            lists(owner, (hit - shard.first[owner]).astype(np.int32), pa.int32()),
            lists(pairs[0], pairs[1], pa.int64()),
            lists(close[0], close[1], pa.int64()),
        ],
        ["row_id", "text_sha256", "doc_id", "n_words", "places", "items", "near_items"],
    )


def vocabulary(wins: DataFrame) -> np.ndarray | None:
    """The sorted terms of the windows, or None if there are more than may be sent to all tasks."""
    terms = wins.select(F.explode("terms").alias("term")).distinct().limit(MOST_TERMS + 1).toPandas()["term"]
    return np.sort(terms.to_numpy(np.int64).view(np.uint64)) if len(terms) <= MOST_TERMS else None


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, slop: int | None = None) -> DataFrame:
    """Per row: digest of the text, words, words hit, items that occur, and whether hit words are a twentieth of all or more.

    With ``slop`` also the items that occur or are near: ``n_near`` and ``near_sha256``, like those that occur.
    """
    wins = stored(windows(benchmark, width=width), "windows")
    index = build_index(docs, vocabulary(wins))
    found = search(index, wins, slop)

    def digest(column: str) -> Column:
        return F.sha2(F.concat_ws(",", F.array_sort(F.transform(column, lambda i: i.cast("string")))), 256)

    proximity = [F.size("near_items").cast("long").alias("n_near"), digest("near_items").alias("near_sha256")] if slop is not None else []
    hit = F.size("places").cast("long")
    return found.select(
        "text_sha256", "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        digest("items").alias("items_sha256"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"), *proximity,
    )


@query("op8_contamination")
def benchmark_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact hits of benchmark windows in every document, and the items that are near."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slop=NEAR_SLOP).drop("text_sha256")
