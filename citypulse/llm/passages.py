"""Substring deduplication with repeated-phrase automata.

A window is ``width`` consecutive words. Winnowing picks from the phrases of ``PHRASE`` words of each
window one of least hash, so a window that two documents share gives both the same phrase.

1. The picked phrases of all documents are dealt out by hash, and those of two documents or more recur.
2. Documents are dealt out in chunks of bounded size, together with the hashes that recur in them. In
   each chunk the recurring phrases are compiled into an Aho-Corasick automaton, the shard of that
   chunk, and all its documents stream through it, which locates every occurrence. Only windows
   around an occurrence can be shared.
3. These windows are dealt out by hash; the least document of each is sent back to the chunks.
4. Words of windows that a smaller document also holds are removed.

Windows are compared by 64-bit hashes of their words. Hashes travel packed, with one entry for each
chunk, so a passage that a third of all documents share has one entry a chunk and no group of its own.

Defined results: a null or empty text has no words; texts shorter than a window keep all; rows of one
doc_id are one document each but never cause one another's removal (only a smaller doc_id does); a
null doc_id neither loses nor causes removal; empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.llm.registry import query
from citypulse.llm.storage import shared_folder, stored, table
from citypulse.llm.words import U64, Words, gram_starts, grams, slices, words

WIDTH, PHRASE = 50, 8
#: Text of a chunk and packed entries of a shard.
CHUNK_BYTES, SHARD_ENTRIES = 6 << 20, 500_000
_PLACE = U64((1 << 26) - 1)


def picked(w: Words, width: int = WIDTH, phrase: int = PHRASE) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the phrases that winnowing picks."""
    starts = gram_starts(w.first, width)
    hashes = grams(w.hashes, phrase)
    if not len(starts):
        return starts, hashes[:0]
    # The place in the low bits breaks ties in the same way in every document.
    value = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=U64)
    span, need, out, have = 1, width - phrase + 1, None, 0
    n = len(value) - need + 1
    while True:
        if need & span:
            part = value[have : have + n]
            out = part if out is None else np.minimum(out, part)
            have += span
        if have == need:
            break
        value = np.minimum(value[:-span], value[span:])
        span *= 2
    places = np.unique((out[starts] & _PLACE).astype(np.int64))
    return places, hashes[places]


def _packed(rows: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), *(pa.array([x.tobytes() for x in c], pa.binary()) for c in columns[2:])],
        ["shard", "chunk", "hashes", "low", "high"],
    )


PACKED = "shard int, chunk int, hashes binary, low binary, high binary"


def _dealt(hashes: np.ndarray, docs: np.ndarray, chunk: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    """Entries (hash, least and greatest document) of each shard and chunk, packed."""
    if not len(hashes):
        return
    shard = ((hashes >> U64(32)) % U64(shards)).astype(np.int64)
    order = np.lexsort((hashes, chunk, shard))
    hashes, docs, chunk, shard = hashes[order], docs[order], chunk[order], shard[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (chunk[1:] != chunk[:-1]) | (shard[1:] != shard[:-1])
    first = np.flatnonzero(new)
    low, high = np.minimum.reduceat(docs, first), np.maximum.reduceat(docs, first)
    hashes, chunk, shard = hashes[first], chunk[first], shard[first]
    cut = np.flatnonzero(np.r_[True, (chunk[1:] != chunk[:-1]) | (shard[1:] != shard[:-1])])
    rows = [(int(shard[i]), int(chunk[i]), hashes[i:j], low[i:j], high[i:j]) for i, j in zip(cut, np.r_[cut[1:], len(hashes)], strict=True)]
    for i in range(0, len(rows), 2000):
        yield _packed(rows[i : i + 2000])


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.fill_null(0).to_numpy(), ~column.is_null().to_numpy(zero_copy_only=False)


def _phrases(docs: DataFrame, shards: int, width: int) -> DataFrame:
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                part = batch.slice(a, b - a)
                w = words(part.column(1))
                ids, valid = _ids(part.column(0))
                places, hashes = picked(w, width)
                doc = np.searchsorted(w.first, places, side="right") - 1
                keep = valid[doc]
                yield from _dealt(hashes[keep], ids[doc[keep]], part.column(2).to_numpy()[doc[keep]], shards)

    return docs.select("doc_id", "text", "chunk").mapInArrow(pick, PACKED)


def _recurring(entries: DataFrame) -> DataFrame:
    """For each chunk, its hashes that two documents or more hold, with the least of them."""

    def meet(group: pa.Table) -> pa.Table:
        chunks = group.column("chunk").to_numpy()
        parts = [np.frombuffer(x, U64) for x in group.column("hashes").to_pylist()]
        low, high = (np.concatenate([np.frombuffer(x, np.int64) for x in group.column(c).to_pylist()]) for c in ("low", "high"))
        hashes = np.concatenate(parts)
        chunk = np.repeat(chunks, [len(p) for p in parts])
        order = np.argsort(hashes, kind="stable")
        hashes, low, high, chunk = hashes[order], low[order], high[order], chunk[order]
        first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
        size = np.diff(np.r_[first, len(hashes)])
        least = np.repeat(np.minimum.reduceat(low, first), size)
        again = least < np.repeat(np.maximum.reduceat(high, first), size)
        hashes, least, chunk = hashes[again], least[again], chunk[again]
        order = np.argsort(chunk, kind="stable")
        hashes, least, chunk = hashes[order], least[order], chunk[order]
        cut = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]]) if len(chunk) else np.zeros(0, int)
        ends = np.r_[cut[1:], len(chunk)][: len(cut)]
        return pa.table(
            {
                "chunk": pa.array(chunk[cut], pa.int32()),
                "hashes": pa.array([hashes[i:j].tobytes() for i, j in zip(cut, ends, strict=True)], pa.binary()),
                "least": pa.array([least[i:j].tobytes() for i, j in zip(cut, ends, strict=True)], pa.binary()),
            }
        )

    return entries.groupBy("shard").applyInArrow(meet, "chunk int, hashes binary, least binary")


def _known(table_: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Hashes sent to a chunk, sorted, and the least document of each."""
    if not table_.num_rows:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    hashes = np.concatenate([np.frombuffer(x, U64) for x in table_.column("hashes").to_pylist()])
    least = np.concatenate([np.frombuffer(x, np.int64) for x in table_.column("least").to_pylist()])
    order = np.lexsort((least, hashes))
    return hashes[order], least[order]


def _at(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where each hash is among the sorted ones, or -1."""
    if not len(known):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at, -1)


def automaton(phrases: set[str]) -> ahocorasick.Automaton | None:
    """Aho-Corasick automaton of phrases, each between spaces."""
    if not phrases:
        return None
    out = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for p in phrases:
        out.add_word(f" {p} ")
    out.make_automaton()
    return out


def occurrences(found: ahocorasick.Automaton, parts: list[bytes]) -> np.ndarray:
    """Places of the first words of all occurrences in a document."""
    text = " " + b" ".join(parts).decode("utf-8", "replace") + " "
    ends = np.array([(end, length) for end, length in found.iter(text)], np.int64).reshape(-1, 2)
    if not len(ends):
        return ends[:, 0]
    marks = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 32)
    return np.unique(np.searchsorted(marks, ends[:, 0] - ends[:, 1] + 1))


def _located(docs: DataFrame, recurring: DataFrame, shards: int, width: int) -> DataFrame:
    """Entries of the windows around recurring phrases, and the documents that have any."""
    fields = ["kind", "shard", "chunk", "hashes", "low", "high", "doc_id", "text"]
    schema = "kind int, shard int, chunk int, hashes binary, low binary, high binary, doc_id long, text string"
    arrow = pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("chunk", pa.int32()), ("hashes", pa.binary()), ("low", pa.binary()), ("high", pa.binary()), ("doc_id", pa.int64()), ("text", pa.string())])

    def locate(own: pa.Table, sent: pa.Table) -> pa.Table:
        known, _ = _known(sent)
        if not len(known) or not own.num_rows:
            return arrow.empty_table()
        own = own.combine_chunks()
        column = own.column("text").chunk(0)
        phrases: set[str] = set()
        for a, b in slices(column):
            w = words(column.slice(a, b - a))
            places, hashes = picked(w, width)
            for p in places[_at(known, hashes) >= 0].tolist():
                phrases.add(w.text(p, p + PHRASE).decode("utf-8", "replace"))
        found = automaton(phrases)
        out = []
        for a, b in slices(column):
            part = own.slice(a, b - a)
            w = words(column.slice(a, b - a))
            ids, valid = _ids(part.column("doc_id").combine_chunks())
            all_windows = grams(w.hashes, width)
            chunk = int(part.column("chunk")[0].as_py())
            hashes, docs, hit = [], [], []
            for k, value in enumerate(part.column("text").to_pylist()):
                i, j = w.first[k], w.first[k + 1]
                if not valid[k] or j - i < width or found is None:
                    continue
                places = occurrences(found, value.encode().split())
                if not len(places):
                    continue
                near = np.zeros(j - i - width + 2, np.int64)
                last = len(near) - 2
                np.add.at(near, np.minimum(np.maximum(places - (width - PHRASE), 0), last + 1), 1)
                np.add.at(near, np.minimum(places, last) + 1, -1)
                at = np.flatnonzero(np.cumsum(near)[:-1] > 0)
                hashes.append(all_windows[i + at])
                docs.append(np.full(len(at), ids[k]))
                hit.append(k)
            if hit:
                texts = part.select(["chunk", "doc_id", "text"]).take(pa.array(hit))
                none = pa.nulls(len(hit), pa.binary())
                out.append(pa.table([pa.array([1] * len(hit), pa.int32()), pa.nulls(len(hit), pa.int32()), texts.column(0), none, none, none, texts.column(1), texts.column(2)], names=fields).cast(arrow))
                h, d = np.concatenate(hashes), np.concatenate(docs)
                for packed in _dealt(h, d, np.full(len(h), chunk), shards):
                    n = packed.num_rows
                    out.append(pa.table([pa.array([0] * n, pa.int32()), *packed.columns, pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())], names=fields).cast(arrow))
        return pa.concat_tables(out) if out else arrow.empty_table()

    left = docs.select("doc_id", "text", "chunk").groupBy("chunk")
    return left.cogroup(recurring.groupBy("chunk")).applyInArrow(locate, schema)


REMOVED = "doc_id long, n_words long, n_removed long, kept string, all_sha256 string"


def _removed(suspects: DataFrame, shared: DataFrame, width: int) -> DataFrame:
    """Documents with the words of all windows removed that a smaller document holds, too."""

    def remove(own: pa.Table, sent: pa.Table) -> pa.Table:
        known, least = _known(sent)
        rows = []
        for i in range(own.num_rows):
            one = own.slice(i, 1).combine_chunks()
            doc = one.column("doc_id")[0].as_py()
            w = words(one.column("text").chunk(0))
            at = _at(known, grams(w.hashes, width))
            gone = np.flatnonzero((at >= 0) & (least[at] < doc)) if len(known) else np.zeros(0, int)
            parts = one.column("text")[0].as_py().encode().split()
            edge = np.zeros(len(parts) + 1, np.int64)
            np.add.at(edge, gone, 1)
            np.add.at(edge, gone + width, -1)
            keep = np.cumsum(edge)[:-1] == 0
            rows.append((doc, len(parts), int((~keep).sum()), b" ".join([p for p, k in zip(parts, keep.tolist(), strict=True) if k]).decode("utf-8", "replace"), hashlib.sha256(b" ".join(parts)).hexdigest()))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        return pa.table({"doc_id": pa.array(columns[0], pa.int64()), "n_words": pa.array(columns[1], pa.int64()), "n_removed": pa.array(columns[2], pa.int64()), "kept": pa.array(columns[3], pa.string()), "all_sha256": pa.array(columns[4], pa.string())})

    return suspects.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(remove, REMOVED)


def _counted(docs: DataFrame) -> DataFrame:
    """Words of every document and the hash of all of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [(t.as_py() or "").encode().split() for t in batch.column(1)]
            digests = [hashlib.sha256(b" ".join(p)).hexdigest() for p in parts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(p) for p in parts], pa.int64()), pa.array(digests)], ["doc_id", "n_words", "all_sha256"])

    return docs.select("doc_id", "text").mapInArrow(count, "doc_id long, n_words long, all_sha256 string")


def shared_passages(docs: DataFrame, width: int = WIDTH, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents that hold a window of a smaller document: doc_id, n_words, n_removed, kept (words joined by one space).

    Documents around whose recurring phrases nothing is shared come back with n_removed 0; others are left out.
    """
    if width < PHRASE:
        raise ValueError(f"a window has at least {PHRASE} words")
    spark = docs.sparkSession
    # Rows without an id take no part; left in, they would all be in one chunk.
    docs = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text")).filter(F.col("doc_id").isNotNull())
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, math.ceil(total / CHUNK_BYTES))
    docs = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))
    # A word takes some 6 bytes; one in 20 begins a picked phrase; most windows can be shared at worst.
    few, many = (max(1, math.ceil(total / 6 / share / SHARD_ENTRIES)) for share in (20, 2))
    phrases = stored(_recurring(_phrases(docs, few, width)), "phrases")
    path = f"{shared_folder(spark)}/located"
    located = _located(docs, phrases, many, width)
    located.write.partitionBy("kind").parquet(path)
    located = spark.read.schema(located.schema).parquet(path)
    shared = _recurring(located.filter("kind = 0").select("shard", "chunk", "hashes", "low", "high"))
    suspects = located.filter("kind = 1").select("chunk", "doc_id", "text")
    return _removed(suspects, shared, width)


@query("op7_substring_dedup")
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document once windows of smaller documents are removed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    removed = shared_passages(docs).select("doc_id", "n_removed", "all_sha256", F.sha2("kept", 256).alias("kept_sha256"))
    out = _counted(docs).join(removed.dropDuplicates(["doc_id", "all_sha256"]), ["doc_id", "all_sha256"], "left")
    return out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("kept_sha256", "all_sha256").alias("kept_sha256"))
