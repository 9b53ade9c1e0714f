"""Language-model scoring by deleted interpolation.

The probability of a token w after u mixes the relative frequency of the pair, that of w and a
uniform one:

    P(w | u) = a c(u, w) / c(u) + b c(w) / N + c / (V + 1)

The weights a, b, c depend on the bucket of c(u), the power of two it lies between. They are learned by
expectation-maximisation on held-out counts: one fold of the training documents is deleted from the
counts and scored by what is left; a held-out pair belongs to the bucket of its context's count there, as it
is, and only its frequencies are rounded. Counts for the scores then cover all training documents, so a
context is scored by the weights of the bucket of its full count.

Counts never come to one place. Documents are packed in chunks. A chunk
asks for its distinct tokens or pairs, dealt out by hash; each shard adds up and answers in the
order asked. So a token that is everywhere has one entry a chunk. Tokens are told apart by 64-bit
hashes of their bytes, which travel sorted, as differences. For the weights each shard counts held-out pairs in cells (bucket, and both
frequencies in steps of a quarter of a power of two), and only these counts, whose number does not
grow with the corpus, reach the driver.

Defined results: a null or empty text is the end token alone; repeated rows are documents of their own,
each counted and returned; a null doc_id is in the training documents; a text of any length is
one row of its chunk, taken whole; equal probabilities need no order; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import io
import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.llm.registry import query
from citypulse.llm.storage import stored, table
from citypulse.llm.words import U64, join, mix, slices, words

#: Text of a chunk, entries of a shard, steps of a power of two, rounds of expectation-maximisation.
CHUNK_BYTES, SHARD_ENTRIES, STEPS, ROUNDS = 12 << 20, 600_000, 4, 60
END = mix(np.array([2**40 + 1], U64))
PACKED = "chunk long, size long, docs binary"


def _packed(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, fold, text) as one compressed row for each chunk."""

    def emit(chunk: int, parts: list[pa.RecordBatch], size: int) -> pa.RecordBatch:
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 7))) as out:
            for p in parts:
                out.write_batch(p)
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([size], pa.int64()), pa.array([sink.getvalue()], pa.binary())], ["chunk", "size", "docs"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        parts, size = [], 0
        for batch in batches:
            for a, b in slices(batch.column(2)):
                part = batch.slice(a, b - a)
                parts.append(part)
                size += part.column(2).nbytes
                if size >= CHUNK_BYTES:
                    yield emit(chunk, parts, size)
                    chunk, parts, size = chunk + 1, [], 0
        if parts:
            yield emit(chunk, parts, size)

    return docs.mapInArrow(pack, PACKED)


class Chunk(NamedTuple):
    """Tokens of the documents of a chunk: every document's words, then the end token."""

    ids: pa.Array
    folds: np.ndarray
    tokens: np.ndarray
    first: np.ndarray

    def fold_of_tokens(self) -> np.ndarray:
        return np.repeat(self.folds, np.diff(self.first))

    def contexts(self) -> np.ndarray:
        """The token before each; the end token stands before the first one."""
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        if len(before):
            before[0] = END[0]
        return before


def opened(docs: bytes) -> Chunk:
    ids, folds, tokens, counts = [], [], [], []
    for batch in pa.ipc.open_stream(docs):
        w = words(batch.column(2), lower=True)
        ids.append(batch.column(0))
        folds.append(batch.column(1).to_numpy())
        counts.append(w.counts + 1)
        own = np.empty(len(w.hashes) + batch.num_rows, U64)
        end = np.cumsum(w.counts + 1) - 1
        is_end = np.zeros(len(own), bool)
        is_end[end] = True
        own[is_end] = END[0]
        own[~is_end] = w.hashes
        tokens.append(own)
    return Chunk(pa.concat_arrays(ids), np.concatenate(folds), np.concatenate(tokens), np.r_[0, np.cumsum(np.concatenate(counts))])


def _z(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), "zstd", asbytes=True)


def _unz(value: bytes, kind: type, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(value, n * np.dtype(kind).itemsize, "zstd", asbytes=True), kind)


def _differences(ascending: np.ndarray) -> bytes:
    """Sorted hashes as differences, their bytes by place: the high ones are mostly 0."""
    steps_ = np.diff(ascending, prepend=U64(0))
    return _z(np.ascontiguousarray(steps_.view(np.uint8).reshape(-1, 8).T))


def _ascending(value: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(_unz(value, np.uint8, 8 * n).reshape(8, n).T).view(U64).ravel(), dtype=U64)


class Folds(NamedTuple):
    """Which of the ``of`` folds is never learnt from and which is deleted to learn the weights."""

    of: int
    unseen: int
    deleted: int


ASKED = "shard int, chunk long, n int, hashes binary, train binary, deleted binary, context binary, token binary"
ASKED_COLUMNS = ("shard", "chunk", "n", "hashes", "train", "deleted", "context", "token")
ANSWER = "kind string, shard int, chunk long, n int, train binary, deleted binary, total long, known long, bucket int, pair int, single int, weight long"


def _request(chunk: int, keys: np.ndarray, fold: np.ndarray, folds: Folds, shards: int, context: np.ndarray | None = None, token: np.ndarray | None = None) -> Iterator[dict]:
    """Distinct keys of a chunk with their counts, by shard. A shard is a range of hashes."""
    distinct, where = np.unique(keys, return_inverse=True)
    train = np.bincount(where, fold != folds.unseen, len(distinct)).astype(np.uint32)
    deleted = np.bincount(where, fold == folds.deleted, len(distinct)).astype(np.uint32)
    shard = ((distinct >> U64(32)) * U64(shards) >> U64(32)).astype(np.int64)
    if context is not None:
        some = np.zeros(len(distinct), np.int64)
        some[where] = np.arange(len(keys))
        context, token = context[some], token[some]
    cut = np.searchsorted(shard, np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(cut)).tolist():
        i, j = cut[s], cut[s + 1]
        row = {"shard": s, "chunk": chunk, "n": int(j - i), "hashes": _differences(distinct[i:j]), "train": _z(train[i:j]), "deleted": _z(deleted[i:j]), "context": None, "token": None}
        if context is not None:
            held = deleted[i:j] > 0
            row |= {"context": _z(context[i:j][held]), "token": _z(token[i:j][held])}
        yield row


def _asked_schema() -> pa.Schema:
    return pa.schema([("shard", pa.int32()), ("chunk", pa.int64()), ("n", pa.int32()), *((c, pa.binary()) for c in ASKED_COLUMNS[3:])])


def _tokens_asked(packed: DataFrame, folds: Folds, shards: int) -> DataFrame:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, _, docs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                c = opened(docs)
                yield pa.RecordBatch.from_pylist(list(_request(chunk, c.tokens, c.fold_of_tokens(), folds, shards)), _asked_schema())

    return packed.mapInArrow(ask, ASKED)


def steps(count: np.ndarray) -> np.ndarray:
    """A count on a scale of ``STEPS`` a power of two; 0 is 0, 1 is STEPS."""
    return np.where(count > 0, np.rint(np.log2(np.maximum(count, 1)) * STEPS) + STEPS, 0).astype(np.uint16)


def bucket(count: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, else 1 and the whole powers of two in the count."""
    return np.where(count > 0, np.frexp(np.maximum(count, 1).astype(np.float64))[1], 0).astype(np.int64)


#: Bits of the steps beside a bucket.
STEP_BITS = 9


def placed(count: np.ndarray) -> np.ndarray:
    """A context's bucket, from its count as it is, and its count in steps."""
    return (bucket(count) << STEP_BITS | steps(count)).astype(np.uint16)


def _answers(asked: DataFrame) -> DataFrame:
    """Each shard adds up the counts of all chunks, answers them, and sums what the model needs to know."""
    names = [c.split()[0] for c in ANSWER.split(", ")]

    def add(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["chunk"])
        keys = np.concatenate([_ascending(r["hashes"], r["n"]) for r in rows])
        train = np.concatenate([_unz(r["train"], np.uint32, r["n"]) for r in rows])
        deleted = np.concatenate([_unz(r["deleted"], np.uint32, r["n"]) for r in rows])
        distinct, where = np.unique(keys, return_inverse=True)
        all_train = np.bincount(where, train, len(distinct)).astype(np.int64)
        all_deleted = np.bincount(where, deleted, len(distinct)).astype(np.int64)
        out, at = [], 0
        # What the deleted fold has of a pair is asked for here only, to learn the weights.
        of_tokens = rows[0]["context"] is None
        for r in rows:
            own = where[at : at + r["n"]]
            out.append({"kind": "counts", "shard": r["shard"], "chunk": r["chunk"], "n": r["n"], "train": _z(all_train[own]), "deleted": _z(all_deleted[own]) if of_tokens else None})
            at += r["n"]
        out.append({"kind": "sums", "shard": rows[0]["shard"], "total": int(all_train.sum()), "known": int((all_train > 0).sum())})
        if rows[0]["context"] is not None:
            held = deleted > 0
            n_held = [int(x.sum()) for x in np.split(held, np.cumsum([r["n"] for r in rows])[:-1])]
            context, token = (np.concatenate([_unz(r[c], np.uint16, n) for r, n in zip(rows, n_held, strict=True)]) for c in ("context", "token"))
            pair = steps((all_train - all_deleted)[where[held]])
            cells = np.stack([context, pair, token]).astype(np.int64)
            kinds, own = np.unique(cells, axis=1, return_inverse=True)
            weight = np.bincount(own.ravel(), deleted[held], kinds.shape[1]).astype(np.int64)
            # "bucket" holds the context: its bucket and its count in steps.
            out += [{"kind": "held", "bucket": b, "pair": p, "single": s, "weight": w} for b, p, s, w in zip(*kinds.tolist(), weight.tolist(), strict=True)]
        schema = pa.schema([("kind", pa.string()), ("shard", pa.int32()), ("chunk", pa.int64()), ("n", pa.int32()), ("train", pa.binary()), ("deleted", pa.binary()), ("total", pa.int64()), ("known", pa.int64()), ("bucket", pa.int32()), ("pair", pa.int32()), ("single", pa.int32()), ("weight", pa.int64())])
        return pa.Table.from_pylist([{n: r.get(n) for n in names} for r in out], schema)

    return asked.groupBy("shard").applyInArrow(add, ANSWER)


def _counts(answers: pa.Table, kind: str, column: str = "train") -> np.ndarray:
    """Answers to a chunk in the order of its distinct keys: training counts, or those of the deleted fold."""
    rows = sorted((r for r in answers.to_pylist() if r["kind"] == kind), key=lambda r: r["shard"])
    return np.concatenate([_unz(r[column], np.int64, r["n"]) for r in rows]) if rows else np.zeros(0, np.int64)


def _pairs_asked(packed: DataFrame, tokens: DataFrame, folds: Folds, shards: int) -> DataFrame:
    def ask(own: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        left = _counts(answers, "tokens") - _counts(answers, "tokens", "deleted")
        for chunk, docs in zip(own.column("chunk").to_pylist(), own.column("docs").to_pylist(), strict=True):
            c = opened(docs)
            distinct, at = np.unique(c.tokens, return_inverse=True)
            before = np.r_[np.searchsorted(distinct, END), at[:-1]]
            # What the deleted fold leaves: the count of the context and of the token, on the scale of steps.
            rows += _request(chunk, join(c.contexts(), c.tokens), c.fold_of_tokens(), folds, shards, placed(left)[before], steps(left)[at])
        return pa.Table.from_pylist(rows, _asked_schema())

    return packed.groupBy("chunk").cogroup(tokens.groupBy("chunk")).applyInArrow(ask, ASKED)


def learned(cells: pd.DataFrame, tokens: int, known: int) -> dict[int, tuple[float, float, float]]:
    """Weights of pair, token and uniform for each bucket, by expectation-maximisation; -1 is all buckets together.

    ``cells``: contexts as placed, pair and token counts on the scale of steps, and how often each was held out.
    """
    def count(x: pd.Series) -> np.ndarray:
        return np.where(x > 0, np.exp2((x.to_numpy() - STEPS) / STEPS), 0.0)

    context, pair, single = count(cells["bucket"] & ((1 << STEP_BITS) - 1)), count(cells["pair"]), count(cells["single"])
    parts = np.stack([np.where(context > 0, np.minimum(pair / np.maximum(context, 1), 1.0), 0.0), single / max(tokens, 1), np.full(len(cells), 1 / (known + 1))])
    weight = cells["weight"].to_numpy(float)
    own = cells["bucket"].to_numpy() >> STEP_BITS
    out = {}
    for b in [-1, *np.unique(own).tolist()]:
        rows = slice(None) if b < 0 else own == b
        p, w = parts[:, rows], weight[rows]
        mixture = np.full(3, 1 / 3)
        for _ in range(ROUNDS if len(w) else 0):
            each = mixture[:, None] * p
            mixture = (each / each.sum(axis=0) * w).sum(axis=1) / w.sum()
        # A part that no held-out token asked for keeps a trace, so that no probability is 0.
        mixture = np.maximum(mixture, 1e-6)
        out[b] = tuple((mixture / mixture.sum()).tolist())
    return out


def added_one(tokens: int, known: int) -> int:
    """What a token's count and one is divided by: all tokens, and one more for each known token and one unknown."""
    return tokens + 1 * (known + 1)


def _scored(packed: DataFrame, answers: DataFrame, weights: dict[int, tuple[float, float, float]], folds: Folds, tokens: int, known: int, whole: int) -> DataFrame:
    most = max(weights)
    mixture = np.array([weights.get(b, weights[-1]) for b in range(max(most, 62) + 2)])
    names = ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")

    def score(own: pa.Table, sent: pa.Table) -> pa.Table:
        out = []
        singles, pairs = _counts(sent, "tokens"), _counts(sent, "pairs")
        for docs in own.column("docs").to_pylist():
            c = opened(docs)
            distinct, at = np.unique(c.tokens, return_inverse=True)
            context = singles[np.r_[np.searchsorted(distinct, END), at[:-1]]]
            token = singles[at]
            pair = pairs[np.unique(join(c.contexts(), c.tokens), return_inverse=True)[1]]
            m = mixture[bucket(context)]
            p = m[:, 0] * np.where(context > 0, pair / np.maximum(context, 1), 0) + m[:, 1] * token / max(tokens, 1) + m[:, 2] / (known + 1)
            base = np.log10((token + 1) / whole)
            begin = c.first[:-1]
            if len(begin):
                out.append(pa.table([c.ids, pa.array(c.folds == folds.unseen), pa.array(np.diff(c.first)), pa.array(np.add.reduceat((token > 0).astype(np.int64), begin)), pa.array(np.add.reduceat(base, begin)), pa.array(np.add.reduceat(np.log10(p), begin))], names=list(names)))
        return pa.concat_tables(out)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    return packed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, schema)


def scores(
    docs: DataFrame, fold: Column, folds: Folds, doc: str = "doc_id", text: str = "text", whole: Callable[[int, int], int] = lambda n, v: (n + 1) * (v + 1)
) -> DataFrame:
    """Base and model score of every document. ``fold`` is the number of a document's fold.

    The base score divides counts and one by ``whole`` of all and of distinct training tokens.
    """
    packed = stored(_packed(docs.select(F.col(doc).cast("long").alias("doc_id"), fold.cast("int").alias("fold"), F.col(text).alias("text"))), "chunks")
    total = packed.agg(F.sum("size")).first()[0] or 0
    # A word takes some 6 bytes. Half of the tokens of a chunk are new to it at worst, and nearly all pairs.
    few, many = (max(1, math.ceil(total / 6 / share / SHARD_ENTRIES)) for share in (4, 1))
    tokens = stored(_answers(_tokens_asked(packed, folds, few)), "tokens")
    sums = tokens.filter("kind = 'sums'").agg(F.sum("total"), F.sum("known")).first()
    n, v = sums[0] or 0, sums[1] or 0
    by_chunk = tokens.filter("kind = 'counts'").select("chunk", F.lit("tokens").alias("kind"), "shard", "n", "train", "deleted")
    pairs = stored(_answers(_pairs_asked(packed, by_chunk, folds, many)), "pairs")
    cells = pairs.filter("kind = 'held'").groupBy("bucket", "pair", "single").agg(F.sum("weight").alias("weight")).toPandas()
    weights = learned(cells, n, v)
    columns = "chunk", "kind", "shard", "n", "train"
    both = by_chunk.select(*columns).unionByName(pairs.filter("kind = 'counts'").withColumn("kind", F.lit("pairs")).select(*columns))
    return _scored(packed, both, weights, folds, n, v, whole(n, v)).withColumn("train_tokens", F.lit(n).cast("long"))


@query("op4_lm_scoring")
def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document under counts of six sevenths of them."""
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7, F.lit(0))
    out = scores(table(spark, sf_dir, "documents"), fold, Folds(7, 2, 3), whole=added_one)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
