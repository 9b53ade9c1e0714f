"""Exact merge-type encoding by backtracking, and decoding, for SentencePiece models of the BPE type.

The encoding of a text is the one sequence of tokens in which every token is what merging its own
characters gives and every two neighbours stay apart when their characters are merged again. It is
found without merging the text: an Aho-Corasick automaton gives the longest token from each
position, a token that does not go with its left neighbour is replaced by its next shorter prefix,
and where none is left the position is marked as failed in a bit field and the last token is taken
back. Answers to "do these two go together" and encodings of whole words are kept in bounded tables.

A piece never holds a space mark after another character, so the parts between space marks are
encoded on their own. Characters without a piece become bytes. A null or empty text has no tokens.
Rows come back as they are, repeated ones too, with the new columns; columns of those names are replaced.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from citypulse.llm.registry import query
from citypulse.llm.storage import held, table
from citypulse.llm.words import slices

SPACE = "▁"
#: Entries of the tables of encoded words and of neighbours; a full table is begun anew.
WORDS_KEPT, PAIRS_KEPT = 200_000, 200_000


class Encoder:
    """Encoder and decoder of one model, given as the bytes of its file."""

    def __init__(self, model: bytes) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        lib = self.library
        normal = [i for i in range(lib.vocab_size()) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.ids = {lib.id_to_piece(i): i for i in normal}
        self.scores = {p: lib.get_score(i) for p, i in self.ids.items()}
        self.rank = {p: -s for p, s in self.scores.items()}
        self.none = float("inf")
        self.text = {i: p for p, i in self.ids.items()}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.single = {c for p in self.ids for c in p}
        mixed = [p for p in self.ids if SPACE in p.lstrip(SPACE) or (p.startswith(SPACE * 2) and p.strip(SPACE))]
        if mixed or any(c not in self.ids for c in self.single):
            raise ValueError("a model whose pieces hold spaces inside, or characters that are no pieces, is not supported")
        self.size = [len(self.text.get(i, "")) for i in range(lib.vocab_size())]
        self.prefix = [-1] * lib.vocab_size()
        valid = set()
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if self.merged(p) == [p]:  # others never come out of merging
                self.automaton.add_word(p, (len(p), i))
                valid.add(i)
        self.automaton.make_automaton()
        for i in valid:
            p = self.text[i]
            self.prefix[i] = next((self.ids[p[:n]] for n in range(len(p) - 1, 0, -1) if self.ids.get(p[:n]) in valid), -1)
        self.words: dict[str, tuple[tuple[int, ...], str]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.runs: dict[int, tuple[int, ...]] = {}

    def merged(self, text: str) -> list[str]:
        """Merge characters by score, the leftmost first among equals."""
        if len(text) <= 64:
            return self._merged_short(text)
        part, after, before = list(text), [*range(1, len(text)), -1], [-1, *range(len(text) - 1)]
        score, queue = self.scores, []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (both := part[a] + part[b]) in score:
                heapq.heappush(queue, (-score[both], a, b, len(both)))

        for k in range(len(part) - 1):
            offer(k, k + 1)
        while queue:
            _, a, b, size = heapq.heappop(queue)
            if not part[a] or not part[b] or len(part[a]) + len(part[b]) != size:
                continue
            part[a] += part[b]
            part[b] = ""
            after[a] = after[b]
            if after[b] >= 0:
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [p for p in part if p]

    def _merged_short(self, text: str) -> list[str]:
        rank, none, part = self.rank, self.none, list(text)
        ranks = [rank.get(a + b, none) for a, b in zip(part, part[1:], strict=False)]
        while ranks and (best := min(ranks)) < none:
            k = ranks.index(best)
            part[k : k + 2] = [part[k] + part[k + 1]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank.get(part[k - 1] + part[k], none)
            if k < len(ranks):
                ranks[k] = rank.get(part[k] + part[k + 1], none)
        return part

    def together(self, a: int, b: int) -> bool:
        """Whether two tokens stay apart when their characters are merged."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            known = self.merged(self.text[a] + self.text[b]) == [self.text[a], self.text[b]]
            self.pairs[a, b] = known
        return known

    def known(self, text: str) -> list[int]:
        """Tokens of a text of known characters."""
        pairs, together = self.pairs, self.together
        # Longest matches one after the other are the encoding if all neighbours go together.
        greedy = [i for _, (_, i) in self.automaton.iter_long(text)]
        last = greedy[0]
        for token in greedy[1:]:
            fits = pairs.get((last, token))
            if not fits and (fits is False or not together(last, token)):
                return self.backtracked(text)
            last = token
        return greedy

    def backtracked(self, text: str) -> list[int]:
        n, size, prefix = len(text), self.size, self.prefix
        pairs, together = self.pairs, self.together
        longest = [0] * n
        for end, (length, i) in self.automaton.iter(text):
            longest[end - length + 1] = i  # ends only grow, so the last one is the longest
        open_, at, last, out = bytearray(b"\x01") * (n + 1), 0, -1, []
        token = longest[0]
        while True:
            while token >= 0:
                end = at + size[token]
                if open_[end]:
                    fits = last < 0 or pairs.get((last, token))
                    if fits or (fits is None and together(last, token)):
                        break
                token = prefix[token]
            if token < 0:
                open_[at] = 0
                token = out.pop()
                last = out[-1] if out else -1
                at -= size[token]
                continue
            out.append(token)
            if end == n:
                return out
            last, at, token = token, end, longest[end]

    def part(self, text: str) -> list[int]:
        """Tokens of a text with at most one space mark, at its start."""
        if self.single.issuperset(text):
            return self.known(text)
        out, i = [], 0
        for k, c in enumerate(text):
            if c not in self.single:
                out += self.known(text[i:k]) if k > i else []
                out += [self.bytes[b] for b in c.encode()]
                i = k + 1
        return out + (self.known(text[i:]) if i < len(text) else [])

    def word(self, text: str) -> tuple[tuple[int, ...], str]:
        """Tokens of a word after one space mark, and their numbers joined by commas."""
        found = self.words.get(text)
        if found is None:
            if len(self.words) >= WORDS_KEPT:
                self.words.clear()
            ids = tuple(self.part(SPACE + text))
            found = ids, ",".join(map(str, ids))
            if len(text) <= 64:
                self.words[text] = found
        return found

    def run(self, n: int) -> tuple[int, ...]:
        """Tokens of n space marks."""
        if n not in self.runs:
            if len(self.runs) > 1000:
                self.runs.clear()
            self.runs[n] = tuple(self.ids[p] for p in self.merged(SPACE * n))
        return self.runs[n]

    def encode(self, text: str) -> tuple[list[int], str]:
        """Token numbers, and the same joined by commas."""
        if not text:
            return [], ""
        parts = text.replace(SPACE, " ").split(" ")
        get, word = self.words.get, self.word
        found = [get(p) or (word(p) if p else None) for p in parts]
        if None in found:  # several spaces in a row, or one at either end
            found = [*self._with_runs(parts, found)]
        return [i for ids, _ in found for i in ids], ",".join([s for _, s in found])

    def _with_runs(self, parts: list[str], found: list) -> Iterator[tuple[tuple[int, ...], str]]:
        empty = 0
        space = self.ids[SPACE]
        for p, f in zip(parts, found, strict=True):
            if not p:
                empty += 1
                continue
            if empty:
                ids = f[0]
                # The last mark belongs to the word if it merges with it, or else to the run.
                ids = self.run(empty + 1) + ids[1:] if ids[0] == space else self.run(empty) + ids
                f = ids, ",".join(map(str, ids))
                empty = 0
            yield f
        if empty:
            ids = self.run(empty)
            yield ids, ",".join(map(str, ids))

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids) if ids else ""


def encoder(model: bytes) -> Encoder:
    """The encoder of a model, held by each Python worker."""
    return held(("pieces", hashlib.sha256(model).hexdigest()), lambda: Encoder(model))


DIGESTS = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
TOKENS = {"ids": pa.list_(pa.int32()), "decoded": pa.string()}


def tokenized(docs: DataFrame, model: bytes, text: str = "text", outputs: str = "tokens") -> DataFrame:
    """Encode and decode a column. ``outputs``: ``tokens`` adds ids and decoded, ``digests`` their count and hashes, ``all`` both."""
    new = {**(TOKENS if outputs != "digests" else {}), **(DIGESTS if outputs != "tokens" else {})}
    kept = docs.drop(*new)
    spark_types = {"ids": T.ArrayType(T.IntegerType()), "n_tokens": T.LongType()}
    schema = T.StructType([*kept.schema.fields, *(T.StructField(c, spark_types.get(c, T.StringType())) for c in new)])
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # one model file, not data

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shipped.value)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for a, b in slices(column):
                part, rows = batch.slice(a, b - a), []
                for value in column.slice(a, b - a):
                    ids, joined = enc.encode(value.as_py() or "")
                    back = enc.decode(ids)
                    full = (ids, back) if outputs != "digests" else ()
                    rows.append(full if outputs == "tokens" else (*full, len(ids), _sha(joined), _sha(back)))
                columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(new.values())]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*batch.schema.names, *new])

    return kept.mapInArrow(tokenize, schema)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def default_model() -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


@query("op9_sentencepiece")
def sentencepiece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokenized(docs, default_model(), outputs="digests").drop("text")
