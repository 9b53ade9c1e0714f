"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text is built for each language. A text is cut greedily into the
longest phrases that occur in that text; with m characters, n characters of labelled text and c
phrases its cross entropy is about c * log2(n) / m bits a character. The language with the fewest
normalised phrases wins. n is that of the longest labelled text for all languages: a phrase never costs less
because a language has little text, which can only win by longer phrases. A letter that a language does not
have is a phrase of its own.

Characters are lower-cased letters. Each language has an alphabet of its own, all letters of its
labelled text; other letters share one symbol, and a run of anything else is one space. The automata
are dense tables (state, symbol) -> (state, phrase ended), so that many texts are parsed in step with
one array look-up a character. Those that do not fit in ``DENSE_BYTES`` keep their edges as sorted
keys, which gives the same in smaller memory and more time.
Texts are cut into lanes of ``LANE`` characters that are parsed at once, each from a phrase of its own. Then
the lanes of a text are stitched: the phrase that reaches a border is parsed on until a phrase begins where
one of the lane's own does, from where on both are the same. So all texts are parsed by one rule, whatever
their length.

The labelled text is a bounded sample (``SAMPLE_DOCS`` documents and ``SAMPLE_CHARS`` characters a
language) of every label, taken by a hash of key and text; everything else reads all rows. Defined results: a
null, an empty text and one without letters is ``und`` with score 0; rows come back as they are, repeated ones
too; in the sample repeated rows count once, and rows without a key like any others; ties go to the first
language in alphabetical order; a label whose sample has no letter is no language; without labelled
rows every text is ``und``; columns named as the results are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citypulse.llm.registry import query
from citypulse.llm.storage import held, table
from citypulse.llm.words import slices

#: Bounds of the fitted sample: documents and characters for each language.
SAMPLE_DOCS, SAMPLE_CHARS = 400, 60_000
#: Bytes of all dense tables of a model.
DENSE_BYTES = 128 << 20
#: Text that is parsed together; a longer document is parsed alone.
TEXT_BYTES = 2 << 20
LANE = 2048
UNKNOWN = "und"
SPACE, RARE = 0, 1


def sample(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> dict[str, str]:
    """Labelled text by language: whole documents in the order of a hash of their key, up to the documented bounds."""
    rows = labelled.filter(F.col(lang).isNotNull() & (F.length(F.trim(F.col(text))) > 0))
    sizes = {r[lang]: r["count"] for r in rows.groupBy(lang).count().collect()}
    if not sizes:
        return {}
    share = F.create_map(*(x for name, n in sizes.items() for x in (F.lit(name), F.lit(min(1.0, 4 * SAMPLE_DOCS / n)))))
    place = F.pmod(F.xxhash64(F.col(key).cast("string"), F.col(text)), F.lit(1 << 40))
    few = rows.select(lang, key, text, place.alias("place")).filter(F.col("place") < share[F.col(lang)] * float(1 << 40)).distinct()
    few = few.withColumn("size", F.least(F.length(text), F.lit(SAMPLE_CHARS)))
    order = Window.partitionBy(lang).orderBy("place", text)
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = few.withColumn("rank", F.row_number().over(order)).withColumn("before", before)
    # Whole documents, until the characters suffice: at most twice as many reach the driver.
    best = ranked.filter((F.col("rank") <= SAMPLE_DOCS) & (F.col("before") < SAMPLE_CHARS)).select(lang, F.substring(text, 1, SAMPLE_CHARS).alias("text"), "rank")
    out = {name: "" for name in sorted(sizes)}
    for r in sorted(best.collect(), key=lambda r: (r[lang], r["rank"])):
        if len(out[r[lang]]) < SAMPLE_CHARS:
            out[r[lang]] += " " + r["text"]
    return {name: t[:SAMPLE_CHARS] for name, t in out.items()}


class Alphabet:
    """Symbols of code points: space, rare letters (those of no language), then all letters of the texts, the most frequent first."""

    def __init__(self, texts: list[str]) -> None:
        points, counts = np.unique(_points("".join(texts)), return_counts=True)
        is_letter = np.array([chr(p).isalpha() for p in points], bool)
        points, counts = points[is_letter], counts[is_letter]
        self.letters = points[np.lexsort((points, -counts))]
        self.size = len(self.letters) + 2
        self.low = np.zeros(0x3000, np.int32)
        self.low[[p for p in range(0x3000) if chr(p).isalpha()]] = RARE
        for k, p in enumerate(self.letters):
            if p < len(self.low):
                self.low[p] = k + 2
        self.high = {int(p): k + 2 for k, p in enumerate(self.letters) if p >= len(self.low)}

    def symbols(self, points: np.ndarray) -> np.ndarray:
        out = self.low[np.minimum(points, len(self.low) - 1)]
        beyond = np.flatnonzero(points >= len(self.low))
        if len(beyond):
            distinct, back = np.unique(points[beyond], return_inverse=True)
            out[beyond] = np.array([self.high.get(int(p), RARE if chr(p).isalpha() else SPACE) for p in distinct], np.int32)[back]
        return out


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def automaton(symbols: np.ndarray) -> list[dict[int, int]]:
    """Suffix automaton of a sequence: the edges (symbol -> state) of each state; the first one is the root."""
    links, length, edges = [-1], [0], [{}]
    last = 0
    for c in symbols.tolist():
        current = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        links.append(0)
        p = last
        while p >= 0 and c not in edges[p]:
            edges[p][c] = current
            p = links[p]
        if p >= 0:
            q = edges[p][c]
            if length[q] == length[p] + 1:
                links[current] = q
            else:
                copy = len(edges)
                edges.append(dict(edges[q]))
                length.append(length[p] + 1)
                links.append(links[q])
                while p >= 0 and edges[p].get(c) == q:
                    edges[p][c] = copy
                    p = links[p]
                links[q] = links[current] = copy
        last = current
    return edges


class Parser:
    """Automaton of one language over the symbols of its own letters. A move is twice the next state, plus 1 where a phrase begins with the symbol."""

    def __init__(self, symbols: np.ndarray, n_symbols: int, room: int) -> None:
        own = np.setdiff1d(symbols, [SPACE, RARE])
        self.local = np.full(n_symbols, RARE, np.int32)
        self.local[SPACE] = SPACE
        self.local[own] = np.arange(2, len(own) + 2)
        self.size = len(own) + 2
        edges = automaton(self.local[symbols])
        # Where the phrase cannot grow it ends, and the next one begins with this symbol.
        self.begin = np.full(self.size, 1, np.int32)
        for c, to in edges[0].items():
            self.begin[c] = 2 * to + 1
        n = np.array([len(out) for out in edges])
        keys = np.repeat(np.arange(len(edges), dtype=np.int64), n) * self.size + np.fromiter((c for out in edges for c in out), np.int64, n.sum())
        moves = 2 * np.fromiter((to for out in edges for to in out.values()), np.int32, n.sum())
        moves[: n[0]] += 1  # out of the root every phrase begins
        self.table = self.keys = self.moves = None
        if 4 * len(edges) * self.size <= room or not len(keys):
            self.table = np.tile(self.begin, len(edges))
            self.table[keys] = moves
        else:
            order = np.argsort(keys)
            self.keys, self.moves = keys[order], moves[order]

    def move(self, state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        key = state * self.size + symbols
        if self.table is not None:
            return self.table[key]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.moves[at], self.begin[symbols])


class Model:
    """Languages and their automata."""

    def __init__(self, texts: dict[str, str]) -> None:
        self.names = [n for n in sorted(texts) if any(c.isalpha() for c in texts[n])]
        self.alphabet = Alphabet([texts[n] for n in self.names])
        samples = [squeezed(self.alphabet.symbols(_points(texts[n])))[0] for n in self.names]
        self.bits = math.log2(max([2, *map(len, samples)]))
        self.parsers, room = [], DENSE_BYTES
        for symbols in samples:
            parser = Parser(symbols, self.alphabet.size, room)
            self.parsers.append(parser)
            room -= 0 if parser.table is None else parser.table.nbytes

    def entropies(self, symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Bits a character for each text (rows) and language. ``first``: where each text begins, and the end."""
        size = np.diff(first)
        n_lanes = -(-size // LANE)
        owner = np.repeat(np.arange(len(size)), n_lanes)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(n_lanes) - n_lanes, n_lanes)
        begin = first[:-1][owner] + within * LANE
        width = np.minimum(LANE, first[1:][owner] - begin)
        order = np.argsort(-width, kind="stable")
        alive = np.searchsorted(-width[order], -np.arange(1, LANE + 1), side="right") if len(width) else np.zeros(LANE, int)
        ordered, later = begin[order], np.flatnonzero(within > 0)
        phrases = np.zeros((len(size), len(self.names)))
        for k, parser in enumerate(self.parsers):
            own = parser.local[symbols]
            starts = np.zeros(len(symbols), bool)
            state = np.zeros(len(owner), np.int64)
            for i in range(int(width.max(initial=0))):
                n = alive[i]
                at = ordered[:n] + i
                move = parser.move(state[:n], own[at])
                starts[at] = move & 1
                state[:n] = move >> 1
            last = np.empty_like(state)
            last[order] = state
            total = np.zeros(len(starts) + 1, np.int32 if len(starts) < 1 << 31 else np.int64)
            np.cumsum(starts, out=total[1:])
            counted = (total[begin + width] - total[begin]).astype(np.int64)
            # All borders at once, as if the lane before ended in the state of its own parse. Where it does not,
            # since the two never met in it, the next one is done again: of each text the first such lane.
            lanes, used, final = later, np.full(len(owner), -1), last.copy()
            while len(lanes):
                used[lanes], last[lanes] = last[lanes - 1], final[lanes]
                _stitch(parser, own, starts, total, begin, width, lanes, used[lanes], last, counted)
                wrong = later[last[later - 1] != used[later]]
                lanes = wrong[np.unique(owner[wrong], return_index=True)[1]]
            phrases[:, k] = np.bincount(owner, counted, len(size)) * self.bits
        return phrases / np.maximum(size, 1)[:, None]


def _stitch(parser: Parser, own: np.ndarray, starts: np.ndarray, total: np.ndarray, begin: np.ndarray, width: np.ndarray, lanes: np.ndarray, state: np.ndarray, last: np.ndarray, counted: np.ndarray) -> None:
    """Count the phrases of lanes as they are when parsed on in a state; sets ``counted``, and ``last`` where the lane's own parse is never met."""
    state, seen, left = state.copy(), np.zeros(len(lanes), np.int64), np.arange(len(lanes))
    for i in range(int(width[lanes].max(initial=0))):
        ended = width[lanes[left]] <= i
        done = left[ended]
        counted[lanes[done]], last[lanes[done]] = seen[done], state[done]
        left = left[~ended]
        if not len(left):
            return
        at = begin[lanes[left]] + i
        move = parser.move(state[left], own[at])
        state[left] = move >> 1
        seen[left] += move & 1
        met = (move & 1 == 1) & starts[at]
        lane = lanes[left[met]]
        # From here on the lane's own phrases, and its own last state, are right.
        counted[lane] = seen[left[met]] + total[begin[lane] + width[lane]] - total[at[met] + 1]
        left = left[~met]
    counted[lanes[left]], last[lanes[left]] = seen[left], state[left]


def squeezed(symbols: np.ndarray, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Runs of spaces as one, none at the start of a text; and where each text then begins."""
    first = np.array([0, len(symbols)]) if first is None else first
    space = symbols == SPACE
    again = space.copy()
    again[1:] &= space[:-1]
    edge = first[:-1][first[:-1] < len(symbols)]
    again[edge] = space[edge]
    keep = ~again
    return symbols[keep], np.r_[0, np.cumsum(keep)][first]


def text_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all rows, and where each row begins."""
    rows = pc.fill_null(column, "").to_pylist()
    rows = [t.lower() for t in rows]
    return np.frombuffer("".join(rows).encode("utf-32-le", "surrogatepass"), np.uint32), np.r_[0, np.cumsum([len(t) for t in rows], dtype=np.int64)]


#: How strongly one bit a character counts in the score.
SHARPNESS = 4.0


def identify(docs: DataFrame, texts: dict[str, str], text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (the winner's share if each language weighs 2 ** (-SHARPNESS * bits)) and ``bits`` (its bits a character)."""
    new = {"lang_pred": T.StringType(), "score": T.DoubleType(), "bits": T.DoubleType()}
    kept = docs.drop(*new)
    schema = T.StructType([*kept.schema.fields, *(T.StructField(c, kind) for c, kind in new.items())])
    sent = docs.sparkSession.sparkContext.broadcast(texts)  # SAMPLE_CHARS characters a language at most

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(sent.value)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            names, scores, bits = [], [], []
            for a, b in slices(column, TEXT_BYTES):
                points, first = text_points(column.slice(a, b - a))
                symbols, first = squeezed(model.alphabet.symbols(points), first)
                lettered = np.r_[0, np.cumsum(symbols != SPACE)][first]
                none = (np.diff(lettered) == 0) | (len(model.names) == 0)
                if len(model.names):
                    h = model.entropies(symbols, first)
                    best = h.argmin(axis=1)
                    least = h[np.arange(len(h)), best]
                    share = 1 / np.exp2(-SHARPNESS * (h - least[:, None])).sum(axis=1)
                    names += [UNKNOWN if z else model.names[k] for z, k in zip(none, best, strict=True)]
                    scores.append(np.where(none, 0.0, share))
                    bits.append(np.where(none, np.nan, least))
                else:
                    names += [UNKNOWN] * (b - a)
                    scores.append(np.zeros(b - a))
                    bits.append(np.full(b - a, np.nan))
            columns = [pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else []), pa.array(np.concatenate(bits) if bits else [], pa.float64(), from_pandas=True)]
            columns[1] = columns[1].cast(pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *new])

    return kept.mapInArrow(predict, schema)


def _model(texts: dict[str, str]) -> Model:
    """The model of a sample, held by each Python worker."""
    return held(("language", hash(tuple(sorted(texts.items())))), lambda: Model(texts))


def held_out(key: Column) -> Column:
    """The fold of documents that nothing is learnt from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@query("op2_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    texts = sample(docs.filter(~held_out(F.col("doc_id"))))
    out = identify(docs.select("doc_id", "text"), texts)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits")
