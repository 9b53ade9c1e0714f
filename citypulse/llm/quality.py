"""Line-first quality rules: lines that fail a rule go, then documents that lost too much of their text.

A line fails if it looks like navigation (separators between its words, or a stub of a few words without
a final mark), breaks the rules of punctuation (symbols among its characters, words that end in rows of
marks), or is boilerplate (a stock phrase, or equal to an earlier line of the document). Lines without
a word neither fail nor count. Before that, a document fails as a whole if it has too few words or if
too many of them lie in windows of words that occur again. One pass, without a shuffle; words, lines
and windows are compared exactly.

Defined results: a null text has no words and no lines; equal texts have equal results, each row its own;
texts of any length are taken whole, one row at a time beyond 4 MB; a share just at its bound passes;
an empty table gives an empty result; other columns are kept, those with the names of the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from citypulse.llm.registry import query
from citypulse.llm.sequences import doubled, recurring, recurring_words, sequences
from citypulse.llm.storage import table
from citypulse.llm.words import SPACED, slices, text_bytes


class Rules(NamedTuple):
    """Bounds and patterns (RE2). A share is a count of the first over one of the second."""

    # What is asked of a whole document.
    least_words: int = 10
    window: int = 5
    most_repeated_percent: int = 20
    symbols: str = "#*$%&|<>"
    # Lines.
    separators: str = "[|»›·•]"
    words_a_separator: int = 4
    stub_words: int = 4
    final_mark: str = r"""[.!?…:;"”’»)\]][\x20\x09-\x0D]*$"""
    most_symbol_percent: int = 10
    row_of_marks: str = "[!?][!?]+"
    words_a_row: int = 4
    boilerplate: str = (
        r"(?i)cookie|privacy policy|terms of (use|service)|all rights reserved|javascript|lorem ipsum|click here"
        r"|read more|sign up|log ?in\b|subscribe|licensed under"
    )
    # Documents: the part of the characters that may go.
    most_lost_percent: int = 50


RULES = Rules()
RESULTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, n_lines long, n_failed_lines long, n_lost_chars long, kept boolean, cleaned string"


class Lines(NamedTuple):
    """Lines of consecutive documents, without their line feeds; ``first`` as for words."""

    lines: pa.Array
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def lines_of(data: np.ndarray, at: np.ndarray) -> Lines:
    """Every document has one line more than line feeds."""
    feed = data == 10
    feeds = np.concatenate([[0], np.cumsum(feed)])
    first = feeds[at] + np.arange(len(at))
    starts = np.sort(np.concatenate([at[:-1], np.flatnonzero(feed) + 1]))
    ends = np.concatenate([starts[1:] - 1, [0]])[: len(starts)]
    ends[first[1:] - 1] = at[1:]
    bounds = np.concatenate([starts - feeds[starts], [len(data) - feeds[-1]]]).astype(np.int64)
    text = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data[~feed]))])
    return Lines(text, starts, ends, first)


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends] - total[starts]


def repeated_words(column: pa.Array, window: int) -> np.ndarray:
    """Words of each text in windows of ``window`` words that it has twice or more."""
    words = sequences(column)
    n, size = len(words.ids), 1
    found = recurring_words(words)
    while 2 * size <= window:
        found, size = doubled(found, n, size), 2 * size
    if size < window:
        found = doubled(found, n, window - size)
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, found.at, 1)
    np.add.at(step, found.at + window, -1)
    return _sums(np.cumsum(step)[:-1] > 0, words.first[:-1], words.first[1:])


def evaluated(column: pa.Array, rules: Rules = RULES) -> list[pa.Array]:
    """The results of ``RESULTS`` for each text."""
    data, at = text_bytes(column)
    inside = SPACED[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edge = at[:-1][at[:-1] < len(data)]
    begin[edge] = inside[edge]
    point = inside & ((data & 0xC0) != 0x80)
    is_symbol = np.zeros(256, bool)
    is_symbol[[ord(c) for c in rules.symbols]] = True
    symbol = is_symbol[data]
    lines = lines_of(data, at)
    words, chars, symbols = (_sums(x, lines.starts, lines.ends) for x in (begin, point, symbol))

    def matches(pattern: str) -> np.ndarray:
        return pc.match_substring_regex(lines.lines, pattern).to_numpy(zero_copy_only=False)

    def count(pattern: str) -> np.ndarray:
        return pc.count_substring_regex(lines.lines, pattern).to_numpy()

    wordy = words > 0
    ids = pc.dictionary_encode(lines.lines).indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(lines.first))
    same = recurring(np.arange(len(ids)), doc, ids)
    again = np.zeros(len(ids), bool)
    again[same.at[1:][np.diff(same.rank) == 0]] = True
    again &= wordy
    navigation = (rules.words_a_separator * count(rules.separators) >= words) | ((words < rules.stub_words) & ~matches(rules.final_mark))
    marks = (100 * symbols > rules.most_symbol_percent * chars) | (rules.words_a_row * count(rules.row_of_marks) >= words)
    failed = wordy & (navigation | marks | again | matches(rules.boilerplate))

    def by_document(values: np.ndarray) -> np.ndarray:
        return _sums(values, lines.first[:-1], lines.first[1:])

    n_words, word_chars, lost = by_document(words), by_document(chars), by_document(np.where(failed, chars, 0))
    repeated = repeated_words(column, rules.window)
    base_failed = (n_words < rules.least_words) | (100 * repeated > rules.most_repeated_percent * n_words)
    kept = ~base_failed & (100 * lost <= rules.most_lost_percent * word_chars)
    left = np.concatenate([[0], np.cumsum(~failed)])[lines.first]
    cleaned = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(left, pa.int64()), lines.lines.filter(pa.array(~failed))), pa.scalar("\n", pa.large_string()))
    counts = (n_words, word_chars, _sums(symbol, at[:-1], at[1:]), by_document(again), repeated)
    return [
        *(pa.array(x.astype(np.int64)) for x in counts), pa.array(base_failed),
        *(pa.array(by_document(x).astype(np.int64)) for x in (wordy, failed)), pa.array(lost.astype(np.int64)), pa.array(kept), cleaned.cast(pa.string()),
    ]


def clean_lines(docs: DataFrame, rules: Rules = RULES, text: str = "text") -> DataFrame:
    """The columns of ``docs`` without its text, the counts and verdicts of ``RESULTS``, and the text without its failed lines."""
    names = [part.split()[0] for part in RESULTS.split(", ")]
    others = [c for c in docs.columns if c not in (text, *names)]
    plain = docs.select(docs[text].alias("cleaned"), *others)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields[1:]] + [RESULTS])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column(0)):
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *evaluated(part.column(0), rules)], [*others, *names])

    return plain.mapInArrow(clean, schema)


_WORD = r"[^\x20\x09-\x0D]+"


def _sql(rules: Rules) -> str:
    quoted = {name: "'" + getattr(rules, name).replace("'", "''") + "'" for name in ("separators", "final_mark", "row_of_marks", "boilerplate")}
    symbols = f"'[^{rules.symbols}]+'"
    return rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS id, coalesce(text, '') AS text FROM documents),
w AS (SELECT id, doc_id, regexp_extract_all(text, '{_WORD}') AS words, text FROM d),
p AS (SELECT id, unnest(range(1, len(words) - {rules.window - 2})) AS i, words FROM w WHERE len(words) >= {rules.window}),
g AS (SELECT id, i, array_to_string(words[i:i + {rules.window - 1}], ' ') AS gram FROM p),
r AS (SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, gram) AS n FROM g) x WHERE n > 1),
c AS (SELECT id, count(DISTINCT k) AS n_repeat_words FROM (SELECT id, unnest(range(i, i + {rules.window})) AS k FROM r) x GROUP BY id),
l AS (SELECT id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM d),
m AS (SELECT id, line, len(regexp_extract_all(line, '{_WORD}')) AS n, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
  len(regexp_extract_all(line, {quoted["separators"]})) AS separators, length(regexp_replace(line, {symbols}, '', 'g')) AS symbols,
  len(regexp_extract_all(line, {quoted["row_of_marks"]})) AS marks, regexp_matches(line, {quoted["final_mark"]}) AS ended,
  regexp_matches(line, {quoted["boilerplate"]}) AS stock, row_number() OVER (PARTITION BY id, line ORDER BY i) > 1 AS again FROM l),
f AS (SELECT *, {rules.words_a_separator} * separators >= n OR n < {rules.stub_words} AND NOT ended
  OR 100 * symbols > {rules.most_symbol_percent} * chars OR {rules.words_a_row} * marks >= n OR again OR stock AS failed FROM m WHERE n > 0),
s AS (SELECT id, count(*) AS n_lines, count(*) FILTER (failed) AS n_failed_lines, coalesce(sum(chars) FILTER (failed), 0)::bigint AS n_lost_chars,
  sum(chars)::bigint AS word_chars, count(*) FILTER (again) AS n_dup_lines FROM f GROUP BY id),
t AS (SELECT doc_id, len(words) AS n_words, coalesce(word_chars, 0) AS word_chars, length(regexp_replace(text, {symbols}, '', 'g')) AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
  coalesce(n_failed_lines, 0) AS n_failed_lines, coalesce(n_lost_chars, 0) AS n_lost_chars FROM w LEFT JOIN c USING (id) LEFT JOIN s USING (id)),
b AS (SELECT *, n_words < {rules.least_words} OR 100 * n_repeat_words > {rules.most_repeated_percent} * n_words AS base_failed FROM t)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * n_lost_chars <= {rules.most_lost_percent} * word_chars AS kept, n_lines, n_failed_lines, n_lost_chars FROM b"""


@query("op12_quality_rules", _sql(RULES))
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    found = clean_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_failed_lines", "n_lost_chars")
