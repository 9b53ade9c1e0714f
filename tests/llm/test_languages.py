"""Cross parsing against a plain greedy parse, and labels of very different size."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from citypulse.llm import language

ENGLISH = ["the", "river", "town", "was", "quiet", "when", "rain", "came", "over", "hills", "people", "walked", "home", "with", "their", "dogs", "under", "old", "trees", "near"]
WELSH = ["mae", "yr", "afon", "dref", "yn", "dawel", "pan", "ddaeth", "glaw", "dros", "bryniau", "cerddodd", "pobl", "adref", "gyda", "eu", "cwn", "dan", "hen", "goed"]


def prose(words, count, seed):
    rng = random.Random(seed)
    return " ".join(rng.choices(words, k=count))


def normal(text: str) -> str:
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) if text else ""


def plain_phrases(text: str, sample: str) -> int:
    """Greedy longest phrases of the text that occur in the sample; a letter that does not occur is one."""
    at = count = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample and text[at] in sample:
            size += 1
        at, count = at + size, count + 1
    return count


@pytest.mark.parametrize("lane", [1, 3, 16, 2048])
@pytest.mark.parametrize("dense", [0, 1 << 27])
def test_cross_parse_is_the_plain_one(monkeypatch, lane, dense):
    monkeypatch.setattr(language, "LANE", lane)
    monkeypatch.setattr(language, "DENSE_BYTES", dense)
    rng = random.Random(lane)
    texts = {"a": prose(ENGLISH, 60, 1), "b": prose(WELSH, 50, 2), "c": "ok", "d": "x"}
    model = language.Model(texts)
    rows = ["", "a", "zz", "ok ok", "été ñ ok", *(normal(prose(rng.choice([ENGLISH, WELSH, ["ok", "x", "é"]]), rng.randint(1, 60), i)) for i in range(40))]
    rows += ["".join(rng.choices("abcdeñ ", k=rng.randint(1, 90))).strip() for _ in range(40)]
    rows = [normal(r) for r in rows]
    points, first = language.text_points(pa.array(rows))
    symbols, first = language.squeezed(model.alphabet.symbols(points), first)
    assert np.diff(first).tolist() == [len(r) for r in rows]
    found = model.entropies(symbols, first)
    cost = math.log2(max(len(normal(t)) for t in texts.values()))
    for row, bits in zip(rows, found, strict=True):
        for k, name in enumerate(model.names):
            assert bits[k] == pytest.approx(plain_phrases(row, normal(texts[name])) * cost / max(len(row), 1)), (row, name)


@pytest.mark.parametrize("size", [1, 10, 1000, 60_000])
def test_a_small_label_takes_no_other_texts(spark, size):
    texts = {"en": prose(ENGLISH, 12_000, 3)[:60_000], "cy": (prose(WELSH, 12_000, 4) + " " * size)[:size]}
    rows = [(k, prose(ENGLISH, 80, 100 + k)) for k in range(30)]
    found = language.identify(spark.createDataFrame(rows, "doc_id long, text string"), texts).collect()
    assert {r.lang_pred for r in found} == {"en"}
    if size >= 1000:
        rows = [(k, prose(WELSH, 80, 200 + k)) for k in range(30)]
        assert {r.lang_pred for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string"), texts).collect()} == {"cy"}


def test_stray_labels(spark):
    """The two labels that used to take over: a short one, and one without a letter."""
    rows = [(k, prose(ENGLISH, 150, k), "en") for k in range(40)] + [(100, "ok", "xx"), (101, "12 34", "yy"), (None, "null key", "zz"), (None, "null key", "zz")]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts = language.sample(labelled)
    assert set(texts) == {"en", "xx", "yy", "zz"} and texts["zz"].strip() == "null key"
    found = {r.doc_id: r for r in language.identify(labelled.drop("lang").filter("doc_id is not null"), texts).collect()}
    assert all(found[k].lang_pred == "en" and found[k].score > 0.9 for k in range(40)) and found[101].lang_pred == "und"


def test_ties_and_repeated_rows(spark):
    texts = {"b": "same words here", "a": "same words here"}
    docs = spark.createDataFrame([(1, "words here"), (1, "words here"), (2, None), (3, "?!")], "doc_id long, text string")
    found = sorted((r.doc_id, r.lang_pred, r.score) for r in language.identify(docs, texts).collect())
    assert found == [(1, "a", 0.5), (1, "a", 0.5), (2, "und", 0.0), (3, "und", 0.0)]


def test_rows_without_a_key_are_thinned_like_others(spark):
    rows = spark.range(6000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    assert 300 <= language.sample(rows)["en"].count("word") <= language.SAMPLE_DOCS
