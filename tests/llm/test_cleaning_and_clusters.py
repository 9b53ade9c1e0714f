"""Periodic runs, line-first cleaning and centroid clustering against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from citypulse.llm import centroids, periods, quality
from citypulse.llm.sequences import sequences
from tests.llm import brute


def plain_runs(w: list[str], least: int = 6, power: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, lag by lag."""
    out = set()
    for q in range(1, len(w)):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            run = w[i : i + length]
            if length >= max(least, power * q) and not any(run[d:] == run[:-d] for d in range(1, q)):
                out.add((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_texts(count: int, seed: int) -> list[str | None]:
    rng = random.Random(seed)
    out: list[str | None] = [*brute.ODD_TEXTS, "a a a a a", "a a a a a a", "a b a b a b a b", "a b a b a b a", "x a b c a b c a b c a b c a y", "á á á á á á b b b b b b"]
    while len(out) < count:
        w = rng.choices("abcd" if rng.random() < 0.5 else "ab", k=rng.choice([0, 3, 20, 90]))
        base = rng.choices("abc", k=rng.randint(1, 9))
        w += (base * 9)[: rng.randint(1, 9 * len(base))] + rng.choices("abc", k=rng.randint(0, 5))
        out.append((" " if rng.random() < 0.5 else " \n").join(w))
    return out


@pytest.mark.parametrize("least, power", [(6, 4), (1, 3), (10, 3), (20, 5)])
def test_runs_match_every_lag(least, power):
    texts = periodic_texts(250, least)
    words = sequences(pa.array(texts))
    found = periods.runs_of(words, least, power)
    for d, text in enumerate(texts):
        w = brute.spaced(text)
        if len(w) < 1000:
            assert [tuple(r[1:]) for r in found.tolist() if r[0] == d] == plain_runs(w, least, power)
    assert words.joined(np.ones(len(words.ids), bool)).to_pylist() == [" ".join(brute.spaced(t)) for t in texts]
    with pytest.raises(ValueError):
        periods.runs_of(words, least, 2)


def test_long_period_in_a_long_text():
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(7000)]
    w = ["start", *base * 5, *base[:99], "end"]
    assert periods.runs_of(sequences(pa.array([" ".join(w)]))).tolist() == [[0, 1, 35099, 7000]]


def expected_run_row(doc_id, text):
    w = brute.spaced(text)
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(found), *best, milli, brute.sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), brute.sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_periodic_runs_query(spark, tmp_path, docs_schema):
    rows = [(d, t) for d, t in enumerate(periodic_texts(160, 8)) if t is None or len(brute.spaced(t)) < 1000] + [(None, "a a a a a a"), (3, "again again"), (3, "again again"), (-7, "b b b b b b b")]
    spark.createDataFrame([(d, t, "xx", "s", 0) for d, t in rows], docs_schema).write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in periods.periodic_runs_of_documents(spark, str(tmp_path)).collect()]
    want = [expected_run_row(d, t) for d, t in rows]
    assert Counter(found) == Counter(want)
    assert any(zlib.crc32(str(d).encode()) % 10 == 0 and t for d, t in rows)


def test_periodic_runs_frames(spark):
    rows = [(1, "x x x x x x y", "keep", 5), (2, None, None, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, note string, runs int")
    found = periods.periodic_runs(docs).orderBy("doc_id").collect()
    assert [(r.doc_id, r.note, r.n_words, r.collapsed, [tuple(x) for x in r.runs]) for r in found] == [(1, "keep", 7, "x y", [(0, 6, 1)]), (2, None, 0, "", [])]
    assert periods.periodic_runs(docs.limit(0)).count() == 0


LINES = [
    "Home | About | Contact us", "Menu", "Products », prices » and more »", "THIS!! IS!! GREAT!! NOW!!", "to%%% the&&& end### of*** it$$$",
    "We use cookies on this page, you know.", "All Rights Reserved.", "A quite usual line of text with some words in it.", "A quite usual line of text with some words in it.",
    "Another one, that goes on without a final mark and is long", "   ", "", "ends well here, with a return.\r", "yes.", "no", "wait!! what is this about, and why now",
]


def plain_quality(text: str | None) -> tuple:
    text = text or ""
    w = brute.spaced(text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    repeated = {k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    seen, dups, lines, failed, lost, left = set(), 0, 0, 0, 0, []
    for line in text.split("\n"):
        v = brute.spaced(line)
        if not v:
            left.append(line)
            continue
        again, chars = line in seen, sum(map(len, v))
        seen.add(line)
        bad = (
            4 * len(re.findall("[|»›·•]", line)) >= len(v)
            or (len(v) < 4 and not re.search(r"""[.!?…:;"”’»)\]][\x20\x09-\x0D]*\Z""", line))
            or 100 * len(re.findall(r"[#*$%&|<>]", line)) > 10 * chars
            or 4 * len(re.findall("[!?][!?]+", line)) >= len(v)
            or again
            or re.search(quality.RULES.boilerplate, line) is not None
        )
        dups, lines, failed, lost = dups + again, lines + 1, failed + bad, lost + bad * chars
        if not bad:
            left.append(line)
    n, chars = len(w), sum(map(len, w))
    base = n < 10 or 100 * len(repeated) > 20 * n
    return (n, chars, len(re.findall(r"[#*$%&|<>]", text)), dups, len(repeated), base, lines, failed, lost, not base and 2 * lost <= chars, "\n".join(left))


def test_line_rules(spark):
    rng = random.Random(6)
    texts = [*brute.ODD_TEXTS, *LINES, "\n\n", "a\n", "\na b c d.", *("\n".join(rng.choices(LINES, k=rng.randint(1, 9))) for _ in range(150))]
    docs = spark.createDataFrame([(d, t, "clash") for d, t in enumerate([*texts, texts[-1]])] + [(None, texts[-1], "clash")], "doc_id long, text string, kept string")
    found = quality.clean_lines(docs).collect()
    names = [part.split()[0] for part in quality.RESULTS.split(", ")]
    assert Counter((r.doc_id, *(r[c] for c in names)) for r in found) == Counter(
        [(d, *plain_quality(t)) for d, t in enumerate([*texts, texts[-1]])] + [(None, *plain_quality(texts[-1]))]
    )
    assert quality.clean_lines(docs.limit(0)).count() == 0


def test_line_rules_keep_clean_text(spark):
    rng = random.Random(2)
    clean = "\n".join(" ".join(f"word{rng.randrange(900)}" for _ in range(14)) + "." for _ in range(12))
    menu = "\n".join(f"Home | Page {k} | Next" for k in range(30))
    shout = " ".join(f"BUY{k}!!" for k in range(60))
    rows = [(1, clean), (2, menu), (3, shout), (4, "Home | News | Contact\n" + clean + "\nAll rights reserved."), (5, "word " * 40)]
    found = {r.doc_id: r for r in quality.clean_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: r.kept for d, r in found.items()} == {1: True, 2: False, 3: False, 4: True, 5: False}
    assert found[4].cleaned == clean and found[1].cleaned == clean


@pytest.mark.parametrize("axes, bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(axes, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
    place = centroids.hilbert(grid, bits)
    assert sorted(place.tolist()) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def plain_clusters(rows, k=16, rounds=3, dim=64):
    kept = [(key, [math.floor(64 * x) for x in v]) for key, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"1:{key}".encode()).hexdigest(), v) for key, v in kept if key is not None)
    c = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, w, strict=True)), i) for i, w in enumerate(c))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        groups = [[v for (_, v), o in zip(kept, own, strict=True) if o == i] for i in range(len(c))]
        c = [[sum(x) // len(g) for x in zip(*g, strict=True)] if g else c[i] for i, g in enumerate(groups)]
    return Counter((key, i, d) for key, v in kept for d, i in [nearest(v)]), c


def vectors(seed: int, count: int, spread: float, dim: int = 64, groups: int = 20):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dim))
    x = centres[rng.integers(groups, size=count)] + spread * rng.standard_normal((count, dim))
    return [(int(i), [float(np.float32(y)) for y in row]) for i, row in enumerate(x)]


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_clusters(spark, monkeypatch, spread):
    monkeypatch.setattr(centroids, "BLOCK", 16)
    rows = vectors(3, 400, spread)
    rows += [(500, rows[0][1]), (501, rows[0][1]), (3, rows[3][1]), (None, rows[5][1]), (600, None), (601, []), (602, [1.0] * 63), (603, [None] + [0.5] * 63), (604, [math.nan] * 64), (605, [math.inf] * 64), (606, [0.0] * 64)]
    frame = spark.createDataFrame([(key, v, 1) for key, v in rows], SCHEMA).withColumn("cluster", F.lit("clash"))
    found, c = centroids.clusters(frame)
    want, last = plain_clusters(rows)
    assert Counter(tuple(r) for r in found.collect()) == want
    assert c.tolist() == last


def test_clusters_of_few_and_large_vectors(spark):
    rows = vectors(4, 5, 1.0)
    found, c = centroids.clusters(spark.createDataFrame([(key, v, 1) for key, v in rows], SCHEMA))
    want, last = plain_clusters(rows)
    assert Counter(tuple(r) for r in found.collect()) == want and c.tolist() == last
    wide = [(key, [1e6 * x if abs(x) < 2 else x for x in v]) for key, v in vectors(5, 40, 1.0)]
    wide = [(key, [float(np.float32(x)) for x in v]) for key, v in wide]
    found, c = centroids.clusters(spark.createDataFrame([(key, v, 1) for key, v in [*wide, (99, [1e30] * 64)]], SCHEMA))
    want, last = plain_clusters(wide)
    assert Counter(tuple(r) for r in found.collect()) == want and c.tolist() == last
    found, c = centroids.clusters(spark.createDataFrame([(None, rows[0][1], 1)], SCHEMA))
    assert found.columns == ["vec_id", "cluster", "distance"] and found.count() == 0
    found, c = centroids.clusters(spark.createDataFrame([], SCHEMA))
    assert found.count() == 0 and len(c) == 0


def test_boxes_exclude_what_cannot_be_nearest():
    x = np.floor(64 * np.array([v for _, v in vectors(9, 4000, 0.05, groups=16)])).astype(np.int64)
    c = x[:16]
    frame = centroids.frame_of(c)
    order = np.argsort(frame.place(x), kind="stable")
    nearest = centroids.distances(x, c).argmin(axis=1)
    left = []
    for i in range(0, len(x), 64):
        y, own = frame.rotated(x[order[i : i + 64]]), nearest[order[i : i + 64]]
        near = centroids.candidates(y.min(axis=0)[None], y.max(axis=0)[None], c, frame)[0]
        assert near[own].all()
        left.append(near.sum())
    assert np.mean(left) < 8


def test_clustering_query_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert centroids.centroid_clustering(spark, str(tmp_path)).count() == 0
