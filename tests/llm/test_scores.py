"""The mixture of op4 recomputed plainly: counts from dictionaries, weights by a loop of expectation-maximisation."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from citypulse.llm import scoring
from tests.llm import brute

FOLDS = scoring.Folds(7, 2, 3)


def rounded(count: int) -> float:
    """A count as the cells have it: a whole number of steps of a power of two."""
    return 2 ** (round(math.log2(count) * scoring.STEPS) / scoring.STEPS) if count else 0.0


def plain_scores(rows: list[tuple[int, int, str | None]]) -> list[float]:
    """``rows``: key, fold and text."""
    docs = [(fold, [*brute.spaced(brute.lowered(text)), None]) for _, fold, text in rows]
    single, pair = Counter(), Counter()
    less_single, less_pair = Counter(), Counter()
    for fold, w in docs:
        for u, x in zip([None, *w], w, strict=False):
            if fold != FOLDS.unseen:
                single[x] += 1
                pair[u, x] += 1
                if fold != FOLDS.deleted:
                    less_single[x] += 1
                    less_pair[u, x] += 1
    n, v = sum(single.values()), len(single)
    held = defaultdict(list)
    for fold, w in docs:
        if fold == FOLDS.deleted:
            for u, x in zip([None, *w], w, strict=False):
                c = rounded(less_single[u])
                parts = (min(rounded(less_pair[u, x]) / c, 1.0) if c else 0.0, rounded(less_single[x]) / max(n, 1), 1 / (v + 1))
                for b in (-1, less_single[u].bit_length()):
                    held[b].append(parts)
    weights = {}
    for b, parts in held.items():
        m = [1 / 3] * 3
        for _ in range(scoring.ROUNDS):
            total = [0.0] * 3
            for p in parts:
                whole = sum(a * q for a, q in zip(m, p, strict=True))
                total = [t + a * q / whole for t, a, q in zip(total, m, p, strict=True)]
            m = [t / len(parts) for t in total]
        m = [max(a, 1e-6) for a in m]
        weights[b] = [a / sum(m) for a in m]
    out = []
    for _, w in docs:
        score = 0.0
        for u, x in zip([None, *w], w, strict=False):
            a = weights.get(single[u].bit_length(), weights.get(-1, [1 / 3] * 3))
            score += math.log10((a[0] * pair[u, x] / single[u] if single[u] else 0) + a[1] * single[x] / max(n, 1) + a[2] / (v + 1))
        out.append(score)
    return out


def found_scores(spark, rows):
    docs = spark.createDataFrame([(k, fold, text) for k, fold, text in rows], "doc_id long, fold int, text string")
    return {r.doc_id: r.score for r in scoring.scores(docs, F.col("fold"), FOLDS).collect()}


@pytest.mark.parametrize("chunk", [scoring.CHUNK_BYTES, 3000])
def test_scores_are_the_plain_mixture(spark, monkeypatch, chunk):
    monkeypatch.setattr(scoring, "CHUNK_BYTES", chunk)
    rng = random.Random(9)
    lexicon = [f"w{k}" for k in range(120)]
    weight = [1 / (k + 1) for k in range(120)]
    rows = [(k, rng.randrange(7), " ".join(rng.choices(lexicon, weight, k=rng.choice([0, 1, 7, 40, 200])))) for k in range(120)]
    rows += [(900, 0, None), (901, 2, "never seen before"), (902, 3, "word " * 4000)]
    found = found_scores(spark, rows)
    for (k, _, _), want in zip(rows, plain_scores(rows), strict=True):
        assert found[k] == pytest.approx(want, rel=1e-9)


def test_one_token_corpora(spark):
    for rows in ([(1, 0, "")], [(1, 3, None)], [(1, 2, "only held out")], [(1, 0, "a"), (2, 3, "a")]):
        found = found_scores(spark, rows)
        assert [found[k] for k, _, _ in rows] == pytest.approx(plain_scores(rows))


def test_buckets_are_those_of_the_count_itself():
    count = np.arange(5000)
    assert scoring.bucket(count).tolist() == [int(c).bit_length() for c in count]
    assert ((scoring.placed(count) >> scoring.STEP_BITS) == scoring.bucket(count)).all()
    assert (scoring.placed(np.array([2**62])) >> scoring.STEP_BITS == 63).all()


def test_differences_come_back():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 4000):
        x = np.sort(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert (scoring._ascending(scoring._differences(x), n) == x).all()
    x = np.sort(rng.integers(0, 2**64, 100_000, dtype=np.uint64))
    assert len(scoring._differences(x)) < 0.85 * x.nbytes


def test_query_keeps_its_contract(spark, tmp_path):
    """Every column but the model's score by dictionaries, over repeated, empty and odd rows, some without an id."""
    rng = random.Random(17)
    lexicon = [f"W{k}" if k % 3 else f"é{k}\x1f" for k in range(60)]
    rows = [(k - 40, " ".join(rng.choices(lexicon, k=rng.choice([0, 1, 9, 60])))) for k in range(150)]
    rows += list(enumerate(brute.ODD_TEXTS, 1000)) + rows[:20] + [(None, "W1 unheard"), (None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")

    def held(k):
        return k is not None and zlib.crc32(str(k).encode()) % 7 == 2

    tokens = [[*brute.spaced(brute.lowered(text)), None] for _, text in rows]
    seen = Counter(x for (k, _), w in zip(rows, tokens, strict=True) if not held(k) for x in w)
    n, v = sum(seen.values()), len(seen)
    want = [(str(k), held(k), len(w), sum(x in seen for x in w), n, round(sum(math.log10((seen[x] + 1) / (n + 1 * (v + 1))) for x in w), 6)) for (k, _), w in zip(rows, tokens, strict=True)]
    found = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scoring.lm_scoring(spark, str(tmp_path)).collect()]
    assert sorted(found) == sorted(want)
