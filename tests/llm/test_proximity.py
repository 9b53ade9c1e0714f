"""Near matches against a plain scan of every start."""

from __future__ import annotations

import math
import random

import pytest

from citypulse.llm import contamination
from tests.llm import brute


def plain_near(rows, items, slop, share):
    """Items of which a window has enough of its words near their places, for each row."""
    wins = []
    for item, text in items:
        w = brute.spaced(text)
        wins += [(item, w[k : k + 13]) for k in range(max(len(w) - 12, 1 if w else 0))]
    out = {}
    for d, text in rows:
        w, found = brute.spaced(text), set()
        for item, win in wins:
            need = math.ceil(len(win) * share - 1e-9)
            for start in range(len(w) - len(win) + 1):
                hits = sum(x in w[max(start + j - slop, 0) : start + j + slop + 1] for j, x in enumerate(win))
                # At least one of the words that cannot all be missing must be there to start from.
                if hits >= max(need, 1):
                    found.add(item)
        out[d] = found
    return out


@pytest.mark.parametrize("slop, share", [(0, 1.0), (1, 0.8), (2, 0.8), (3, 0.6)])
def test_near_items(spark, monkeypatch, slop, share):
    monkeypatch.setattr(contamination, "NEAR_ROWS", 7)
    monkeypatch.setattr(contamination, "NEAR_SHARE", share)
    rng = random.Random(slop)
    lexicon = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(rng.choices(lexicon, k=n))) for k, n in enumerate([30, 13, 14, 5, 1, 20])]
    rows = [(900, None), (901, ""), (902, "w1")]
    for d in range(60):
        w = rng.choices(lexicon, k=rng.choice([10, 40]))
        own = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(own))
            own = rng.choice([own[:k] + own[k + 1 :], own[:k] + ["new"] + own[k:], own[:k] + ["other"] + own[k + 1 :]]) or ["x"]
        at = rng.randrange(len(w))
        rows.append((d, " ".join(w[:at] + own + w[at:])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    wins = contamination.windows(bench)
    index = contamination.build_index(docs, contamination.vocabulary(wins))
    want = plain_near(rows, items, slop, share)
    # A text of 4 MB is one shard here, so a window never runs from one document to the next.
    found = {r.doc_id: set(r.near_items) for r in contamination.search(index, wins, slop, share).collect()}
    assert found == want
    assert sum(map(len, want.values())) > 20


def test_near_columns_of_the_query(spark, tmp_path):
    text = " ".join(f"b{k}" for k in range(20))
    spark.createDataFrame([(1, text)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    changed = text.replace("b3 ", "").replace("b15", "other")
    spark.createDataFrame([(1, text), (2, changed), (3, "far away"), (None, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in contamination.benchmark_contamination(spark, str(tmp_path)).collect()}
    assert [(found[k].n_items, found[k].n_near) for k in (1, 2, 3, None)] == [(1, 1), (0, 1), (0, 0), (0, 0)]
    assert found[1].near_sha256 == found[2].near_sha256 == brute.sha("1") and found[3].near_sha256 == brute.sha("")
