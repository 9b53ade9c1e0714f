"""What the join holds while it looks at a batch of texts."""

from __future__ import annotations

import random
import tracemalloc
from fractions import Fraction

import pyarrow as pa
import pytest

from citypulse.llm import jaccard
from tests.llm import brute

SHARE, SIZE = Fraction(4, 5), 5
KINDS = jaccard.bands({600: 1000}, SHARE)


class Batches:
    """Takes the function that a frame would apply to its batches."""

    def mapInArrow(self, function, schema):  # noqa: N802
        return function


def made(step, batch):
    own = {"digests": lambda: jaccard._digests(Batches(), SIZE), "index": lambda: jaccard._index(Batches(), SIZE, KINDS, SHARE), "sketches": lambda: jaccard._sketched(Batches(), SIZE, KINDS, SHARE)}
    return own[step]()(iter([batch]))


def rows_of(step, texts):
    ids = pa.array(range(len(texts)), pa.int64())
    columns = [ids, ids, ids, pa.array(texts)] if step == "digests" else [ids, pa.array(texts)]
    return pa.RecordBatch.from_arrays(columns, [f"c{k}" for k in range(len(columns))])


@pytest.mark.parametrize("step", ["digests", "index", "sketches"])
def test_memory_of_a_large_batch(step):
    """Eight megabytes of text in one batch take 48 MB at most (more than 100 MB if four are looked at together)."""
    rng = random.Random(1)
    lexicon = [f"word{k}" for k in range(5000)]
    batch = rows_of(step, [" ".join(rng.choices(lexicon, k=600)) for _ in range(1600)])
    assert batch.nbytes > 8_000_000
    tracemalloc.start()
    try:
        n = sum(part.num_rows for part in made(step, batch))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n >= 1600 and most < 48 << 20


def test_copies_in_a_batch_are_indexed_once(monkeypatch):
    """Also those that are looked at in different parts of it."""
    monkeypatch.setattr(jaccard, "TEXT_BYTES", 5000)
    rng = random.Random(2)
    one, two = (" ".join(f"w{rng.randrange(5000)}" for _ in range(600)) for _ in range(2))
    once, many = (sorted(r for part in made("index", rows_of("index", t)) for r in part.to_pydict()["sig"]) for t in ([one, two], [one, one, two, None, one, "", two, one]))
    assert once == many


def test_links_between_parts_of_a_batch(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TEXT_BYTES", 300)
    rng = random.Random(3)
    rows = []
    for d in range(40):
        w = [f"w{rng.randrange(3000)}" for _ in range(60)]
        rows += [(3 * d, " ".join(w)), (3 * d + 1, " ".join([*w, "end"])), (3 * d + 2, " ".join(w))]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar(docs, SHARE, SIZE).collect()}
    assert got == brute.similar(rows, SIZE, 80)
