"""What the index of the join keeps of a set: enough to find each similar one, and little that unrelated ones have, too."""

from __future__ import annotations

import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from citypulse.llm import jaccard
from citypulse.llm.words import U64
from tests.llm.test_jaccard_memory import Batches, rows_of


def met(texts, kinds, share, size):
    """Pairs of rows of the index that meet in a signature and of which one looks for others."""
    looks, all_ = Counter(), Counter()
    for part in jaccard._index(Batches(), size, kinds, share)(iter([rows_of("index", texts)])):
        for sig, flags in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), strict=True):
            all_[sig] += 1
            looks[sig] += flags & 1
    return sum(n * (n - 1) // 2 - (n - looks[sig]) * (n - looks[sig] - 1) // 2 for sig, n in all_.items())


@pytest.mark.parametrize("share, size", [(Fraction(4, 5), 5), (Fraction(9, 10), 3)])
def test_unrelated_sets_do_not_meet(share, size):
    """Segments without elements are alike for all sets; left in, they make pairs with the square of the number of sets."""
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(rng.randint(95, 260))) for _ in range(1500)]
    kinds = jaccard.bands({n: 10 for n in range(1, 300)}, share)
    assert not any(b.deletions for b in kinds)
    assert met(texts, kinds, share, size) <= 3000


def sets_of(*values):
    return jaccard.Sets(np.concatenate([np.sort(np.array(v, U64)) for v in values]), np.cumsum([0, *map(len, values)]))


def signatures_of(s, kinds, share):
    """Signature -> flags, of each set."""
    out = [{} for _ in range(len(s.first) - 1)]
    for k, rows in jaccard.placements(s, kinds, share):
        for row, sig, flags in zip(*(x.tolist() for x in jaccard.signatures(s, k, kinds[k], rows, share)), strict=True):
            out[rows[row]].setdefault(sig, 0)
            out[rows[row]][sig] |= flags
    return out


@pytest.mark.parametrize("share", [Fraction(4, 5), Fraction(9, 10)])
@pytest.mark.parametrize("deletions", [False, True])
def test_similar_sets_meet(share, deletions):
    """As many elements apart as a similar pair can have, each in a segment of its own, the fullest segments first."""
    rng = random.Random(7)
    sizes = {n: 10**9 if deletions else 10 for n in range(1, 700)}
    kinds = jaccard.bands(sizes, share, 0.5 if deletions else jaccard.UNRELATED)
    assert any(b.deletions for b in kinds) == deletions
    checked = 0
    for n in [*range(1, 60), *(rng.randint(60, 300) for _ in range(140))]:
        # The smaller set has n elements and both together have `union`, of which at least `share` are in both.
        for removed in {0, rng.randint(0, n), n}:
            least = -(-share.numerator * n // share.denominator)
            common = max(least, n - removed)
            larger = common * share.denominator // share.numerator - n + common
            if larger < n or larger >= 700:
                continue
            left = [rng.getrandbits(64) for _ in range(n)]
            band = next(b for b in kinds if b.low <= n <= b.high)
            place = Counter(((x >> 32) * band.segments) >> 32 for x in left)
            by_segment = sorted(left, key=lambda x: (-place[((x >> 32) * band.segments) >> 32], x))
            firsts = list({((x >> 32) * band.segments) >> 32: x for x in reversed(by_segment)}.values())
            gone = [*firsts, *(x for x in by_segment if x not in firsts)][: n - common]
            right = [*(x for x in left if x not in set(gone)), *(rng.getrandbits(64) for _ in range(larger - common))]
            assert common * share.denominator >= (n + larger - common) * share.numerator
            if len({*left} ^ {*right}) == 0:
                continue
            a, b = signatures_of(sets_of(left, right), kinds, share)
            assert any((a[s] | b[s]) & 3 == 3 for s in a.keys() & b.keys()), (n, larger, common)
            checked += 1
    assert checked > 100
