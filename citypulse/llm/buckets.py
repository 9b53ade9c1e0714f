"""Links between the members of buckets, without expanding a bucket into its pairs.

Members are rows (sig, class, flags): flag bit 1 for a member that looks for others in this bucket, bit 2
for one that stands there with its whole content; the bits above are its band. A pair is a candidate
if one of the two looks, one is whole, and a test on what is known of both does not exclude it.

At first the candidates of a few of the buckets (one in ``PARTS``, then more) are taken as graphs, and only the
edges of spanning forests are verified: members that are alike share many buckets, so few of these link
nearly all, and each bucket more would verify a forest of the same group again. After each pass buckets
whose members are one component by then are left out. At the end all candidates of all buckets between
members that are still in different components are verified. So every pair that shares a bucket has
been verified, excluded, or is connected already. A bucket of more than ``BLOCK`` members is dealt out in
blocks: a few times at random to link nearly all, and at the end the members outside its largest component meet
every block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.llm.components import components
from citypulse.llm.storage import stored

#: Members of a block; buckets up to ``SMALL`` give all their candidates at once; one in so many buckets is used in the first passes.
BLOCK, SMALL, PARTS = 1500, 4, (32, 4)
PAIR = "a long, b long"
MEMBERS = "sig long, h1 long, flags int"

#: Test of pairs of rows (i, j) of a batch: True where the pair is not excluded. Made from the batch.
Test = Callable[[np.ndarray, np.ndarray], np.ndarray]


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Batches sorted by their first columns, cut anew so that no group of equal keys is in two of them."""
    rest: pa.RecordBatch | None = None
    for batch in batches:
        if rest is not None:
            batch = pa.concat_batches([rest, batch])
        if not batch.num_rows:
            continue
        new = _new(batch, keys)
        cut = int(np.flatnonzero(new)[-1])
        rest = batch.slice(cut)
        if cut:
            yield batch.slice(0, cut)
    if rest is not None and rest.num_rows:
        yield rest


def _new(batch: pa.RecordBatch, keys: int) -> np.ndarray:
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for k in range(keys):
        x = batch.column(k).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return new


def shared(index: DataFrame) -> DataFrame:
    """Of signature rows (sig, h1, flags), those whose signature comes with more than one class and is looked for.

    Rows are sorted by signature and looked at as they pass, so that one exchange of the rows is enough and
    no group is held. (A combining aggregate and a join would spread a hot signature over tasks, but move
    and keep three times as many bytes.)
    """
    return index.repartition("sig").sortWithinPartitions("sig").mapInArrow(_multiple, MEMBERS)


def _multiple(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in groups(batches, 1):
        first = np.flatnonzero(_new(batch, 1))
        size = np.diff(np.r_[first, batch.num_rows])
        h1, flags = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        mixed = np.maximum.reduceat(h1, first) != np.minimum.reduceat(h1, first)
        mixed &= np.bitwise_or.reduceat(flags, first) & 3 == 3
        yield batch.filter(pa.array(np.repeat(mixed, size)))


def _all_pairs(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def _edges(first: int, n: int, component: np.ndarray, test: Test) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the candidates of one bucket, components being connected already; breadth first."""
    left = np.arange(first, first + n)
    a, b = [], []
    while len(left):
        queue = left[component[left] == component[left[0]]].tolist()
        left = left[component[left] != component[left[0]]]
        while queue and len(left):
            x = queue.pop()
            hit = left[test(np.full(len(left), x), left)]
            if len(hit):
                reached, one = np.unique(component[hit], return_index=True)
                a += [x] * len(one)
                b += hit[one].tolist()
                inside = np.isin(component[left], reached)
                queue += left[inside].tolist()
                left = left[~inside]
    return np.array(a, np.int64), np.array(b, np.int64)


def _finder(prepare: Callable[[pa.RecordBatch], Test], only_forest: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function on rows sorted by (sig, block): sig, block, class, component, flags, and what the test needs."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, 2):
            ids, component, flags = (batch.column(k).to_numpy() for k in (2, 3, 4))
            able = prepare(batch)

            def test(i: np.ndarray, j: np.ndarray, flags: np.ndarray = flags, component: np.ndarray = component, able: Test = able) -> np.ndarray:
                out = (((flags[i] | flags[j]) & 3) == 3) & (component[i] != component[j])
                at = np.flatnonzero(out)
                out[at] = able(i[at], j[at])
                return out

            begin = np.flatnonzero(_new(batch, 2))
            size = np.diff(np.r_[begin, batch.num_rows])
            left, right = [], []
            for n in range(2, SMALL + 1):
                own = begin[size == n][:, None]
                i, j = (x.ravel() for x in (own + k for k in _all_pairs(n)))
                keep = test(i, j)
                left.append(i[keep])
                right.append(j[keep])
            for at, n in zip(begin[size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True):
                if only_forest:
                    i, j = _edges(at, n, component, test)
                    left.append(i)
                    right.append(j)
                    continue
                # Of two members in different components one is outside the largest.
                own = component[at : at + n]
                kinds, count = np.unique(own, return_counts=True)
                outside = own != kinds[count.argmax()]
                everyone = np.arange(n)
                for x in np.flatnonzero(outside):
                    others = at + everyone[(own != own[x]) & (~outside | (everyone > x))]
                    x = at + int(x)
                    others = others[test(np.full(len(others), x), others)]
                    left.append(np.full(len(others), x))
                    right.append(others)
            i, j = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (left, right))
            a, b = ids[i], ids[j]
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    return find


def linked(members: DataFrame, placed: DataFrame, prepare: Callable[[pa.RecordBatch], Test], verify: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Components (node, component) of the verified links among members (sig, class, flags).

    ``placed`` (class, band, ...) holds what ``prepare`` gets of each member after its first five columns.
    """
    members = members.withColumn("band", F.shiftright("flags", 2))
    sized = members.groupBy("sig").count()
    largest = sized.agg(F.max("count")).first()[0] or 0
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    tested: DataFrame | None = None
    links: DataFrame | None = None
    found: DataFrame | None = None
    rest = [c for c in placed.columns if c not in ("class", "band")]

    def add(dealt: DataFrame, only_forest: bool) -> DataFrame:
        nonlocal tested, links
        rows = dealt.join(placed, ["class", "band"]).select("sig", "block", "class", "component", "flags", *rest)
        pairs = rows.repartition("sig", "block").sortWithinPartitions("sig", "block").mapInArrow(_finder(prepare, only_forest), PAIR)
        new = pairs.distinct()
        new = stored(new if tested is None else new.join(tested, ["a", "b"], "left_anti"), "pairs")
        good = stored(verify(new), "links")
        tested = new if tested is None else tested.unionByName(new)
        links = good if links is None else links.unionByName(good)
        return components(links)

    def apart(some: DataFrame) -> DataFrame:
        """Members of the buckets that hold more than one component."""
        if found is None:
            return some.withColumn("component", F.col("class"))
        where = some.join(found.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
        mixed = where.groupBy("sig").agg(F.min("component").alias("l"), F.max("component").alias("m")).filter("l <> m").select("sig")
        return where.join(mixed, "sig", "left_semi")

    for part in PARTS:
        some = members.filter(F.pmod("sig", F.lit(part)) == 0)
        for turn in range(4 if largest > BLOCK and part == PARTS[0] else 1):
            own = F.pmod(F.xxhash64("class", F.lit(turn)), blocks).cast("int")
            now = apart(some)
            found = add(now.withColumn("block", F.lit(0)) if largest <= BLOCK else now.join(sized, "sig").withColumn("block", own), True)
    now = stored(apart(members), "apart")
    if largest <= BLOCK:
        return add(now.withColumn("block", F.lit(0)), False)
    counts = now.groupBy("sig", "component").count().groupBy("sig").agg(F.max(F.struct("count", "component")).alias("c"), F.sum("count").alias("count"))
    own = F.array(F.pmod(F.xxhash64("class"), blocks).cast("int"))
    everywhere = F.col("component") != F.col("c.component")
    dealt = now.join(counts, "sig").withColumn("block", F.explode(F.when(everywhere, F.sequence(F.lit(0), blocks - 1)).otherwise(own)))
    return add(dealt, False)
