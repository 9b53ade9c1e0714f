"""Values at many ranks of several columns at once, exact at any size.

Approximate quantiles propose cut values near all wanted ranks; one counting pass over the rows then says how
many lie under, on and between the cuts, so it is known which cut each rank is, or between which two
it lies. Only the rows between those are looked at again, all intervals together, until every
rank is a cut: about one in a hundred thousand rows for each rank after the first round, one in 64
of these after each other. Nothing is sorted or gathered; counts and cuts reach the driver, whose number follows from
the ranks and not from the rows.
"""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citypulse.session import cut_lineage

ACCURACY = 100_000
#: Cuts of an interval after the first round.
CUTS = 65


def _bucket(value: Column, cuts: Column, most: int) -> Column:
    """Twice the number of cuts below the value, and one more if it is a cut itself. A fold over powers of two."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(most.bit_length()))])

    def step(found: Column, size: Column) -> Column:
        return F.when(F.coalesce(F.get(cuts, found + size - 1) < value, F.lit(False)), found + size).otherwise(found)

    under = F.aggregate(steps, F.lit(0), step)
    # One evaluation of the fold for both of its uses.
    return F.transform(F.array(under), lambda u: 2 * u + F.coalesce(F.get(cuts, u) == value, F.lit(False)).cast("int"))[0]


def sizes(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """Number of values of each column, without NULL and NaN."""
    return df.agg(*[F.count_if(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))).alias(c) for c in columns]).first().asDict()


def order_statistics(df: DataFrame, wanted: dict[str, list[int]]) -> dict[str, dict[int, float]]:
    """Value at each 0-based rank of the sorted values of each column. NULL and NaN are no values."""
    names = list(wanted)
    counts = sizes(df, names)
    for name, ranks in wanted.items():
        if ranks and not 0 <= min(ranks) <= max(ranks) < counts[name]:
            raise ValueError(f"{name} has {counts[name]} values")
    out: dict[str, dict[int, float]] = {name: {} for name in names}
    values = F.explode(F.array(*[F.struct(F.lit(k).alias("g"), F.col(c).cast("double").alias("v")) for k, c in enumerate(names)]))
    rest = df.select(values.alias("p")).select("p.g", "p.v").filter(F.col("v").isNotNull() & ~F.isnan("v"))
    # Interval to its column, the rows before it and the ranks in it.
    open_: dict[int, tuple[str, int, list[int]]] = {k: (name, 0, sorted(set(wanted[name]))) for k, name in enumerate(names)}
    margin = 2.0 / ACCURACY
    near = {r / max(counts[name] - 1, 1) + d for name, ranks in wanted.items() for r in ranks for d in (-margin, margin)}
    shares = sorted({min(max(s, 0.0), 1.0) for s in near})
    while any(ranks for _, _, ranks in open_.values()):
        # A row an interval: its cuts, of which there are at most as many as shares.
        cuts = cut_lineage(rest.groupBy("g").agg(F.array_sort(F.array_distinct(F.percentile_approx("v", shares, ACCURACY))).alias("cuts")))
        placed = rest.join(cuts, "g").withColumn("bucket", _bucket(F.col("v"), F.col("cuts"), len(shares)))
        of = {r.g: r.cuts for r in cuts.collect()}
        found: dict[int, dict[int, int]] = {}
        for r in placed.groupBy("g", "bucket").count().collect():
            found.setdefault(r.g, {})[r.bucket] = r["count"]
        following: dict[int, tuple[str, int, list[int]]] = {}
        keep = []
        for g, (name, before, ranks) in open_.items():
            edges = [before]
            buckets = sorted(found.get(g, {}))
            for b in buckets:
                edges.append(edges[-1] + found[g][b])
            for b, (low, high) in zip(buckets, pairwise(edges), strict=True):
                own = [r for r in ranks if low <= r < high]
                if not own:
                    continue
                if b % 2:
                    out[name].update(dict.fromkeys(own, of[g][b // 2]))
                else:
                    keep.append((g, b, len(following)))
                    following[len(following)] = (name, low, own)
        if not following:
            break
        spark = df.sparkSession
        to = spark.createDataFrame(keep, "g int, bucket int, next int")
        rest = cut_lineage(placed.select("g", "bucket", "v").join(to, ["g", "bucket"]).select(F.col("next").alias("g"), "v"))
        open_, shares = following, [i / (CUTS - 1) for i in range(CUTS)]
    return out


def quantiles(df: DataFrame, counts: dict[str, int]) -> dict[str, list[float]]:
    """So many equally spaced quantiles of each column, the first its least and the last its greatest value.

    Between two neighbouring values a quantile is interpolated. A single one is the median; without values there are none.
    """
    n = sizes(df, list(counts))

    def places(name: str) -> list[tuple[int, float]]:
        if not n[name]:
            return []
        last, parts = n[name] - 1, counts[name] - 1
        pairs = [divmod(i * last, parts) for i in range(parts + 1)] if parts else [divmod(last, 2)]
        return [(low, over / (parts or 2)) for low, over in pairs]

    at = {name: places(name) for name in counts}
    ranks = {name: sorted({r for low, part in found for r in ((low, low + 1) if part else (low,))}) for name, found in at.items()}
    value = order_statistics(df, ranks)
    return {
        name: [value[name][low] + (value[name][low + 1] - value[name][low]) * part if part else value[name][low] for low, part in found]
        for name, found in at.items()
    }
