"""Connected components of a graph that is given as edges, by alternating large and small stars.

Every node is moved to the least node near it until only stars remain. Both steps are minima and
joins on keys: nothing is gathered for a node, so one with a third of all edges is only a hot join
key, which adaptive execution splits. Each round is written to the shared folder. A graph of at most ``FEW``
edges is kept in one partition, where neither step needs an exchange: dealt out, each of its rounds would be some
eight stages of as many tasks as there are shuffle partitions, of a few edges or none each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citypulse.llm.storage import stored

#: Edges of two longs that one partition holds, 1.6 MB.
FEW = 100_000


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) to (node, component), the least node reachable; nodes without edges are not listed."""
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    few = now.limit(FEW + 1).count() <= FEW  # no step makes edges more
    while True:
        now = now.coalesce(1) if few else now
        if _only_stars(now):
            break
        now = stored(_small_star(_large_star(now)), "edges")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _both(first: tuple[Column, Column], second: tuple[Column, Column], names: tuple[str, str]) -> Column:
    """Two rows of each one, with the given columns."""
    return F.inline(F.array(*(F.struct(*(c.alias(n) for c, n in zip(pair, names, strict=True))) for pair in (first, second))))


def _only_stars(edges: DataFrame) -> bool:
    """Whether each node has one lesser neighbour and no other, or none."""
    ends = edges.select(_both((F.col("u"), F.lit(1)), (F.col("v"), F.lit(0)), ("node", "lesser")))
    inner = ends.groupBy("node").agg(F.count("*").alias("n"), F.sum("lesser").alias("lesser")).filter("lesser > 0 and n > 1")
    return inner.agg(F.count("*")).first()[0] == 0


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the least node among it and its neighbours."""
    u, v = F.col("u"), F.col("v")
    both = edges.select(_both((u, v), (v, u), ("u", "v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return (
        both.filter("v > u").join(least, F.col("u") == F.col("w"))
        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its lesser neighbours to the least of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
    moved = edges.join(least, F.col("u") == F.col("w"))
    return moved.select(_both((F.col("v"), F.col("m")), (F.col("u"), F.col("m")), ("u", "v"))).filter("u <> v").distinct()
