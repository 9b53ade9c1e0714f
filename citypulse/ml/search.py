"""Search over the settings of tree ensembles on feature cells: one pass over the rows, all models from its sums.

A tree asks of a row only in which bin each feature lies. With at most ``MAX_BINS`` bins a feature, rows fall
into a bounded number of cells, and for squared error a cell is fully described by its number of rows and
their sum. So Spark sums the rows once by (draw, fold, cell), whatever their number: a draw is a bootstrap sample
of the rows (for a tree of a forest) or a random part of them (for a step of boosting), decided by a
hash of each row. These sums are exact, not a sample of the data. The models are then grown from the
sums alone, the trees of a task in step, with one histogram a level for all of them; tasks are dealt
out by fold, draws and depth.

Settings share work: 300 trees hold the first 200, a forest grown to depth 15 holds the one of depth 5, and
all learning rates go through the same draws. A model is a number for each cell, so it is stored and applied as a
table, by column arithmetic.

Defined results: rows need a label and all features; a cell without rows is predicted by the bins it lies
in, as any other; equal gains go to the first feature and lowest bin; without rows there is no model (an error).
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citypulse.ml.model import FOLDS, LABEL, SEED, STACK_FOLDS

#: Bins of a feature; cells of a model; draws whose trees a task grows; nodes times bins that it holds at once.
MAX_BINS, MOST_CELLS, CHUNK, HELD = 32, 1 << 16, 25, 1 << 21
ACCURACY = 100_000
# Probability of at most 0, 1, 2 ... rows where one is expected (Poisson).
POISSON = [math.exp(-1) * sum(1 / math.factorial(i) for i in range(k + 1)) for k in range(12)]
# The searched settings of the forest; boosted ones are in ``model``.
FOREST_SETTINGS = {"numTrees": [100, 200, 300], "maxDepth": [5, 10, 15], "minSamplesSplit": [2, 5]}
FINAL_FOREST = {"numTrees": 150, "maxDepth": 5, "minSamplesSplit": 2}
FOREST, BOOSTED = "forest", "boosted"
BAGS = -1.0


class Cells(NamedTuple):
    """Cells of a product of bins. A value is in the bin numbered by how many edges lie below it."""

    edges: list[list[float]]

    @property
    def sizes(self) -> list[int]:
        return [len(e) + 1 for e in self.edges]

    @property
    def count(self) -> int:
        return math.prod(self.sizes)

    def bins(self) -> np.ndarray:
        """The bins of each cell, one column a feature."""
        return np.stack(np.unravel_index(np.arange(self.count), self.sizes), axis=1)

    def cell(self, features: Column) -> Column:
        total = F.lit(0)
        for k, edges in enumerate(self.edges):
            own = sum(((features[k] > F.lit(e)).cast("int") for e in edges), F.lit(0))
            total = total * F.lit(len(edges) + 1) + own
        return total

    def of(self, values: np.ndarray) -> np.ndarray:
        """Cells of rows of values."""
        return np.ravel_multi_index([np.searchsorted(e, values[:, k], side="left") for k, e in enumerate(self.edges)], self.sizes)


def _edges(least: float, cuts: Iterable[float], greatest: float) -> list[float]:
    return sorted({float(x) for x in (least, *cuts)} - {float(greatest)})


def cells_of(rows: DataFrame, size: int) -> Cells:
    """Bins of the ``size`` features in the array ``x``: edges at quantiles, and at the least value."""
    shares = [i / (MAX_BINS - 1) for i in range(1, MAX_BINS - 1)]
    found = rows.agg(*[F.struct(F.min(c), F.percentile_approx(c, shares, ACCURACY), F.max(c)) for c in (F.col("x")[k] for k in range(size))]).first()
    if any(low is None for low, _, _ in found):
        raise ValueError("no rows to learn from")
    cells = Cells([_edges(*f) for f in found])
    if cells.count > MOST_CELLS:
        raise ValueError(f"{cells.count} cells are more than {MOST_CELLS}: use model.tune for so many features")
    return cells


class Sums(NamedTuple):
    """Rows, their sum and their sum of squares for each (fold, cell); only cells ``seen`` in any fold."""

    seen: np.ndarray
    n: np.ndarray
    s: np.ndarray
    squares: np.ndarray

    def without(self, fold: int) -> tuple[np.ndarray, np.ndarray]:
        use = np.arange(len(self.n)) != fold
        return self.n[use].sum(axis=0), self.s[use].sum(axis=0)

    def r2(self, fold: int, values: np.ndarray) -> float | None:
        """Of the value of each cell on the rows of a fold. None where the labels do not differ."""
        n, s, squares = self.n[fold], self.s[fold], self.squares[fold]
        around = squares.sum() - s.sum() ** 2 / max(n.sum(), 1)
        v = values[self.seen]
        return float(1 - (squares - 2 * v * s + v * v * n).sum() / around) if around > 0 else None


def _counted(rows: DataFrame) -> DataFrame:
    """Rows with how often each stands for itself."""
    return rows if "m" in rows.columns else rows.withColumn("m", F.lit(1).cast("long"))


def _sums(rows: DataFrame, folds: int) -> Sums:
    """At most folds times cells numbers reach the driver, however many rows there are."""
    y = F.col("y")
    found = _counted(rows).groupBy("fold", "cell").agg(F.sum("m").alias("n"), F.sum(F.col("m") * y).alias("s"), F.sum(F.col("m") * y * y).alias("q")).toArrow()
    fold, cell = (found.column(c).to_numpy() for c in ("fold", "cell"))
    seen = np.unique(cell)
    out = np.zeros((3, folds, len(seen)))
    for k, name in enumerate(("n", "s", "q")):
        out[k, fold, np.searchsorted(seen, cell)] = found.column(name).to_numpy()
    return Sums(seen, *out)


def _drawn(rows: DataFrame, rate: float, draws: int, first: int = 0) -> DataFrame:
    """(rate, draw, fold, cell, n, s) of random parts of the rows, or of bootstrap samples (rate ``BAGS``)."""
    place = F.pmod(F.xxhash64("h", "draw", F.lit(rate)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    times = sum(((F.col("u") >= F.lit(p)).cast("int") for p in POISSON), F.lit(0)) if rate == BAGS else (F.col("u") < rate).cast("int")
    each = _counted(rows).select("fold", "cell", "y", "h", "m", F.explode(F.sequence(F.lit(first), F.lit(first + draws - 1))).alias("draw")).withColumn("u", place)
    taken = each.select("draw", "fold", "cell", times.alias("times"), "m", "y").filter("times > 0")
    sums = taken.groupBy("draw", "fold", "cell").agg(F.sum(F.col("times") * F.col("m")).cast("double").alias("n"), F.sum(F.col("times") * F.col("m") * F.col("y")).alias("s"))
    return sums.select(F.lit(rate).alias("rate"), (F.col("draw") - first).alias("draw"), "fold", "cell", "n", "s")


class Grown(NamedTuple):
    """Value of each tree and cell, and what each feature gained."""

    values: np.ndarray
    gains: np.ndarray


def grow(cells: Cells, seen: np.ndarray, n: np.ndarray, s: np.ndarray, depths: list[int], least_to_split: int = 2) -> dict[int, Grown]:
    """Regression trees in step, read at each of ``depths``; rows and sums have a row a tree, a column a seen cell."""
    trees, sizes, width = len(n), np.array(cells.sizes), sum(cells.sizes)
    bins, features = cells.bins(), np.repeat(np.arange(len(sizes)), sizes)
    offset = np.cumsum(sizes) - sizes
    columns = (bins + offset)[seen]
    node = np.repeat(np.arange(trees)[:, None], cells.count, axis=1)
    owner = np.arange(trees)
    rows, total = n.sum(axis=1), s.sum(axis=1)
    values = np.repeat((total / np.maximum(rows, 1))[:, None], cells.count, axis=1)
    gains = np.zeros((trees, len(sizes)))
    out: dict[int, Grown] = {}
    for level in range(1, max(depths) + 1):
        if len(owner):
            at = node[:, seen]
            live = (at >= 0) & (n > 0)
            which = np.nonzero(live)[1]
            place = (at[live][:, None] * width + columns[which]).ravel()
            left_n, left_s = (
                np.cumsum(np.bincount(place, np.repeat(x[live], len(sizes)), len(owner) * width).reshape(-1, width).astype(float), axis=1) for x in (n, s)
            )
            left_n -= features * rows[:, None]
            left_s -= features * total[:, None]
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = left_s**2 / left_n + (total[:, None] - left_s) ** 2 / (rows[:, None] - left_n) - (total**2 / rows)[:, None]
            gain[(left_n < 0.5) | (rows[:, None] - left_n < 0.5)] = 0
            # The first of those that differ from the greatest by no more than rounding.
            best = (gain >= gain.max(axis=1, keepdims=True) * (1 - 1e-9)).argmax(axis=1)
            own = np.arange(len(best))
            won = gain[own, best]
            split = (won > 1e-9 * np.maximum(1.0, total**2 / np.maximum(rows, 1))) & (rows >= least_to_split)
            child = np.cumsum(split) - 1
            np.add.at(gains, (owner[split], features[best[split]]), won[split])
            parts_n = np.stack([left_n[own, best], rows - left_n[own, best]], axis=1)[split].ravel()
            parts_s = np.stack([left_s[own, best], total - left_s[own, best]], axis=1)[split].ravel()
            tree, cell = np.nonzero(node >= 0)
            old = node[tree, cell]
            feature = features[best[old]]
            right = bins[cell, feature] > best[old] - offset[feature]
            new = np.where(split[old], 2 * child[old] + right, -1)
            node[tree, cell] = new
            moved = new >= 0
            values[tree[moved], cell[moved]] = (parts_s / parts_n)[new[moved]]
            owner, rows, total = np.repeat(owner[split], 2), parts_n, parts_s
        if level in depths:
            out[level] = Grown(values.copy(), gains.copy())
    return out


def _shares(gains: np.ndarray) -> np.ndarray:
    """What each feature gained, summed over trees that count alike."""
    whole = gains.sum(axis=1, keepdims=True)
    return np.divide(gains, whole, out=np.zeros_like(gains), where=whole > 0).sum(axis=0)


def boost(cells: Cells, seen: np.ndarray, n: np.ndarray, s: np.ndarray, depth: int, rates: list[float], marks: list[int]) -> dict[tuple[float, int], tuple[np.ndarray, np.ndarray]]:
    """(learning rate, steps) to the value of each cell and the gains. Rows and sums have a row a step, or one for all."""
    start = s.sum() / max(n.sum(), 1)
    values = np.full((len(rates), cells.count), start)
    gains = np.zeros((len(rates), len(cells.sizes)))
    out = {}
    for step in range(1, max(marks) + 1):
        own = (step - 1) % len(n)
        part_n = np.repeat(n[own][None], len(rates), axis=0)
        part_s = s[own][None] - part_n * values[:, seen]
        tree = grow(cells, seen, part_n, part_s, [depth])[depth]
        values += np.array(rates)[:, None] * tree.values
        gains += np.stack([_shares(g[None]) for g in tree.gains])
        if step in marks:
            out |= {(rate, step): (values[k].copy(), gains[k].copy()) for k, rate in enumerate(rates)}
    return out


class Family(NamedTuple):
    """A kind of model with the settings to try, each a list."""

    kind: str
    grid: dict[str, list]

    @property
    def settings(self) -> list[dict]:
        return [dict(zip(self.grid, values, strict=True)) for values in itertools.product(*self.grid.values())]


FOUND = "setting string, fold int, r2 double, cells array<double>, gains array<double>"


def _dense(table: pa.Table, seen: np.ndarray, draws: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and sums by (draw, seen cell) from rows of several folds."""
    draw, cell = (table.column(c).to_numpy() for c in ("place", "cell"))
    out = np.zeros((2, draws, len(seen)))
    for k, name in enumerate(("n", "s")):
        np.add.at(out[k], (draw, np.searchsorted(seen, cell)), table.column(name).to_numpy())
    return out[0], out[1]


def _row(setting: dict, fold: int, sums: Sums, values: np.ndarray, gains: np.ndarray) -> dict:
    """The score on the fold that was held out, or the model itself if none was."""
    whole = fold < 0
    return {
        "setting": json.dumps(setting, sort_keys=True), "fold": fold, "r2": None if whole else sums.r2(fold, values),
        "cells": values.tolist(), "gains": gains.tolist(),
    }


_FOUND = pa.schema([("setting", pa.string()), ("fold", pa.int32()), ("r2", pa.float64()), ("cells", pa.list_(pa.float64())), ("gains", pa.list_(pa.float64()))])


def _held_out(folds: list[int], own: Column) -> Column:
    """Each of ``folds`` but the row's own: the models that learn from the row."""
    return F.explode(F.filter(F.array(*map(F.lit, folds)), lambda k: k != own))


def _forests(rows: DataFrame, cells: Cells, sums: Sums, grid: dict[str, list], folds: list[int], first: int = 0) -> DataFrame:
    """Every setting of forests, without each of ``folds`` (-1: without none)."""
    marks, depths, least = sorted(grid["numTrees"]), sorted(grid["maxDepth"]), sorted(grid.get("minSamplesSplit", [2]))
    seen = sums.seen
    at_once = max(1, HELD // (len(seen) * sum(cells.sizes)))
    drawn = _drawn(rows, BAGS, max(marks), first)
    dealt = drawn.withColumns({"out": _held_out(folds, F.col("fold")), "chunk": F.floor(F.col("draw") / CHUNK).cast("int")})
    dealt = dealt.select("out", "chunk", (F.col("draw") % CHUNK).alias("place"), "cell", "n", "s")

    def plant(key: tuple, table: pa.Table) -> pa.Table:
        fold, chunk = (k.as_py() for k in key)
        count = min(CHUNK, max(marks) - chunk * CHUNK)
        n, s = _dense(table, seen, count)
        # A chunk that holds a mark is given up to it, and whole.
        ends = sorted({m - chunk * CHUNK for m in marks if 0 < m - chunk * CHUNK < count} | {count})
        out = []
        for least_rows in least:
            summed = {d: (np.zeros(cells.count), np.zeros(len(cells.sizes))) for d in depths}
            at = 0
            for end in ends:
                while at < end:
                    stop = min(at + at_once, end)
                    grown = grow(cells, seen, n[at:stop], s[at:stop], depths, least_rows)
                    for d in depths:
                        summed[d] = (summed[d][0] + grown[d].values.sum(axis=0), summed[d][1] + _shares(grown[d].gains))
                    at = stop
                out += [(fold, least_rows, d, chunk * CHUNK + end, end == count, *(x.tolist() for x in summed[d])) for d in depths]
        names = ["out", "least", "depth", "upto", "whole", "cells", "gains"]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.float64()), pa.list_(pa.float64())]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    planted = dealt.groupBy("out", "chunk").applyInArrow(plant, "out int, least int, depth int, upto int, whole boolean, cells array<double>, gains array<double>")

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        fold, least_rows, depth = (k.as_py() for k in key)
        parts = sorted(table.to_pylist(), key=lambda r: (r["upto"], r["whole"]))
        out = []
        for mark in marks:
            # All whole chunks before the mark, and the part of its own chunk.
            last = next(r for r in parts if r["upto"] == mark)
            use = [r for r in parts if r["whole"] and r["upto"] <= (mark - 1) // CHUNK * CHUNK] + [last]
            values, gains = (np.sum([r[c] for r in use], axis=0) for c in ("cells", "gains"))
            setting = {"numTrees": mark, "maxDepth": depth} | ({"minSamplesSplit": least_rows} if "minSamplesSplit" in grid else {})
            out.append(_row(setting, fold, sums, values / mark, gains))
        return pa.Table.from_pylist(out, _FOUND)

    return planted.groupBy("out", "least", "depth").applyInArrow(gather, FOUND)


def _boosts(rows: DataFrame, cells: Cells, sums: Sums, grid: dict[str, list], folds: list[int]) -> DataFrame:
    """Every setting of boosted trees, without each of ``folds`` (-1: without none)."""
    marks, depths, steps = sorted(grid["maxIter"]), sorted(grid["maxDepth"]), sorted(grid.get("stepSize", [0.1]))
    rates = sorted(grid.get("subsamplingRate", [1.0]))
    seen = sums.seen
    dealt = None
    for rate in (r for r in rates if r < 1):
        drawn = _drawn(rows, rate, max(marks)).select("rate", F.col("draw").alias("place"), "fold", "cell", "n", "s")
        dealt = drawn if dealt is None else dealt.unionByName(drawn)
    if 1.0 in rates:
        # All rows: their sums are here already, so a task needs no more than its name.
        whole = rows.sparkSession.range(1).select(F.lit(1.0).alias("rate"), F.lit(0).alias("place"), F.lit(-2).alias("fold"), F.lit(0).alias("cell"), F.lit(0.0).alias("n"), F.lit(0.0).alias("s"))
        dealt = whole if dealt is None else dealt.unionByName(whole)
    tasks = dealt.withColumn("out", _held_out(folds, F.col("fold"))).withColumn("depth", F.explode(F.array(*map(F.lit, depths))))

    def climb(key: tuple, table: pa.Table) -> pa.Table:
        rate, fold, depth = (k.as_py() for k in key)
        n, s = _dense(table, seen, max(marks)) if rate < 1 else (x[None] for x in sums.without(fold))
        out = []
        for (step, mark), (values, gains) in boost(cells, seen, n, s, depth, steps, marks).items():
            setting = {"maxIter": mark, "maxDepth": depth}
            setting |= {name: value for name, value in (("stepSize", step), ("subsamplingRate", rate)) if name in grid}
            out.append(_row(setting, fold, sums, values, gains))
        return pa.Table.from_pylist(out, _FOUND)

    return tasks.groupBy("rate", "out", "depth").applyInArrow(climb, FOUND)


def _fitted(kind: str, rows: DataFrame, cells: Cells, sums: Sums, grid: dict[str, list], folds: list[int]) -> DataFrame:
    return (_forests if kind == FOREST else _boosts)(rows, cells, sums, grid, folds)


class CellTable(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Predicts the number of the cell that the features lie in, by column arithmetic."""

    featuresCol = Param(Params._dummy(), "featuresCol", "vector of features", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "result column", TypeConverters.toString)
    edges = Param(Params._dummy(), "edges", "edges of the bins of each feature")
    values = Param(Params._dummy(), "values", "prediction of each cell")
    importances = Param(Params._dummy(), "importances", "share of each feature in the gain")

    @classmethod
    def make(cls, cells: Cells, values: np.ndarray, gains: np.ndarray) -> CellTable:
        whole = float(np.sum(gains))
        model = cls()
        model._set(featuresCol="features", predictionCol="prediction", edges=cells.edges, values=[float(v) for v in values])
        model._set(importances=[float(g) / whole if whole else 0.0 for g in gains])
        return model

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802  as models of Spark ML call it
        return Vectors.dense(self.getOrDefault(self.importances))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cell = Cells(self.getOrDefault(self.edges)).cell(vector_to_array(F.col(self.getOrDefault(self.featuresCol))))
        # One text constant, folded to an array when the plan is optimised.
        table = F.split(F.lit(",".join(map(repr, self.getOrDefault(self.values)))), ",").cast("array<double>")
        return dataset.withColumn(self.getOrDefault(self.predictionCol), F.get(table, cell))


class _Prepared(NamedTuple):
    stages: PipelineModel
    rows: DataFrame
    cells: Cells


def _prepare(train: DataFrame, features: list, folds: int, seed: int, keys: list[str], label: str) -> _Prepared:
    """Rows (cell, fold, y, h) and how many there are of each, m: folds and draws come from hashes, so neither changes with the partitioning.

    Rows of one hash fall into the same draws, so they are counted once and drawn together.
    """
    stages = Pipeline(stages=features).fit(train)
    fold = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(folds)).cast("int")
    x = vector_to_array(F.col("features"))
    rows = stages.transform(train).select(x.alias("x"), F.col(label).cast("double").alias("y"), fold.alias("fold"), F.xxhash64(F.lit(seed), *keys, F.col(label), x).alias("h"))
    rows = rows.filter(F.col("y").isNotNull())
    first = rows.select(F.size("x")).first()
    if first is None:
        raise ValueError("no rows to learn from")
    cells = cells_of(rows, first[0])
    placed = rows.select(cells.cell(F.col("x")).cast("int").alias("cell"), "fold", "y", "h")
    return _Prepared(stages, placed.groupBy("cell", "fold", "y", "h").agg(F.count(F.lit(1)).alias("m")).persist(), cells)


class Result(NamedTuple):
    """The best model, its settings, and the mean r2 over the folds of every setting."""

    model: PipelineModel
    settings: dict
    scores: list[tuple[dict, float]]


def search(train: DataFrame, features: list, family: Family, keys: list[str], folds: int = FOLDS, label: str = LABEL) -> Result:
    """Best model of a family by r2 over folds, and fitted to all rows. ``features`` are stages that give ``features``."""
    prepared = _prepare(train, features, folds, SEED + 2, keys, label)
    try:
        sums = _sums(prepared.rows, folds)
        found = _fitted(family.kind, prepared.rows, prepared.cells, sums, family.grid, [*range(folds), -1])
        # Numbers of the folds, and of each setting the table of cells, whose size is bounded.
        rows = found.withColumn("cells", F.when(F.col("fold") < 0, F.col("cells"))).collect()
    finally:
        prepared.rows.unpersist()
    by_setting = {name: list(group) for name, group in itertools.groupby(sorted(rows, key=lambda r: r.setting), lambda r: r.setting)}
    scores = []
    for setting in family.settings:
        own = by_setting[json.dumps(setting, sort_keys=True)]
        known = [r.r2 for r in own if r.r2 is not None]
        scores.append((setting, sum(known) / len(known) if known else -math.inf))
    best = max(scores, key=lambda p: p[1])[0]
    whole = next(r for r in by_setting[json.dumps(best, sort_keys=True)] if r.fold < 0)
    return Result(PipelineModel(stages=[prepared.stages, CellTable.make(prepared.cells, np.array(whole.cells), np.array(whole.gains))]), best, scores)


def stack(train: DataFrame, features: list, bases: dict[str, tuple[str, dict]], keys: list[str], final: dict | None = None, folds: int = STACK_FOLDS, label: str = LABEL) -> PipelineModel:
    """A forest on out-of-fold predictions of base models, name to (kind, settings), which are then fitted to all rows.

    A base's prediction depends on a row's cell and fold only, so the final forest, too, learns from sums by cell.
    """
    final = final or FINAL_FOREST
    prepared = _prepare(train, features, folds, SEED + 1, keys, label)
    rows, cells = prepared.rows, prepared.cells
    try:
        sums = _sums(rows, folds)
        tables = np.zeros((len(bases), folds + 1, cells.count))
        for k, (kind, settings) in enumerate(bases.values()):
            for r in _fitted(kind, rows, cells, sums, {name: [value] for name, value in settings.items()}, [*range(folds), -1]).collect():
                tables[k, r.fold] = r.cells
        fold, place = np.nonzero(sums.n)
        held_out = tables[:, fold, sums.seen[place]]
        over = Cells([_weighted_edges(v, sums.n[fold, place]) for v in held_out])
        moved = np.zeros((folds, cells.count), np.int64)
        moved[fold, sums.seen[place]] = over.of(held_out.T)
        spark = rows.sparkSession
        # A row for each fold and cell.
        to = spark.createDataFrame([(int(k), int(c), int(moved[k, c])) for k, c in zip(fold, sums.seen[place], strict=True)], "fold int, cell int, over int")
        again = rows.join(to, ["fold", "cell"]).select(F.lit(0).alias("fold"), F.col("over").alias("cell"), "y", "h", "m")
        grid = {name: [value] for name, value in final.items()}
        last = _forests(again, over, _sums(again, 1), grid, [-1], first=1 << 20).first()
    finally:
        rows.unpersist()
    whole = tables[:, -1].T
    return PipelineModel(stages=[prepared.stages, CellTable.make(cells, np.array(last.cells)[over.of(whole)], np.zeros(len(cells.sizes)))])


def _weighted_edges(values: np.ndarray, weights: np.ndarray) -> list[float]:
    order = np.argsort(values, kind="stable")
    share = np.cumsum(weights[order]) / weights.sum()
    at = np.minimum(np.searchsorted(share, [i / (MAX_BINS - 1) for i in range(1, MAX_BINS - 1)]), len(values) - 1)
    return _edges(values.min(), values[order][at], values.max())
