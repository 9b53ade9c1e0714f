"""Trees on feature cells against plain versions and against Spark ML."""

import itertools

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from citypulse.ml import model, search
from citypulse.operators import ranks


def plain_tree(bins, y, w, depth, least):
    """(feature, bin, left, right) or a mean, by trying every split."""
    mean = (w * y).sum() / w.sum()
    if depth == 0 or w.sum() < least:
        return mean
    best = (1e-9, None)
    for f in range(bins.shape[1]):
        for c in range(bins[:, f].max() + 1):
            left = bins[:, f] <= c
            a, b = w[left].sum(), w[~left].sum()
            if a < 0.5 or b < 0.5:
                continue
            gain = (w * y)[left].sum() ** 2 / a + (w * y)[~left].sum() ** 2 / b - (w * y).sum() ** 2 / w.sum()
            if gain > best[0] * (1 + 1e-9):
                best = (gain, (f, c))
    if best[1] is None:
        return mean
    f, c = best[1]
    left = bins[:, f] <= c
    return f, c, plain_tree(bins[left], y[left], w[left], depth - 1, least), plain_tree(bins[~left], y[~left], w[~left], depth - 1, least)


def value_of(tree, bins):
    while isinstance(tree, tuple):
        tree = tree[2] if bins[tree[0]] <= tree[1] else tree[3]
    return tree


def test_trees_in_step_are_plain_trees():
    rng = np.random.default_rng(5)
    for _ in range(40):
        cells = search.Cells([list(range(rng.integers(0, 6))) for _ in range(3)])
        bins, rows = cells.bins(), rng.integers(1, 80)
        c, y, w = rng.integers(cells.count, size=rows), rng.normal(size=rows) * 10, rng.integers(0, 3, size=(3, rows)).astype(float)
        seen = np.unique(c)
        at, n, s = np.searchsorted(seen, c), np.zeros((3, len(seen))), np.zeros((3, len(seen)))
        for t in range(3):
            np.add.at(n[t], at, w[t])
            np.add.at(s[t], at, w[t] * y)
        least = int(rng.choice([2, 5]))
        grown = search.grow(cells, seen, n, s, [1, 2, 4], least)
        for t, depth in itertools.product(range(3), (1, 2, 4)):
            use = w[t] > 0
            if use.any():
                tree = plain_tree(bins[c[use]], y[use], w[t][use], depth, least)
                learnt = seen[n[t] > 0]
                assert np.allclose([value_of(tree, bins[k]) for k in learnt], grown[depth].values[t][learnt])


def frame(spark, count=3000):
    a, b = F.col("id") * 7919 % 1000, F.col("id") * 104729 % 24
    total = 5 * b + F.when(a > 400, 60).otherwise(0) + F.when((a > 700) & (b > 12), 30).otherwise(0) + F.pmod(F.hash("id"), F.lit(7))
    return spark.range(count).select(F.col("id").alias("k"), a.cast("double").alias("a"), b.cast("double").alias("b"), total.cast("double").alias("total"))


def stages():
    return [VectorAssembler(inputCols=["a", "b"], outputCol="features")]


def test_one_tree_is_the_one_of_spark_ml(spark):
    rows = frame(spark).withColumn("a", F.floor(F.col("a") / 40) * 40.0)  # fewer values than bins
    own = search.search(rows, stages(), search.Family(search.BOOSTED, {"maxIter": [1], "maxDepth": [4], "stepSize": [1.0]}), ["k"]).model.transform(rows)
    theirs = Pipeline(stages=[*stages(), DecisionTreeRegressor(labelCol="total", maxDepth=4, maxBins=64)]).fit(rows).transform(rows)
    both = own.select("k", F.col("prediction").alias("p")).join(theirs.select("k", F.col("prediction").alias("q")), "k")
    assert both.filter(F.abs(F.col("p") - F.col("q")) > 1e-6).count() == 0


@pytest.mark.parametrize("kind, grid, count", [
    (search.FOREST, {"numTrees": [10, 30, 40], "maxDepth": [2, 6], "minSamplesSplit": [2, 50]}, 12),
    (search.BOOSTED, {"maxIter": [5, 25], "maxDepth": [2, 4], "stepSize": [0.1, 0.3], "subsamplingRate": [0.7, 1.0]}, 16),
])
def test_small_grids_are_searched_whole(spark, tmp_path, kind, grid, count):
    rows = frame(spark)
    train, test = model.split_by_key(rows, ["k"])
    found = search.search(train, stages(), search.Family(kind, grid), ["k"])
    assert len(found.scores) == count and {tuple(s.values()) for s, _ in found.scores} == set(itertools.product(*grid.values()))
    assert max(s for _, s in found.scores) == dict((tuple(s.values()), r) for s, r in found.scores)[tuple(found.settings.values())]
    scored = found.model.transform(test).withColumn("predicted_total", F.col("prediction"))
    assert model.regression_metrics(scored).first().r2 > 0.9
    again = search.search(train.repartition(5), stages(), search.Family(kind, grid), ["k"])
    assert again.settings == found.settings and [r for _, r in again.scores] == pytest.approx([r for _, r in found.scores])
    importance = model.feature_importance(spark, found.model, rows).collect()
    assert sum(r.importance for r in importance) == pytest.approx(1) and {r.feature for r in importance} == {"a", "b"}
    found.model.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m")).transform(test)
    assert loaded.select("k", "prediction").exceptAll(found.model.transform(test).select("k", "prediction")).count() == 0


def test_scores_of_folds_are_those_of_a_plain_fit(spark):
    """Without subsampling: r2 of each fold from rows, with trees of Spark ML fitted to the other folds."""
    rows = frame(spark, 900).withColumn("a", F.floor(F.col("a") / 100) * 100.0)
    (setting, score), = search.search(rows, stages(), search.Family(search.BOOSTED, {"maxIter": [1], "maxDepth": [3], "stepSize": [1.0]}), ["k"]).scores
    fold = F.pmod(F.xxhash64(F.lit(model.SEED + 2), "k"), F.lit(3))
    parts = [rows.filter(fold == k) for k in range(3)], [rows.filter(fold != k) for k in range(3)]
    tree = Pipeline(stages=[*stages(), DecisionTreeRegressor(labelCol="total", maxDepth=3, maxBins=64)])
    scores = [model.regression_metrics(tree.fit(rest).transform(own).withColumn("predicted_total", F.col("prediction"))).first().r2 for own, rest in zip(*parts, strict=True)]
    assert score == pytest.approx(sum(scores) / 3, abs=1e-6)


def test_draws_are_bootstrap_samples(spark):
    rows = frame(spark, 2000).select(F.lit(0).alias("fold"), (F.col("b") % 3).cast("int").alias("cell"), F.col("total").alias("y"), F.xxhash64("k").alias("h"))
    bags = search._drawn(rows, search.BAGS, 200).groupBy("draw").agg(F.sum("n").alias("n")).toPandas()["n"]
    parts = search._drawn(rows, 0.8, 200).groupBy("draw").agg(F.sum("n").alias("n")).toPandas()["n"]
    assert abs(bags.mean() - 2000) < 15 and 35 < bags.std() < 55  # Poisson: the root of 2000 is 44.7
    assert abs(parts.mean() - 1600) < 8 and 14 < parts.std() < 22  # binomial: 17.9


def test_stack_of_tables(spark):
    rows = frame(spark)
    train, test = model.split_by_key(rows, ["k"])
    bases = {"f": (search.FOREST, {"numTrees": 20, "maxDepth": 4, "minSamplesSplit": 2}), "b": (search.BOOSTED, {"maxIter": 20, "maxDepth": 3, "stepSize": 0.2, "subsamplingRate": 0.8})}
    fitted = search.stack(train, stages(), bases, ["k"], {"numTrees": 30, "maxDepth": 5}, folds=3)
    scored = fitted.transform(test).withColumn("predicted_total", F.col("prediction"))
    assert model.regression_metrics(scored).first().r2 > 0.9


def test_nothing_to_learn_from(spark):
    family = search.Family(search.BOOSTED, {"maxIter": [1], "maxDepth": [1]})
    with pytest.raises(ValueError, match="no rows"):
        search.search(frame(spark).limit(0), stages(), family, ["k"])
    one = search.search(frame(spark).limit(1), stages(), family, ["k"])
    assert one.model.transform(frame(spark)).select("prediction").distinct().count() == 1


@pytest.mark.parametrize("cuts", [5, 65])
def test_exact_ranks(spark, monkeypatch, cuts):
    """Also where the sketch tells only a few values apart, so that several rounds are needed."""
    monkeypatch.setattr(ranks, "ACCURACY", 20 if cuts == 5 else 100_000)
    monkeypatch.setattr(ranks, "CUTS", cuts)
    x = np.random.default_rng(3).normal(size=4000).round(2)
    data = [(float(v), float(i % 3), None if i % 2 else (float("nan") if i % 4 else float(i))) for i, v in enumerate(x)]
    df = spark.createDataFrame(data, "x double, few double, holes double").repartition(5)
    holes = np.array([d[2] for d in data if d[2] is not None and d[2] == d[2]])
    found = ranks.quantiles(df, {"x": 101, "few": 7, "holes": 1})
    assert found["x"] == pytest.approx(np.quantile(x, np.linspace(0, 1, 101)).tolist(), abs=1e-12)
    assert found["few"] == np.quantile([d[1] for d in data], np.linspace(0, 1, 7)).tolist() and found["holes"] == [float(np.median(holes))]
    assert ranks.quantiles(df.limit(0), {"x": 5}) == {"x": []}
    with pytest.raises(ValueError, match="has 4000 values"):
        ranks.order_statistics(df, {"x": [4000]})


def test_equal_rows_are_counted_and_drawn_together(spark):
    each = spark.range(300).select((F.col("id") % 7).cast("string").alias("grid_id"), (F.col("id") % 24).cast("double").alias("hour"), (F.col("id") % 11).cast("double").alias("acs_cnt"),
                                   F.lit(1.0).alias("month"), (F.col("id") % 2).cast("double").alias("is_weekend_group"), (F.col("id") % 13).cast("double").alias("total"))
    once, thrice = (search._prepare(df, [model.VectorAssembler(inputCols=model.NUMERIC, outputCol="features")], 3, 1, ["grid_id", "hour"], "total").rows for df in (each, each.unionByName(each).unionByName(each)))
    assert once.count() == thrice.count() and thrice.agg(F.sum("m")).first()[0] == 900
    for drawn in (search._drawn(rows, search.BAGS, 20).groupBy("draw", "fold", "cell").agg(F.sum("n").alias("n")) for rows in (once, thrice)):
        assert drawn.count() > 20
    a, b = (search._drawn(rows, 0.8, 20).agg(F.sum("n"), F.sum("s")).first() for rows in (once, thrice))
    assert (3 * a[0], 3 * a[1]) == (b[0], b[1])


def test_training_rows_are_made_once(spark):
    named = spark.range(20).select("id", F.lit("x").alias("dayname"))
    frame = spark.range(20).select("id", *[F.col("id").cast("double").alias(c) for c in ("acs_cnt", "hour", "month", "is_weekend_group", "total")]).join(named, "id")
    found = model.model_rows(frame)
    assert found.count() == 19 and "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
