"""People per cell and slot from access counts: features, models, evaluation, storage, scoring."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.functions.values import clip_at_zero
from citypulse.ml.quantile import QuantileToNormal
from citypulse.operators.lookup import latest_snapshot
from citypulse.operators.sensors import cell_counts, trim_upper, with_calendar
from citypulse.session import cut_lineage

# Features, target and the searched settings.
NUMERIC = ["acs_cnt", "hour", "month"]
CATEGORICAL = "is_weekend_group"
LABEL = "total"
FOREST_GRID = {"numTrees": [100, 200, 300], "maxDepth": [5, 10, 15], "minInstancesPerNode": [1, 2]}
BOOSTED_GRID = {"maxIter": [200, 300], "maxDepth": [4, 6, 8], "stepSize": [0.05, 0.1, 0.2], "subsamplingRate": [0.8, 1.0]}
QUANTILE_BOOSTED_GRID = {"maxIter": [200, 300], "maxDepth": [4, 6, 8], "stepSize": [0.05, 0.1], "subsamplingRate": [0.8, 1.0]}
FOLDS = 3
STACK_FOLDS = 5
SEED = 42


def model_rows(frame: DataFrame, upper: float = 0.995) -> DataFrame:
    """Training rows without the topmost totals, typed for the feature stages. The frame is made once for all passes over them."""
    return trim_upper(cut_lineage(frame), LABEL, upper).withColumns(
        {name: F.col(name).cast("double") for name in [*NUMERIC, CATEGORICAL, LABEL]}
    )


def split_by_key(df: DataFrame, keys: list[str], share: float = 0.8, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a hash of their key.

    The same row always falls on the same side, whatever the partitioning, and rows with equal keys stay together.
    """
    place = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1_000_000))
    cut = F.lit(round(share * 1_000_000))
    return df.filter(place < cut), df.filter(place >= cut)


def day_index() -> StringIndexer:
    """Index of the day name; a day not seen in training gets an index of its own."""
    return StringIndexer(
        inputCol="dayname", outputCol="dayname_encoded", stringOrderType="alphabetAsc", handleInvalid="keep"
    )


def _category() -> OneHotEncoder:
    # 'keep' adds a last place for unseen values and dropLast drops it: they become all zeros.
    return OneHotEncoder(inputCols=[CATEGORICAL], outputCols=[CATEGORICAL + "_hot"], handleInvalid="keep", dropLast=True)


def scaled_features() -> list:
    """Stages: numbers to zero mean and unit variance, the category one-hot."""
    return [
        VectorAssembler(inputCols=NUMERIC, outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
        _category(),
        VectorAssembler(inputCols=["scaled", CATEGORICAL + "_hot"], outputCol="features"),
    ]


def quantile_features() -> list:
    """Stages: numbers to normal scores, the category one-hot."""
    scores = [name + "_score" for name in NUMERIC]
    return [
        QuantileToNormal(inputCols=NUMERIC, outputCols=scores),
        _category(),
        VectorAssembler(inputCols=[*scores, CATEGORICAL + "_hot"], outputCol="features"),
    ]


def forest(**settings) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=LABEL, seed=SEED, **settings)


def boosted(loss: str = "squared", **settings) -> GBTRegressor:
    """Gradient-boosted trees. ``absolute`` loss stands in for losses between squared and absolute."""
    return GBTRegressor(labelCol=LABEL, seed=SEED, lossType=loss, **settings)


def tune(train: DataFrame, features: list, regressor, grid: dict[str, list], folds: int = FOLDS, parallelism: int = 4, keys: list[str] | None = None):
    """Best pipeline by r2 over the grid, by cross-validation, and its settings.

    The feature stages are fitted once on the training rows; the folds and settings then differ
    only in the regressor. Folds come from a hash of ``keys`` (all columns if not given), so they do not
    change with the partitioning and rows with equal keys are never on both sides.
    """
    prepared = Pipeline(stages=features).fit(train)
    fold = F.pmod(F.xxhash64(F.lit(SEED + 2), *(keys or train.columns)), F.lit(folds)).cast("int")
    rows = prepared.transform(train.withColumn("_fold", fold)).select("features", LABEL, "_fold").persist()
    try:
        builder = ParamGridBuilder()
        for name, values in grid.items():
            builder = builder.addGrid(regressor.getParam(name), values)
        search = CrossValidator(
            estimator=regressor,
            estimatorParamMaps=builder.build(),
            evaluator=RegressionEvaluator(labelCol=LABEL, metricName="r2"),
            numFolds=folds,
            parallelism=parallelism,
            seed=SEED,
            foldCol="_fold",
        )
        found = search.fit(rows)
    finally:
        rows.unpersist()
    best = found.bestModel
    chosen = {name: best.getOrDefault(best.getParam(name)) for name in grid}
    return PipelineModel(stages=[prepared, best]), chosen


def stack(train: DataFrame, features: list, bases: dict, keys: list[str], final=None, folds: int = STACK_FOLDS) -> PipelineModel:
    """Final model on out-of-fold predictions of the base regressors; bases are then fitted on all rows.

    Folds come from a hash of the key. The result is one pipeline: features, bases, final model.
    """
    final = final or forest(numTrees=150, maxDepth=5)
    prepared = Pipeline(stages=features).fit(train)
    fold = F.pmod(F.xxhash64(F.lit(SEED + 1), *keys), F.lit(folds))
    rows = prepared.transform(train).select("features", LABEL, fold.alias("_fold")).persist()
    try:
        named = {name: base.copy({base.predictionCol: name}) for name, base in bases.items()}
        parts = []
        for k in range(folds):
            part = rows.filter(F.col("_fold") == k)
            for base in named.values():
                part = base.fit(rows.filter(F.col("_fold") != k)).transform(part)
            parts.append(part.select(*named, LABEL))
        held_out = parts[0]
        for part in parts[1:]:
            held_out = held_out.unionByName(part)
        joined = VectorAssembler(inputCols=list(named), outputCol="base_predictions")
        last = final.copy({final.featuresCol: "base_predictions"}).fit(joined.transform(held_out))
        fitted = [base.fit(rows) for base in named.values()]
    finally:
        rows.unpersist()
    return PipelineModel(stages=[prepared, *fitted, joined, last])


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with ``predicted_total``, never negative."""
    typed = rows.withColumns({f"_{n}": F.col(n) for n in [*NUMERIC, CATEGORICAL]}).withColumns(
        {n: F.col(n).cast("double") for n in [*NUMERIC, CATEGORICAL]}
    )
    scored = model.transform(typed).withColumn("predicted_total", clip_at_zero(F.col("prediction")))
    kept = [F.col("_" + n).alias(n) if n in (*NUMERIC, CATEGORICAL) else F.col(n) for n in rows.columns]
    return scored.select(*kept, "predicted_total")


def regression_metrics(df: DataFrame, label: str = LABEL, prediction: str = "predicted_total") -> DataFrame:
    """One row: r2 and rmse, over the rows that have both a label and a prediction."""
    df = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    error = F.col(label) - F.col(prediction)
    squared = F.sum(error * error)
    return df.agg(
        (F.lit(1.0) - squared / (F.var_pop(label) * F.count(label))).alias("r2"),
        F.sqrt(squared / F.count(label)).alias("rmse"),
    )


def comparison(spark: SparkSession, scored: dict[str, DataFrame]) -> DataFrame:
    """r2 and rmse per model, best first."""
    frames = [regression_metrics(df).select(F.lit(name).alias("name"), "r2", "rmse") for name, df in scored.items()]
    table = frames[0]
    for frame in frames[1:]:
        table = table.unionByName(frame)
    return table.orderBy(F.desc("r2"))


def feature_importance(spark: SparkSession, model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Importance per feature, highest first. One row per feature, so it is made on the driver; ``rows``
    only lend their schema.
    """
    last = model.stages[-1]
    column = last.getOrDefault(last.featuresCol)
    attributes = model.transform(rows).schema[column].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a.get("name", str(a["idx"])) for group in attributes.values() for a in group}
    weights = last.featureImportances.toArray()
    entries = [(names.get(i, str(i)), float(w)) for i, w in enumerate(weights)]
    return spark.createDataFrame(entries, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def save_bundle(model: PipelineModel, path: str, settings: dict, metrics: dict, kind: str) -> None:
    """Model and a one-row table of what it is: time, kind, settings, metrics, features."""
    spark = SparkSession.getActiveSession()
    model.write().overwrite().save(f"{path}/model")
    entry = {
        "trained_at": datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"),
        "model_type": kind,
        "best_params": json.dumps(settings),
        "r2": float(metrics["r2"]),
        "rmse": float(metrics["rmse"]),
        "features": [*NUMERIC, CATEGORICAL],
    }
    schema = "trained_at string, model_type string, best_params string, r2 double, rmse double, features array<string>"
    spark.createDataFrame([entry], schema).coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def load_bundle(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    return PipelineModel.load(f"{path}/model"), spark.read.json(f"{path}/metadata").first().asDict()


def score_counts(counts: DataFrame, model: PipelineModel) -> DataFrame:
    """Prediction per cell and slot: ``grid_id, std_date, predicted_total, acs_cnt``."""
    scored = predict(model, with_calendar(counts))
    return scored.select("grid_id", "std_date", "predicted_total", "acs_cnt")


def score_latest(summary: DataFrame, ap_cells: DataFrame, model: PipelineModel) -> DataFrame:
    """Predictions for the newest slot of the access-point summary."""
    newest = latest_snapshot(summary, "std_date")
    return score_counts(cell_counts(newest, ap_cells), model)


def score_since(summary: DataFrame, ap_cells: DataFrame, model: PipelineModel, first_day: str) -> DataFrame:
    """Predictions for every slot from a day on."""
    recent = summary.filter(F.to_date("std_date") >= F.lit(first_day).cast("date"))
    return score_counts(cell_counts(recent, ap_cells), model)
