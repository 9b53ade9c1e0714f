"""Model, metrics and streaming queries."""

import json
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import inputs as I
from checks.registry import query
from checks.sensor_queries import CELL_COUNTS, FLOW_SLOTS, slot_text, training_of, with_slot_text
from citypulse.ml import model, quantile, search
from citypulse.ml.quantile import QuantileToNormal
from citypulse.session import cut_lineage, prepare, shared_dir
from citypulse.streaming import counts

KEYS = ["grid_id", "std_date"]


def scratch_folder(spark):
    """A fresh folder name below the shared one; Spark makes the folder."""
    return f"{shared_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex}"


def _rows(spark, sf_dir):
    return model.model_rows(training_of(spark, sf_dir))


@query(
    "regression_metrics",
    """
SELECT round(1 - sum(e * e) / sum((y - m) * (y - m)), 6) AS r2, round(sqrt(avg(e * e)), 4) AS rmse
FROM (SELECT l_extendedprice AS y, l_extendedprice - greatest(l_quantity * 1500 - 200, 0) AS e,
  (SELECT avg(l_extendedprice) FROM lineitem) AS m FROM lineitem) x""",
)
def regression_metrics(spark, sf_dir):
    rows = I.derived(
        spark, sf_dir, "SELECT l_extendedprice AS total, greatest(l_quantity * 1500 - 200, 0) AS predicted_total FROM lineitem"
    )
    found = model.regression_metrics(rows)
    return found.select(F.round("r2", 6).alias("r2"), F.round("rmse", 4).alias("rmse"))


@query(
    "split_is_whole_and_disjoint",
    "SELECT count(*) AS row_count, 0::bigint AS keys_on_both_sides, true AS share_near_80 FROM lineitem",
)
def split_is_whole_and_disjoint(spark, sf_dir):
    rows = I.derived(spark, sf_dir, "SELECT l_orderkey, l_linenumber FROM lineitem")
    train, test = model.split_by_key(rows, ["l_orderkey"])
    sides = train.withColumn("in_train", F.lit(1)).unionByName(test.withColumn("in_train", F.lit(0)))
    per_key = sides.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("in_train").alias("t"), F.countDistinct("in_train").alias("sides")
    )
    return per_key.agg(
        F.sum("n").alias("row_count"),
        F.count_if(F.col("sides") > 1).alias("keys_on_both_sides"),
        (F.abs(F.sum("t") / F.sum("n") - 0.8) < 0.05).alias("share_near_80"),
    )


TRAINING = f"""
SELECT c.grid_id, c.std_date, c.acs_cnt, f.total, dayname(c.std_date) AS dayname, hour(c.std_date) AS hour,
  cast(dayname(c.std_date) IN ('Friday', 'Saturday', 'Sunday') AS integer) AS weekend
FROM ({CELL_COUNTS}) c JOIN ({FLOW_SLOTS}) f ON c.grid_id = f.grid_id AND c.std_date = f.std_date
WHERE f.total IS NOT NULL AND f.admi_cd IS NOT NULL"""


@query(
    "encoded_features",
    f"""
WITH t AS ({TRAINING}), k AS (SELECT * FROM t WHERE total <= (SELECT quantile_cont(total, 0.995) FROM t)),
s AS (SELECT avg(acs_cnt) AS am, stddev_samp(acs_cnt) AS sd, avg(hour) AS hm, stddev_samp(hour) AS hs FROM k)
SELECT grid_id, strftime(std_date, '%Y-%m-%d %H:%M:%S') AS std_date,
  cast(dense_rank() OVER (ORDER BY dayname) - 1 AS double) AS dayname_encoded,
  round((acs_cnt - am) / sd, 5) AS acs_scaled, round((hour - hm) / hs, 5) AS hour_scaled, 0.0::double AS month_scaled,
  cast(1 - weekend AS double) AS weekday_hot, cast(weekend AS double) AS weekend_hot FROM k CROSS JOIN s""",
)
def encoded_features(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    prepared = Pipeline(stages=[model.day_index(), *model.scaled_features()]).fit(rows).transform(rows)
    names = ["acs_scaled", "hour_scaled", "month_scaled", "weekday_hot", "weekend_hot"]
    features = prepared.withColumn("_f", vector_to_array("features"))
    # The data are of one month, so the scaled month is 0 for every row.
    return features.select(
        "grid_id",
        slot_text("std_date").alias("std_date"),
        "dayname_encoded",
        *[F.round(F.col("_f")[i], 5).alias(n) for i, n in enumerate(names)],
    )


def _polynomial(coefficients, x):
    text = repr(coefficients[0]) + "::double"
    for c in coefficients[1:]:
        text = f"({text} * {x} + {c!r}::double)"
    return text


def _scores_sql(name, column):
    """Knots by rank, the place of a value among them, and the normal value of that place."""
    tail = f"{_polynomial(quantile._TAIL_TOP, 'r')} / {_polynomial(quantile._TAIL_BOTTOM, 'r')}"
    centre = f"{_polynomial(quantile._CENTRE_TOP, '(d * d)')} * d / {_polynomial(quantile._CENTRE_BOTTOM, '(d * d)')}"
    return f"""
{name}_s AS (SELECT {column}::double AS v, row_number() OVER (ORDER BY {column}) - 1 AS r, count(*) OVER () AS n FROM k),
{name}_i AS (SELECT n, least(n, {quantile.MAX_KNOTS}) AS c, unnest(range(least(n, {quantile.MAX_KNOTS}))) AS i FROM (SELECT DISTINCT n FROM {name}_s) x),
{name}_k AS (SELECT i, c, a.v + (coalesce(b.v, a.v) - a.v) * ((i * (p.n - 1)) % (c - 1)) / (c - 1)::double AS v FROM {name}_i p
  JOIN {name}_s a ON a.r = (i * (p.n - 1)) // (c - 1) LEFT JOIN {name}_s b ON b.r = (i * (p.n - 1)) // (c - 1) + 1),
{name}_u AS (SELECT x, count(*) FILTER (v < x) AS lo, count(*) FILTER (v <= x) AS hi, max(c) AS c, min(v) AS least, max(v) AS most,
  max(v) FILTER (v <= x) AS below, min(v) FILTER (v > x) AS above FROM (SELECT DISTINCT v AS x FROM {name}_s) d CROSS JOIN {name}_k GROUP BY x),
{name}_p AS (SELECT x, least(greatest(CASE WHEN x <= least THEN 0.0::double WHEN x >= most THEN 1.0 WHEN hi > lo THEN (lo + hi - 1) / 2.0::double / (c - 1)
  ELSE (hi - 1 + (x - below) / (above - below)) / (c - 1) END, {quantile.TAIL!r}), {1 - quantile.TAIL!r}) AS p FROM {name}_u),
{name} AS (SELECT x, round(CASE WHEN p < {quantile._TAIL_FROM} OR p > {1 - quantile._TAIL_FROM} THEN CASE WHEN p < 0.5 THEN 1 ELSE -1 END * ({tail}) ELSE {centre} END, 6) AS score
  FROM (SELECT x, p, p - 0.5 AS d, sqrt(-2 * ln(least(p, 1 - p))) AS r FROM {name}_p) y)"""


@query(
    "normal_scores",
    f"""
WITH t AS ({TRAINING}), k AS (SELECT *, month(std_date) AS month FROM t WHERE total <= (SELECT quantile_cont(total, 0.995) FROM t)),
{_scores_sql('a', 'acs_cnt')}, {_scores_sql('h', 'hour')}, {_scores_sql('m', 'month')}
SELECT grid_id, strftime(std_date, '%Y-%m-%d %H:%M:%S') AS std_date, a.score AS a, h.score AS h, m.score AS m
FROM k JOIN a ON a.x = k.acs_cnt JOIN h ON h.x = k.hour JOIN m ON m.x = k.month""",
)
def normal_scores(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    fitted = QuantileToNormal(inputCols=model.NUMERIC, outputCols=["a", "h", "m"]).fit(rows)
    scored = with_slot_text(fitted.transform(rows).select("grid_id", "std_date", "a", "h", "m"))
    return scored.withColumns({c: F.round(c, 6) for c in ("a", "h", "m")})


#: The searches of the library: features, kind and whole grid.
SEARCHES = {
    "boosted": (model.scaled_features, search.Family(search.BOOSTED, model.BOOSTED_GRID)),
    "boosted_on_scores": (model.quantile_features, search.Family(search.BOOSTED, model.QUANTILE_BOOSTED_GRID)),
    "forest": (model.scaled_features, search.Family(search.FOREST, search.FOREST_SETTINGS)),
}
# The settings that the stored model was trained with.
STORED = {"maxIter": 200, "maxDepth": 4, "stepSize": 0.05, "subsamplingRate": 1.0}
KIND = "gradient-boosted trees on normal scores"


def _found(train, name):
    features, family = SEARCHES[name]
    return search.search(train, features(), family, KEYS)


def _split(spark, sf_dir):
    rows = cut_lineage(_rows(spark, sf_dir))
    return rows, *model.split_by_key(rows, KEYS)


_KEPT = f"(SELECT * FROM ({TRAINING}) t WHERE total <= (SELECT quantile_cont(total, 0.995) FROM ({TRAINING}) u))"


@query(
    "forest_and_boosted_compared",
    f"""
SELECT name, settings_tried::bigint AS settings_tried, count(*) AS rows_scored, 0::bigint AS rows_below_zero, true AS scores_possible, true AS errors_ordered
FROM (VALUES ('boosted', 36), ('boosted_on_scores', 24), ('forest', 18)) AS m(name, settings_tried) CROSS JOIN {_KEPT} k GROUP BY ALL""",
)
def forest_and_boosted_compared(spark, sf_dir):
    """Three searches over their whole grids; the better r2 has the smaller error on the rows kept for the test."""
    rows, train, test = _split(spark, sf_dir)
    found = {name: _found(train, name) for name in SEARCHES}
    table = model.comparison(spark, {name: model.predict(f.model, test) for name, f in found.items()})
    scores = cut_lineage(table.withColumn("place", F.row_number().over(Window.orderBy(F.desc("r2")))))
    ordered = scores.agg(F.sort_array(F.collect_list(F.struct("place", "rmse"))).alias("by_r2")).select(
        F.forall(F.sequence(F.lit(1), F.size("by_r2") - 1), lambda i: F.get("by_r2", i)["rmse"] >= F.get("by_r2", i - 1)["rmse"]).alias("errors_ordered")
    )
    counts_ = None
    for name, f in found.items():
        own = model.predict(f.model, rows).agg(F.count("predicted_total").alias("rows_scored"), F.count_if(F.col("predicted_total") < 0).alias("rows_below_zero"))
        own = own.select(F.lit(name).alias("name"), F.lit(len(f.scores)).cast("long").alias("settings_tried"), "*")
        counts_ = own if counts_ is None else counts_.unionByName(own)
    checked = scores.select("name", ((F.col("r2") <= 1) & (F.col("rmse") >= 0)).alias("scores_possible"))
    return counts_.join(checked, "name").withColumn("errors_ordered", ordered.scalar())


@query(
    "stacked_predictions",
    f"SELECT grid_id, strftime(std_date, '%Y-%m-%d %H:%M:%S') AS std_date, total, true AS within_totals FROM {_KEPT} k",
)
def stacked_predictions(spark, sf_dir):
    """A prediction of the stack for every row: a mean of totals, so never outside them."""
    rows, train, _ = _split(spark, sf_dir)
    bases = {"by_forest": (search.FOREST, _found(train, "forest").settings), "by_boosted": (search.BOOSTED, _found(train, "boosted").settings)}
    stacked = search.stack(train, model.scaled_features(), bases, KEYS)
    ends = train.agg(F.struct(F.min("total").alias("low"), F.max("total").alias("high")))
    close = F.lit(1e-6) * F.greatest(F.abs(ends.scalar()["low"]), F.abs(ends.scalar()["high"]))
    within = F.col("predicted_total").between(ends.scalar()["low"] - close, ends.scalar()["high"] + close)
    return model.predict(stacked, rows).select("grid_id", slot_text("std_date").alias("std_date"), "total", F.coalesce(within, F.lit(False)).alias("within_totals"))


@query(
    "feature_importance",
    """
SELECT feature, 1.0::double AS total_share, true AS share_possible
FROM (VALUES ('acs_cnt_score'), ('hour_score'), ('month_score'), ('is_weekend_group_hot_0'), ('is_weekend_group_hot_1')) AS f(feature)""",
)
def feature_importance(spark, sf_dir):
    """Every feature has a share of the gain, and all shares are one."""
    rows, train, _ = _split(spark, sf_dir)
    table = model.feature_importance(spark, _found(train, "boosted_on_scores").model, rows)
    total = table.agg(F.round(F.sum("importance"), 6))
    return table.select("feature", total.scalar().alias("total_share"), F.col("importance").between(0, 1).alias("share_possible"))


def _stored(spark, sf_dir):
    """A model of fixed settings, trained, stored with its figures and read again."""
    rows, train, test = _split(spark, sf_dir)
    one = search.Family(search.BOOSTED, {name: [value] for name, value in STORED.items()})
    found = search.search(train, model.quantile_features(), one, KEYS)
    path = f"{scratch_folder(spark)}/model"
    metrics = model.regression_metrics(model.predict(found.model, test)).first().asDict()
    model.save_bundle(found.model, path, found.settings, metrics, KIND)
    return rows, found.model, *model.load_bundle(spark, path)


@query(
    "model_stored_and_loaded",
    f"""
SELECT '{KIND}' AS model_type, '{json.dumps(STORED)}' AS best_params, 'acs_cnt,hour,month,is_weekend_group' AS features,
  count(*) AS rows_scored, 0::bigint AS rows_changed FROM {_KEPT} k""",
)
def model_stored_and_loaded(spark, sf_dir):
    """The stored model predicts what the trained one does, and its entry says what it is."""
    rows, trained, loaded, entry = _stored(spark, sf_dir)
    both = model.predict(trained, rows).withColumnRenamed("predicted_total", "before")
    both = model.predict(loaded, both)
    changed = F.count_if(~F.col("before").eqNullSafe(F.col("predicted_total")))
    return both.agg(F.count("predicted_total").alias("rows_scored"), changed.alias("rows_changed")).select(
        F.lit(entry["model_type"]).alias("model_type"), F.lit(entry["best_params"]).alias("best_params"), F.lit(",".join(entry["features"])).alias("features"), "*"
    )


@query(
    "latest_slot_scored",
    f"""
SELECT grid_id, strftime(std_date, '%Y-%m-%d %H:%M:%S') AS std_date, acs_cnt, true AS not_negative FROM ({CELL_COUNTS}) c
WHERE std_date = (SELECT max(std_date) FROM ({I.AP_SUMMARY}) s)""",
)
def latest_slot_scored(spark, sf_dir):
    """The newest slot, scored by the stored model."""
    _, _, loaded, _ = _stored(spark, sf_dir)
    summary, cells = I.derived(spark, sf_dir, I.AP_SUMMARY), I.derived(spark, sf_dir, I.AP_CELL)
    scored = with_slot_text(model.score_latest(summary, cells, loaded))
    return scored.select("grid_id", "std_date", "acs_cnt", F.coalesce(F.col("predicted_total") >= 0, F.lit(False)).alias("not_negative"))


@query(
    "streamed_scores",
    f"SELECT grid_id, strftime(std_date, '%Y-%m-%d %H:%M:%S') AS std_date, acs_cnt, 1::bigint AS copies, true AS not_negative FROM ({CELL_COUNTS}) c",
)
def streamed_scores(spark, sf_dir):
    """Slots scored as a stream that is stopped, gets late rows of slots it has scored, and goes on from its checkpoint."""
    _, _, loaded, _ = _stored(spark, sf_dir)
    root = scratch_folder(spark)
    cells = cut_lineage(I.derived(spark, sf_dir, I.AP_CELL))
    part = I.AP_SUMMARY.replace("FROM events", "FROM events WHERE event_id % 3 = {0}")
    score = counts.slot_scorer(cells, loaded)
    for late in ((0, 1), (2,)):
        for k in late:
            I.derived(spark, sf_dir, part.format(k)).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema("std_date timestamp, ap_id bigint, cnt bigint").parquet(f"{root}/in")
        writer = counts.merge_scores(stream, score, f"{root}/out", f"{root}/state")
        writer.trigger(availableNow=True).start().awaitTermination()
    kind = "grid_id string, std_date timestamp, predicted_total double, acs_cnt bigint"
    found = spark.read.schema(kind).parquet(f"{root}/out/scores")
    each = with_slot_text(found).groupBy("grid_id", "std_date", "acs_cnt").agg(
        F.count(F.lit(1)).alias("copies"), F.bool_and(F.coalesce(F.col("predicted_total") >= 0, F.lit(False))).alias("not_negative")
    )
    return each.select("grid_id", "std_date", "acs_cnt", "copies", "not_negative")


for _minutes in counts.GRAINS:

    @query(
        f"stream_counts_{_minutes}min",
        f"""
SELECT strftime(std_date, '%Y-%m-%d %H:%M:%S') AS std_date, ap_id, cnt FROM (
  SELECT time_bucket(INTERVAL '{_minutes} minutes', ts) AS std_date, event_id % 197 AS ap_id, count(*) AS cnt FROM events GROUP BY 1, 2) w
WHERE std_date + INTERVAL '{_minutes} minutes' <= (SELECT max(date_trunc('milliseconds', ts)) FROM events) - INTERVAL '10 minutes'""",
    )
    def stream_counts(spark, sf_dir, minutes=_minutes):
        prepare(spark)
        events = (
            spark.readStream.schema(I.TABLE_SCHEMAS["events"])
            .option("pathGlobFilter", "events.parquet")
            .parquet(sf_dir)
            .select(F.col("ts").cast("timestamp").alias("ts"), (F.col("event_id") % 197).alias("ap_id"))
        )
        root = scratch_folder(spark)
        closed = counts.window_counts(events, minutes)
        run = counts.to_table(closed, f"{root}/out", f"{root}/state").trigger(availableNow=True).start()
        run.awaitTermination()
        return with_slot_text(spark.read.schema("std_date timestamp, ap_id bigint, cnt bigint").parquet(f"{root}/out"))


@query(
    "batch_counts_10min",
    """
SELECT strftime(time_bucket(INTERVAL '10 minutes', ts), '%Y-%m-%d %H:%M:%S') AS std_date, event_id % 197 AS ap_id, count(*) AS cnt
FROM events GROUP BY 1, 2""",
)
def batch_counts_10min(spark, sf_dir):
    events = I.derived(spark, sf_dir, "SELECT ts, event_id % 197 AS ap_id FROM events")
    return with_slot_text(counts.window_counts(events, 10))
