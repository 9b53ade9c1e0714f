"""Plans at a size where nothing fits a broadcast: hot keys are split, nothing is broadcast unchecked."""

import contextlib
import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from citypulse.operators import economy, lookup, paths, presence, sensors, spatial

# No join may broadcast, and partitions count as skewed from a few kilobytes on.
LARGE_DATA = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def partition_sizes(df, used):
    """Rows of each partition. The column ``used`` keeps the join that makes it in the plan."""
    return [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.max(used)).collect()]


def hot(column, n=20_000):
    """A key column in which one value holds a third of the rows."""
    return F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997).alias(column)


def test_hot_merchant_is_split_in_row_level_lookup(spark):
    rows = spark.range(0, 20_000, 1, 8).select(
        F.col("id").alias("pay_no"), F.lit("2025-01-02").alias("pay_date"), hot("merchant").cast("string").alias("merchant"),
        F.lit("x").alias("ind_type"), F.lit(1).alias("amount"), F.concat(F.lit("1990010"), F.col("id") % 9 + 1).alias("birth"),
    )
    cells = spark.range(997).select(F.col("id").cast("string").alias("merchant"), F.col("id").cast("string").alias("grid_id"))
    with settings(spark, LARGE_DATA):
        sizes = partition_sizes(economy.payments_with_age(rows, cells), "grid_id")
    # A third of the rows has one merchant: no task of the join gets much more than an even share.
    assert sum(sizes) == 20_000 and max(sizes) <= 2.2 * 20_000 / 8


def test_hot_access_point_is_split_before_an_aggregate(spark):
    rows = spark.range(0, 20_000, 1, 8).select(
        (F.lit("2025-01-01").cast("timestamp") + F.make_dt_interval(secs=F.col("id"))).alias("std_date"),
        hot("ap_id"), F.lit(1).alias("cnt"),
    )
    for kind in ("int", "bigint"):
        cells = spark.range(997).select(F.col("id").cast(kind).alias("ap_id"), F.lit("c").alias("grid_id"))
        with settings(spark, LARGE_DATA):
            found = sensors.cell_counts(rows, cells)
            plan = executed(found)
            joined = lookup.map_column(rows, "ap_id", cells, "ap_id", "grid_id", "grid_id", split_hot=True)
            sizes = partition_sizes(joined, "grid_id")
        assert "_part" in plan and max(sizes) <= 2.2 * 20_000 / 8
        assert found.agg(F.sum("acs_cnt")).first()[0] == 20_000


@pytest.mark.parametrize("kind, other", [("string", "string"), ("bigint", "bigint"), ("bigint", "int"), ("int", "string")])
def test_hot_and_missing_keys_are_dealt_out_whatever_the_plan(spark, kind, other):
    """A third of the rows with one key and a third with none: no partition of the join has much more than its share."""
    n, third = 24_000, F.col("id") % 3
    key = F.when(third == 0, F.lit(7)).when(third == 1, F.col("id") % 997)
    rows = spark.range(0, n, 1, 8).select("id", key.cast(kind).alias("k"), F.lit("same").alias("note"))
    pairs = spark.range(0, 900).select(F.col("id").cast(other).alias("key"), (F.col("id") * 10).alias("v"))
    plain = {**{k: v for k, v in LARGE_DATA.items() if "Broadcast" in k}, "spark.sql.adaptive.enabled": "false"}
    with settings(spark, plain):
        found = lookup.map_column(rows, "k", pairs, "key", "v", "v", split_hot=True)
        sizes = partition_sizes(found, "v")
        assert sum(sizes) == n and max(sizes) <= 2.2 * n / 8
        whole = lookup.map_column(rows, "k", pairs, "key", "v", "v")
        uneven = partition_sizes(whole, "v")
        assert max(uneven) > 2.2 * n / 8
        assert found.columns == whole.columns and found.exceptAll(whole).count() == 0 and whole.exceptAll(found).count() == 0
        assert found.filter("v is null").count() > n / 3 and found.filter("v = 70").count() > n / 3


def test_equal_rows_of_a_hot_key_are_dealt_out_by_task(spark):
    rows = spark.range(0, 8000, 1, 8).select(F.lit("a").alias("k"))
    pairs = spark.createDataFrame([("a", 1), ("b", 2)], "key string, v int")
    found = lookup.map_column(rows, "k", pairs, "key", "v", "v", split_hot=True)
    assert found.filter("v = 1").count() == 8000
    assert lookup.hot_keys(rows, "k") == {"a": 8} and lookup.hot_keys(rows.limit(0), "k") == {}
    assert lookup.map_column(rows.limit(0), "k", pairs, "key", "v", "v", split_hot=True).count() == 0


def test_hot_merchant_is_summed_before_the_join(spark):
    rows = spark.range(0, 20_000, 1, 8).select(
        F.col("id").alias("pay_no"), F.lit(dt.date(2025, 1, 2)).alias("pay_date"), hot("merchant").cast("string").alias("merchant"),
        F.lit("x").alias("ind_type"), F.lit(1).alias("amount"),
    )
    cells = spark.range(997).select(F.col("id").cast("string").alias("merchant"), F.lit("c").alias("grid_id"))
    found = economy.payments_by_cell(rows, cells)
    assert [tuple(r) for r in found.collect()] == [("c", "202501", "x", 20_000, 20_000)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "count(" in plan.split("Join", 1)[1], "the payments are counted under the join"


def test_many_equal_points_are_tested_once(spark):
    points = spark.range(0, 30_000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 100).alias("x"), F.lit(5).alias("y"))
    square = spark.createDataFrame([("p", 0, 0, 50, 0), ("p", 50, 0, 50, 50), ("p", 50, 50, 0, 50), ("p", 0, 50, 0, 0)],
                                   "poly_id string, x1 int, y1 int, x2 int, y2 int")
    assert spatial.points_in_polygons(points, square, 10).count() == 51
    with settings(spark, LARGE_DATA):
        located = spatial.locate(points, square, 10)
        plan = executed(located)
    assert "skew=true" in plan
    assert located.count() == 30_000


def test_busy_device_costs_one_row_per_task(spark):
    log = spark.range(0, 50_000, 1, 8).select(
        hot("client_mac_addr").cast("string").alias("client_mac_addr"),
        (F.lit("2025-07-01").cast("timestamp") + F.make_dt_interval(secs=F.col("id") * 50)).alias("logging_date"),
        F.lit("join").alias("event_name"),
    )
    plan = executed(presence.longest_runs(presence.visits(log)))
    final = plan.split("Initial Plan")[0]
    assert final.count("Exchange hashpartitioning") == 1 and "Window" not in final and "partial_bit_or" in final


def test_path_numbering_never_sorts_a_whole_device(spark):
    df = spark.createDataFrame([("d", dt.datetime(2025, 7, 1), 1.0, 2.0)], "client_mac_addr string, logging_date timestamp, lon double, lat double")
    plan = paths.path_points(df)._jdf.queryExecution().optimizedPlan().toString()
    numbering = [line for line in plan.split("\n") if "row_number()" in line and "Window" in line]
    assert numbering and all("_chunk" in line.split("row_number()")[1] for line in numbering)


# One row per calendar month is the only thing broadcast whatever its origin.
CALENDAR = {"presence_stay_category", "presence_stay_category_all_kinds", "stay_category_pivot", "visits_by_category_and_place"}


@pytest.mark.parametrize("name", sorted(set(spark_entry.oracle_sql()) - {"regression_metrics"}))
def test_nothing_is_broadcast_without_a_size_check(spark, name):
    with settings(spark, {k: v for k, v in LARGE_DATA.items() if "Broadcast" in k}):
        plan = spark_entry.queries()[name](spark, spark_entry.SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan or name in CALENDAR
