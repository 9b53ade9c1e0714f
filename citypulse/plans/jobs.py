"""End-to-end jobs: read, compute in one plan, write the result tables under a root folder."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citypulse.ml import model, search
from citypulse.operators import economy, flow, paths, presence, residents, sensors, spatial
from citypulse.schemas import BUSINESS_FILE, FLOW_FILE, INDUSTRY_FILE, PAYMENT_FILE, RESULT_TABLES
from citypulse.session import cut_lineage
from citypulse.sources import editions, files, sinks

# Name patterns of the input files.
FLOW_PATTERN = "*flow_age_time*{ym}*.csv"
BUSINESS_PATTERN = "*SOHO_STAT_*"
INDUSTRY_PATTERN = "*IND_CODE*"
PAYMENT_PATTERN = "local_pay_*"
#: Folder of the reports that are published together.
REPORTS = "reports"
ECONOMY_TARGETS = ["kcb", "local", "all", "local2"]


def _result(df: DataFrame, table: str) -> DataFrame:
    schema, required = RESULT_TABLES[table]
    return sinks.conform(sinks.require(df, required), schema)


def load_flow(spark: SparkSession, source: str, ym: str, root: str) -> None:
    """Newest flow file of a month into the flow table; every row goes to its own month."""
    newest = files.newest_file(spark, source, FLOW_PATTERN.format(ym=ym))
    mart = flow.normalize_flow(files.read_delimited(spark, newest, FLOW_FILE))
    mart = flow.with_month(_result(mart, "flow"))
    sinks.write_months(mart, f"{root}/flow", sort=["etl_ymd", "timezn_cd", "id"])


def read_flow(spark: SparkSession, root: str) -> DataFrame:
    """The flow table with its month column, which Spark would otherwise read as a number."""
    month = T.StructField("crtr_ym", T.StringType())
    return spark.read.schema(T.StructType([*RESULT_TABLES["flow"][0].fields, month])).parquet(f"{root}/flow")


def flow_reports(spark: SparkSession, ym: str, root: str) -> None:
    """The four month reports, for readers all or none. The month is scanned once; reports come from its sums."""
    sums = cut_lineage(flow.month_sums(read_flow(spark, root), ym))
    reports = {name: _result(report(sums, ym), name) for name, report in flow.MONTH_REPORTS.items()}
    editions.write_months(reports, f"{root}/{REPORTS}")


def read_report(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A month report as it was last published."""
    return editions.read(spark, f"{root}/{REPORTS}", name, RESULT_TABLES[name][0])


def flow_month(spark: SparkSession, source: str, ym: str, root: str) -> None:
    load_flow(spark, source, ym, root)
    flow_reports(spark, ym, root)


def economy_tables(spark: SparkSession, source: str, target: str, root: str) -> None:
    """Business statistics (``kcb``), payments by cell (``local``), both (``all``), payments by row (``local2``)."""
    if target not in ECONOMY_TARGETS:
        raise ValueError(f"target must be one of {ECONOMY_TARGETS}")
    if target in ("kcb", "all"):
        stats = files.read_delimited(spark, files.newest_file(spark, source, BUSINESS_PATTERN), BUSINESS_FILE)
        names = files.read_delimited(spark, files.newest_file(spark, source, INDUSTRY_PATTERN), INDUSTRY_FILE)
        rows = sinks.stamp(economy.business_stats(stats, names))
        sinks.append(_result(rows, "business_stats"), f"{root}/business_stats")
    if target in ("local", "all", "local2"):
        paid = files.read_delimited(spark, files.newest_file(spark, source, PAYMENT_PATTERN), PAYMENT_FILE, sep=",")
        paid = economy.rename_payment_file(paid)
        cells = files.read_lookup_json(spark, f"{source}/json/local_grid_id.json").withColumnsRenamed(
            {"key": "merchant", "value": "grid_id"}
        )
        if target == "local2":
            sinks.append(sinks.stamp(economy.payments_with_age(paid, cells)), f"{root}/payments")
        else:
            rows = sinks.stamp(economy.payments_by_cell(paid, cells))
            sinks.append(_result(rows, "payments_by_cell"), f"{root}/payments_by_cell")


def resident_tables(
    tables: dict[str, DataFrame], root: str, as_of_date: dt.date, as_of: str | None = None
) -> None:
    """Households, movers in, movers out and residents by cell; each table is replaced.

    ``tables``: heads, members, moves_in, moves_out, addresses(addr_id, address), address_grid(address, grid_id).
    """
    cells = cut_lineage(residents.address_cells(tables["addresses"], tables["address_grid"]))
    sizes = residents.household_sizes(tables["heads"], tables["members"], as_of)
    results = {
        "households_by_cell": residents.households_by_cell(sizes, cells),
        "movers_in_by_cell": residents.movers_by_cell(tables["moves_in"], residents.IN_PREFIX, cells, as_of_date, as_of),
        "movers_out_by_cell": residents.movers_by_cell(
            tables["moves_out"], residents.OUT_PREFIX, cells, as_of_date, as_of
        ),
        "residents_by_cell": residents.residents_by_cell(
            tables["members"], tables["heads"], cells, as_of_date, as_of
        ),
    }
    for name, df in results.items():
        sinks.replace(df, f"{root}/{name}")


def presence_tables(described: DataFrame, root: str) -> None:
    """Stats, stay categories, their pivot, visits by place, and paths (their points in order) from a described log."""
    rows = presence.visits(described)
    # One row per device and day serves the stats and the categories: the log is scanned once for both.
    daily = cut_lineage(presence.daily_counts(rows))
    sinks.replace(presence.device_stats(daily), f"{root}/device_stats")
    sinks.replace(presence.stay_categories_of_days(daily), f"{root}/device_months")
    categories = rows.sparkSession.read.parquet(f"{root}/device_months")
    sinks.replace(presence.category_pivot(categories), f"{root}/category_months")
    sinks.replace(presence.visits_by_place(rows, categories), f"{root}/visits_by_place")
    sinks.replace(paths.path_points(rows), f"{root}/paths")
    sinks.replace(paths.path_kinds(rows), f"{root}/path_kinds")


def train_model(
    summary: DataFrame, ap_cells: DataFrame, flow_raw: DataFrame, path: str, grid: dict | None = None
) -> dict:
    """Tune boosted trees on normal scores, store model and metrics, return the metrics."""
    counts = sensors.cell_counts(summary, ap_cells)
    rows = cut_lineage(model.model_rows(sensors.training_frame(counts, sensors.flow_slots(flow_raw))))
    keys = ["grid_id", "std_date"]
    train, test = model.split_by_key(rows, keys)
    family = search.Family(search.BOOSTED, grid or model.QUANTILE_BOOSTED_GRID)
    found = search.search(train, model.quantile_features(), family, keys)
    metrics = model.regression_metrics(model.predict(found.model, test)).first().asDict()
    model.save_bundle(found.model, path, found.settings, metrics, "gradient-boosted trees on normal scores")
    return metrics


def prediction_rows(scored: DataFrame) -> DataFrame:
    """Scored slots in the shape of the prediction table: whole people, stamped."""
    whole = scored.withColumn("predicted_total", F.round("predicted_total").cast("int"))
    return _result(sinks.stamp(whole), "cell_predictions")


def score_newest_slot(summary: DataFrame, ap_cells: DataFrame, model_path: str, root: str) -> None:
    """Append predictions of the newest slot."""
    fitted, _ = model.load_bundle(summary.sparkSession, model_path)
    sinks.append(prediction_rows(model.score_latest(summary, ap_cells, fitted)), f"{root}/cell_predictions")


def filter_grid(grid: DataFrame, regions: DataFrame, region_name: str, text: str, tile: float, path: str) -> None:
    """Cells that touch a region whose name contains a text, as GeoJSON. Both frames have ``id``/name and ``rings``.

    Every row of ``regions`` is a region of its own, also where names repeat.
    """
    chosen = regions.filter(F.col(region_name).contains(text)).withColumn("_feature", F.monotonically_increasing_id())
    kept = spatial.polygons_touching(
        spatial.edges_from_rings(grid, "id"), spatial.edges_from_rings(chosen, "_feature"), tile
    )
    sinks.write_geojson(grid.join(kept.withColumnRenamed("poly_id", "id"), "id", "left_semi"), path, ["id"])


def grid_with_districts(grid: DataFrame, districts: DataFrame, code: str, tile: float, path: str) -> None:
    """Cells with their district; the table must not exist yet."""
    codes = spatial.assign_districts(
        spatial.edges_from_rings(grid, "id"), spatial.edges_from_rings(districts, code), tile
    ).withColumnRenamed("poly_id", "id")
    sinks.create_new(grid.join(codes, "id", "left"), path)
