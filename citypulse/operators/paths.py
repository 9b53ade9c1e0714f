"""Movement paths: the places of each device in time order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citypulse.operators.presence import DEVICE


def _located(visit_rows: DataFrame) -> DataFrame:
    return visit_rows.na.drop(subset=[DEVICE, "logging_date", "lon", "lat"]).select(
        DEVICE, "logging_date", "lon", "lat"
    )


def path_points(visit_rows: DataFrame, chunk: str = "hour") -> DataFrame:
    """Located rows numbered 1.. in time order within each device (ties by lon, then lat).

    Rows are numbered within a device and a chunk of time; counts per chunk, summed over the
    chunks before, give the offset. So no task sorts the whole history of a busy device, only
    one chunk of it, and the running sum sees one row per chunk. Use ``minute`` for denser logs.
    """
    rows = _located(visit_rows).withColumn("_chunk", F.date_trunc(chunk, "logging_date"))
    before = Window.partitionBy(DEVICE).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(DEVICE, "_chunk")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(DEVICE, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    in_chunk = Window.partitionBy(DEVICE, "_chunk").orderBy("logging_date", "lon", "lat")
    numbered = rows.withColumn("_at", F.row_number().over(in_chunk))
    return numbered.join(offsets, [DEVICE, "_chunk"]).select(
        DEVICE, (F.col("_offset") + F.col("_at")).alias("seq"), "logging_date", "lon", "lat"
    )


def path_lines(visit_rows: DataFrame, points_per_part: int = 10_000, chunk: str = "hour") -> DataFrame:
    """Paths as arrays of points, split into parts of a bounded number of points.

    Part ``n`` ends with the first point of part ``n + 1``, so drawing all parts draws the whole
    path and nothing is left out. A part that would hold only that shared point is none. ``kind`` is
    that of the device: ``point`` where it has a single row, whatever the size of the parts.
    """
    numbered = path_points(visit_rows, chunk)
    part = F.floor((F.col("seq") - 1) / points_per_part)
    first = (F.col("seq") - 1) % points_per_part == 0
    parts = F.when(first & (F.col("seq") > 1), F.array(part, part - 1)).otherwise(F.array(part))
    point = F.struct("seq", "logging_date", "lon", "lat")
    return (
        numbered.withColumn("part_no", F.explode(parts))
        .groupBy(DEVICE, "part_no")
        .agg(F.array_sort(F.collect_list(point)).alias("points"))
        .filter((F.size("points") > 1) | (F.col("part_no") == 0))
        .withColumn("kind", F.when(F.size("points") > 1, "line").otherwise("point"))
    )


def path_kinds(visit_rows: DataFrame) -> DataFrame:
    """Number of located rows per device and whether they make a line or a single point."""
    counted = _located(visit_rows).groupBy(DEVICE).agg(F.count(F.lit(1)).alias("n_points"))
    return counted.withColumn("kind", F.when(F.col("n_points") > 1, "line").otherwise("point"))


def mean_centre(places: DataFrame) -> DataFrame:
    """Mean latitude and longitude, one row."""
    return places.agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))
