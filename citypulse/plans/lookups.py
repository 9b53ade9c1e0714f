"""Jobs that build the lookups: access point, merchant and address to cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.functions.points import valid_degrees, wkb_point
from citypulse.functions.values import address_key, cell_id_text
from citypulse.operators.lookup import unique_lookup
from citypulse.operators.shape import lower_columns
from citypulse.operators.spatial import locate
from citypulse.schemas import ADDRESS_PARTS


def ap_cells(aps: DataFrame, grid: DataFrame, tile: float) -> DataFrame:
    """``ap_id, grid_id`` from ``aps(ap_id, location)`` with hex WKB locations; NULL outside the grid.

    Access points are few beside their log, so points are decoded and located once per access point
    and place. Of several cells of a point on a border, and of several places, the highest id wins.
    """
    places = aps.select("ap_id", "location").distinct().withColumn("p", wkb_point(F.col("location")))
    placed = places.select("ap_id", F.col("p.lon").alias("x"), F.col("p.lat").alias("y"))
    located = locate(placed, grid, tile).withColumn("grid_id", cell_id_text(F.col("grid_id")))
    return located.groupBy("ap_id").agg(F.max("grid_id").alias("grid_id"))


def points_to_cells(points: DataFrame, key: str, lon: str, lat: str, grid: DataFrame, tile: float, ordinal: str) -> DataFrame:
    """``key, grid_id`` for named places with coordinates; the last row (by ``ordinal``) of a name wins."""
    placed = points.select(key, ordinal, F.col(lon).cast("double").alias("x"), F.col(lat).cast("double").alias("y"))
    usable = placed.withColumns(
        {c: F.when(valid_degrees(F.col("x"), F.col("y")), F.col(c)) for c in ("x", "y")}
    )
    located = locate(usable, grid, tile).withColumn("grid_id", cell_id_text(F.col("grid_id")))
    return unique_lookup(located.withColumn("_order", F.struct(ordinal, "grid_id")), key, "grid_id", "_order")


def address_lookups(
    register: DataFrame, address: str, lon: str, lat: str, grid: DataFrame, tile: float, ordinal: str
) -> tuple[DataFrame, DataFrame]:
    """Address key to address, and address to cell, from an address register with coordinates.

    The register has the address parts under their lower-cased household names.
    """
    rows = lower_columns(register)
    parts = [F.col("jumin_" + part) for part in ADDRESS_PARTS]
    keyed = rows.withColumn("addr_id", address_key(*parts)).withColumn("address", F.col(address))
    names = unique_lookup(keyed.select("addr_id", "address", ordinal), "addr_id", "address", ordinal)
    cells = points_to_cells(keyed, "address", lon, lat, grid, tile, ordinal)
    return names, cells
