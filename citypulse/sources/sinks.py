"""Sinks: tables, month partitions, lookups, CSV and GeoJSON."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citypulse.session import shared_dir


def stamp(df: DataFrame) -> DataFrame:
    """Add the load time. Only done when writing, so that results stay repeatable."""
    return df.withColumn("reg_dttm", F.current_timestamp())


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the target, in its order and types; a missing one is NULL."""
    known = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same rows; a NULL in one of the columns stops the write."""
    checked = {}
    for name in columns:
        message = F.raise_error(F.lit(f"column {name} must not be NULL"))
        checked[name] = F.coalesce(F.col(name), message.cast(df.schema[name].dataType))
    return df.withColumns(checked) if checked else df


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace(df: DataFrame, path: str) -> None:
    """Replace the whole table. ``df`` must not read from ``path``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def create_new(df: DataFrame, path: str) -> None:
    """Write a table that must not exist yet."""
    df.write.mode("errorifexists").parquet(path)


def write_months(df: DataFrame, path: str, month: str = "crtr_ym", sort: list[str] | None = None) -> None:
    """Replace the months that occur in ``df``, each row in its own month; other months stay.

    Writing again gives the same table. Rows are sorted inside each file, so that readers can
    skip row groups by day, hour and cell. Files are sized by the tasks that write them: no
    exchange gathers a month into one task.
    """
    ordered = df.sortWithinPartitions(month, *sort) if sort else df
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month).parquet(path)


def write_months_together(frames: dict[str, DataFrame], root: str, month: str = "crtr_ym") -> None:
    """Write several month tables so that a failure while computing leaves all of them unchanged.

    All are first written to a staging folder of this run; only when every one is complete are the
    months replaced, one table after the other. A rerun replaces the same months. The replacing
    itself is not atomic across tables. The staging folder is removed at the end.
    """
    spark = next(iter(frames.values())).sparkSession
    staging = f"{shared_dir(spark)}/staging-{uuid.uuid4().hex}"
    for name, df in frames.items():
        df.write.mode("errorifexists").parquet(f"{staging}/{name}")
    for name, df in frames.items():
        write_months(spark.read.schema(df.schema).parquet(f"{staging}/{name}"), f"{root}/{name}", month)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staging)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, path: str, partition_by: list[str] | None = None
) -> None:
    """Create a parquet table in the catalog if it is not there."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts} LOCATION '{path}'")


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch_size: int = 10_000, **extra: str) -> None:
    """Insert into a database table, one connection per task."""
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch_size), **extra).mode(mode).save()


def write_lookup(df: DataFrame, key: str, value: str, path: str) -> None:
    """A lookup as ``key, value`` rows."""
    df.select(F.col(key).alias("key"), F.col(value).alias("value")).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_geojson(df: DataFrame, path: str, properties: list[str], rings: str = "rings") -> None:
    """Polygons as GeoJSON, one feature per line; ``rings`` holds lists of lon, lat pairs.

    Where a column ``ring_parts`` gives the part of each ring, a feature of several parts is a MultiPolygon.
    """
    one = F.concat(F.lit('{"type":"Polygon","coordinates":'), F.to_json(rings), F.lit("}"))
    shape = one
    if "ring_parts" in df.columns:
        last = F.array_max("ring_parts")
        parts = F.transform(
            F.sequence(F.lit(0), last), lambda p: F.filter(rings, lambda ring, i: F.get("ring_parts", i) == p)
        )
        several = F.concat(F.lit('{"type":"MultiPolygon","coordinates":'), F.to_json(parts), F.lit("}"))
        shape = F.when(last > 0, several).otherwise(one)
    head = F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(F.struct(*properties)), F.lit(',"geometry":'))
    df.select(F.concat(head, shape, F.lit("}")).alias("value")).write.mode("overwrite").text(path)
