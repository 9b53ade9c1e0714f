"""Where intermediate tables of these operators are kept, and how tables are read."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession


#: Folders made while a scope is open.
_MADE: list[list[str]] = []


@contextmanager
def scope() -> Iterator[list[str]]:
    """The folders that are made inside, for whoever knows when they are no longer read."""
    made: list[str] = []
    _MADE.append(made)
    try:
        yield made
    finally:
        _MADE.remove(made)


def deleted(spark: SparkSession, folders: list[str]) -> None:
    """Remove folders of intermediate tables, from whatever store they are in."""
    for folder in folders:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder name below ``spark.checkpoint.dir``; a local one only where Spark itself is local."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="citypulse-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    folder = f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"
    for made in _MADE:
        made.append(folder)
    return folder


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a frame to the shared folder and read it again, so that lost executors cost no recomputation.

    Spark deletes the shuffle files behind it once the driver has collected its garbage, so that is asked for.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    df.write.parquet(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


Model = TypeVar("Model")
_HELD: dict[Hashable, object] = {}


def held(key: Hashable, make: Callable[[], Model]) -> Model:
    """A model that tasks of one stage share in their Python worker. Workers outlive stages, so only the last one is held."""
    if key not in _HELD:
        _HELD.clear()
        gc.collect()
        _HELD[key] = make()
    return _HELD[key]
