"""Month tables that are published together: new months in folders of their own, and one manifest that names them.

A run writes each month of each table to ``<root>/<table>/edition=<id>/<month column>=<month>``, where no reader looks
yet. When all are complete it writes ``<root>/_editions/<number>.json``, which says for every table and month
which edition counts, by renaming a finished file to a name that must not exist yet. Readers resolve
months through the highest number, so they see all tables of a run or none, also while a run stops half
way; of two runs that finish at once the second reads the first one's manifest and tries again. Files of
editions that no manifest names any more are removed by ``remove_old``, not by writers.

The manifest has an entry for each table and month, so it stays small whatever the size of the tables.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONTH = "crtr_ym"
FOLDER = "_editions"
DIGITS = 12
#: Tries to add a manifest while other runs add theirs.
TRIES = 20
Manifest = dict[str, dict[str, str]]


def _hadoop(spark: SparkSession, path: str):  # noqa: ANN202
    """Hadoop's path and file system of a location, which may be in any store that Spark writes to."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    place, system = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in _names(spark, f"{root}/{FOLDER}") if n.endswith(".json") and n[:DIGITS].isdigit()]


def _read(spark: SparkSession, root: str, number: int) -> Manifest:
    text = spark.read.option("wholetext", True).text(f"{root}/{FOLDER}/{number:0{DIGITS}d}.json").first()
    return json.loads(text[0])


def manifest(spark: SparkSession, root: str) -> Manifest:
    """Table to month to edition, as last published; empty before that."""
    numbers = _numbers(spark, root)
    return _read(spark, root, numbers[-1]) if numbers else {}


def _add(spark: SparkSession, root: str, number: int, entry: Manifest) -> bool:
    """Write a manifest under a number that nobody has taken. False if somebody has."""
    jvm, folder = spark.sparkContext._jvm, f"{root}/{FOLDER}"
    place, system = _hadoop(spark, f"{folder}/.{uuid.uuid4().hex}.tmp")
    target, _ = _hadoop(spark, f"{folder}/{number:0{DIGITS}d}.json")
    out = system.create(place, False)
    out.write(bytearray(json.dumps(entry, sort_keys=True), "utf-8"))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plainly = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(place, target, plainly)
    except Exception as error:  # noqa: BLE001  whatever the store says: what counts is whether the number is taken
        if not system.exists(target):
            raise error
        system.delete(place, False)
        return False
    return True


def write_edition(frames: dict[str, DataFrame], root: str, month: str = MONTH) -> Manifest:
    """Write the months of several tables where no reader looks yet; returns what a manifest has to say of them."""
    edition = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    written: Manifest = {}
    for name, df in frames.items():
        folder = f"{root}/{name}/edition={edition}"
        df.write.mode("errorifexists").partitionBy(month).parquet(folder)
        written[name] = {part.split("=", 1)[1]: edition for part in _names(df.sparkSession, folder) if part.startswith(f"{month}=")}
    return written


def publish(spark: SparkSession, root: str, written: Manifest) -> None:
    """Let readers see the months of an edition, of all its tables at once; other months stay."""
    for _ in range(TRIES):
        numbers = _numbers(spark, root)
        before = _read(spark, root, numbers[-1]) if numbers else {}
        merged = before | {name: before.get(name, {}) | months for name, months in written.items()}
        if _add(spark, root, numbers[-1] + 1 if numbers else 1, merged):
            return
    raise RuntimeError(f"{TRIES} other manifests were added to {root} meanwhile")


def write_months(frames: dict[str, DataFrame], root: str, month: str = MONTH) -> None:
    """Replace the months that occur in several tables, for readers all at once; writing again gives the same tables."""
    publish(next(iter(frames.values())).sparkSession, root, write_edition(frames, root, month))


def read(spark: SparkSession, root: str, name: str, schema: T.StructType | str, month: str = MONTH) -> DataFrame:
    """A published table: ``schema`` without its month, which is added as text. Empty if nothing is published."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = T.StructType([*(f for f in kind.fields if f.name != month), T.StructField(month, T.StringType())])
    months = manifest(spark, root).get(name, {})
    if not months:
        return spark.createDataFrame([], whole)
    paths = [f"{root}/{name}/edition={edition}/{month}={value}" for value, edition in sorted(months.items())]
    return spark.read.schema(whole).option("basePath", f"{root}/{name}").parquet(*paths).select(*whole.names)


def remove_old(spark: SparkSession, root: str, keep: int = 1, older_than_s: float = 86_400.0) -> list[str]:
    """Remove month folders that none of the last ``keep`` manifests names, and older manifests; returns the folders.

    An edition younger than ``older_than_s`` may still be on its way to a manifest, so it stays.
    """
    numbers = _numbers(spark, root)
    named = {(t, m, e) for n in numbers[-keep:] for t, months in _read(spark, root, n).items() for m, e in months.items()}
    limit = time.time_ns() - int(older_than_s * 1e9)
    removed = []
    for name in (n for n in _names(spark, root) if n != FOLDER):
        for edition in (e.split("=", 1)[1] for e in _names(spark, f"{root}/{name}") if e.startswith("edition=")):
            if int(edition.split("-")[0]) > limit:
                continue
            parts = [p for p in _names(spark, f"{root}/{name}/edition={edition}") if "=" in p]
            unused = [p for p in parts if (name, p.split("=", 1)[1], edition) not in named]
            for folder in [f"{root}/{name}/edition={edition}"] if len(unused) == len(parts) else [f"{root}/{name}/edition={edition}/{p}" for p in unused]:
                place, system = _hadoop(spark, folder)
                system.delete(place, True)
                removed.append(folder)
    for number in numbers[:-keep]:
        place, system = _hadoop(spark, f"{root}/{FOLDER}/{number:0{DIGITS}d}.json")
        system.delete(place, False)
    return removed
