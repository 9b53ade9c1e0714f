"""Key to value lookups.

Spark broadcasts a lookup whose size is under ``spark.sql.autoBroadcastJoinThreshold`` (checked again at run
time by AQE) and shuffles a larger one; a hint is only given behind a count of the lookup's rows.
Where single rows meet a lookup, ``map_column(..., split_hot=True)`` counts the keys first and deals
out the rows of frequent ones, so that the split depends on the data and not on the shape of the plan.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a row of a lookup may take in memory, key and value together.
ROW_BYTES = 512


def unique_lookup(df: DataFrame, key: str, value: str, ordinal: str) -> DataFrame:
    """One value per key: the one with the highest ``ordinal`` (the last written wins)."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max_by(F.struct(value), F.col(ordinal)).alias("last"))
        .select(key, F.col(f"last.{value}").alias(value))
    )


def _one_each(lookup: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key. Two different values of a key are an error: which one counts is for ``unique_lookup`` to say."""
    text = F.concat(F.lit(f"several values of {value} for {key} "), F.col(key).cast("string"))
    low, high = F.min(value), F.max(value)
    pairs = lookup.filter(F.col(key).isNotNull()).groupBy(key).agg(low.alias("_low"), high.alias("_high"))
    only = F.when(F.col("_low").eqNullSafe(F.col("_high")), F.col("_low")).otherwise(F.raise_error(text))
    return pairs.select(F.col(key), only.alias(value))


def hot_keys(df: DataFrame, key: str) -> dict[object, int]:
    """Keys with more rows than an even share of a shuffle partition, and how many shares they fill.

    There are fewer of them than shuffle partitions, whatever the data. Keys are counted map side, in one
    pass over the key column alone.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    seen = Observation()
    often = counts.observe(seen, F.sum("_n").alias("rows")).orderBy(F.desc("_n")).limit(partitions).collect()
    share = (seen.get["rows"] or 0) / partitions if often else 0
    return {r["_key"]: math.ceil(r["_n"] / share) for r in often if r["_n"] > share}


def _is_small(pairs: DataFrame) -> bool:
    """Whether a lookup of two columns has so few rows, each short enough, that it fits the session's broadcast threshold."""
    amount, unit = re.fullmatch(r"(-?\d+)\s*([kmgt]?)i?b?", pairs.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()).groups()
    most = int(amount) * 1024 ** " kmgt".index(unit or " ") // ROW_BYTES
    if most <= 0:
        return False
    length = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in pairs.columns), F.lit(0))
    size = pairs.limit(most + 1).agg(F.count(F.lit(1)).alias("rows"), F.max(length).alias("longest")).first()
    return size["rows"] <= most and (size["longest"] or 0) <= ROW_BYTES // 4


def _parts(key: Column, kind: T.DataType, hot: dict[object, int]) -> Column:
    """Into how many parts the rows of a key are dealt."""
    values = [F.lit(k).cast(kind) for k in hot]
    pairs = [c for k, n in zip(values, hot.values(), strict=True) for c in (k, F.lit(n))]
    return F.when(key.isin(*values), F.element_at(F.create_map(*pairs), key)).otherwise(1) if hot else F.lit(1)


def map_column(
    df: DataFrame, key: str, lookup: DataFrame, lookup_key: str, lookup_value: str, output: str, split_hot: bool = False
) -> DataFrame:
    """Add ``output``: the lookup's value for ``key``, NULL where there is none.

    A key of the lookup that has several values is an error; see :func:`unique_lookup`. With ``split_hot``
    the rows of each frequent key, and those without a key, are dealt into parts of about one shuffle partition
    each, and the frequent keys' entries of the lookup are repeated for the parts. That counts the keys
    when the frame is made, so it takes one more pass over the key column of ``df``; a stream is not counted, and
    a lookup that is counted to be small is broadcast instead.
    """
    pairs = _one_each(lookup.select(F.col(lookup_key).alias("_key"), F.col(lookup_value).alias(output)), "_key", output)
    if not split_hot or df.isStreaming:
        return df.join(pairs, F.col(key) == F.col("_key"), "left").drop("_key")
    if _is_small(lookup.select(lookup_key, lookup_value)):
        return df.join(F.broadcast(pairs), F.col(key) == F.col("_key"), "left").drop("_key")
    hot, kind = hot_keys(df, key), df.schema[key].dataType
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = F.when(F.col(key).isNull(), spread).otherwise(_parts(F.col(key), kind, hot))
    # Equal rows of one task stay together, those of different tasks need not; a task that runs again deals alike.
    content = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    dealt = df.withColumn("_part", F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in content]), parts).cast("int"))
    numbers = F.sequence(F.lit(0), _parts(F.col("_key").cast(kind), kind, hot) - 1)
    repeated = pairs.withColumn("_of", F.explode(numbers))
    return dealt.join(repeated, (F.col(key) == F.col("_key")) & (F.col("_part") == F.col("_of")), "left").drop("_key", "_of", "_part")


def compose_lookups(
    first: DataFrame, first_key: str, first_value: str, second: DataFrame, second_key: str, second_value: str
) -> DataFrame:
    """Lookup from the first's keys to the second's values; keys that lead nowhere are left out.

    A key of either that has several values is an error; see :func:`unique_lookup`.
    """
    left = _one_each(first.select(F.col(first_key), F.col(first_value).alias("_via")), first_key, "_via")
    right = _one_each(second.select(F.col(second_key).alias("_key"), F.col(second_value)), "_key", second_value)
    return left.join(right, F.col("_via") == F.col("_key")).select(first_key, second_value)


def attach(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on columns both sides have under the same names."""
    return df.join(other, keys, "left")


def keep_known(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """Rows whose key occurs in the other frame."""
    keys = other.select(F.col(other_key).alias("_key"))
    return df.join(keys, F.col(key) == F.col("_key"), "left_semi")


def drop_known(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """Rows whose key does not occur in the other frame."""
    keys = other.select(F.col(other_key).alias("_key"))
    return df.join(keys, F.col(key) == F.col("_key"), "left_anti")


def latest_snapshot(df: DataFrame, column: str, as_of: str | None = None) -> DataFrame:
    """Rows of the newest snapshot, or of the one named by ``as_of``."""
    if as_of is not None:
        return df.filter(F.col(column) == F.lit(as_of))
    return df.filter(F.col(column) == df.select(F.max(column)).scalar())
