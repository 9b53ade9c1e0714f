"""Column and row shaping: keep, rename, stack, drop and fill missing values, previews, totals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Without the named columns; names that are not there are ignored."""
    return df.drop(*names)


def lower_columns(df: DataFrame, rename: dict[str, str] | None = None) -> DataFrame:
    """Lower-case all names, then rename."""
    lowered = df.toDF(*[name.lower() for name in df.columns])
    return lowered.withColumnsRenamed(rename or {})


def stack_frames(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name, missing ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _nan_as_null(df: DataFrame, names: list[str]) -> DataFrame:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    floats = [n for n in names if isinstance(kinds[n], (T.DoubleType, T.FloatType))]
    return df.withColumns({n: F.when(~F.isnan(n), F.col(n)) for n in floats}) if floats else df


def drop_missing(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows with no NULL or NaN in the given (or any) columns."""
    names = subset or df.columns
    return _nan_as_null(df, names).na.drop(subset=names)


def fill_missing(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace NULL and NaN per column."""
    return _nan_as_null(df, list(values)).na.fill(values)


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in the given order."""
    return df.orderBy(*order).limit(n)


def totals(df: DataFrame, distinct_of: str, sum_of: str) -> DataFrame:
    """One row: number of rows, of distinct values of one column, and the sum of another."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct(distinct_of).alias("distinct_count"),
        F.coalesce(F.sum(sum_of), F.lit(0)).alias("total"),
    )


def sum_or_zero(col: Column | str) -> Column:
    """Sum that is 0, not NULL, when every value is missing."""
    return F.coalesce(F.sum(col), F.lit(0))
