"""Hourly flow counts per cell: load transform, month aggregates, extract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citypulse.functions.dates import date_from_text, in_month, month_key, weekday_short
from citypulse.functions.values import district_code, lenient_double, optional_double, rounded2
from citypulse.schemas import SEXES, TEN_YEAR_BANDS, TEN_YEAR_COLUMNS


def _with_counts(raw: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """The frame and a count column per five-year band, missing and malformed as 0.

    A flow file is read with numeric counts (the reader turns malformed text into NULL). Text counts
    are converted by one ``transform`` over an array: 26 conversions written out make a method too
    long for the JVM to compile, which is three times slower.
    """
    summed = [sex + part for sex in SEXES for parts in TEN_YEAR_BANDS.values() if len(parts) > 1 for part in parts]
    if dict(raw.dtypes)[summed[0]] == "string":
        counted = raw.withColumn("_counts", F.transform(F.array(*[F.col(c) for c in summed]), lenient_double))
        return counted, {name: F.col("_counts")[i] for i, name in enumerate(summed)}
    numbers = {n: F.coalesce(F.nanvl(F.col(n).cast("double"), F.lit(0.0)), F.lit(0.0)) for n in summed}
    return raw, numbers


def _optional(raw: DataFrame, name: str) -> Column:
    return optional_double(F.col(name)) if dict(raw.dtypes)[name] == "string" else F.col(name).cast("double")


def optional_count(raw: DataFrame, name: str) -> Column:
    """A count of text or numbers; what is no number, or not finite, is NULL. Numbers are not turned into text."""
    value = _optional(raw, name)
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def normalize_flow(raw: DataFrame, on_bad_date: str = "raise") -> DataFrame:
    """Rows of a flow file to mart rows.

    Five-year bands are summed to ten-year bands with missing or malformed counts as 0;
    the top band and the total are single columns and keep NULL for an empty field.
    """
    raw, part_of = _with_counts(raw)
    bands = []
    for sex in SEXES:
        for band, parts in TEN_YEAR_BANDS.items():
            values = [part_of[sex + part] for part in parts] if len(parts) > 1 else [_optional(raw, sex + band)]
            bands.append(sum(values[1:], values[0]).alias(sex + band))
    return raw.select(
        "id",
        "type",
        "timezn_cd",
        *bands,
        _optional(raw, "total").alias("total"),
        district_code(F.col("admi_cd")).alias("admi_cd"),
        date_from_text(F.col("etl_ymd"), on_bad_date).alias("etl_ymd"),
    )


def with_month(flow: DataFrame) -> DataFrame:
    """Add the partition column ``crtr_ym``; every row goes by its own day."""
    return flow.withColumn("crtr_ym", month_key(F.col("etl_ymd")))


def month_rows(flow: DataFrame, ym: str) -> DataFrame:
    """Rows of one month. Prunes partitions where the table is partitioned by ``crtr_ym``."""
    rows = flow.filter(in_month(F.col("etl_ymd"), ym))
    return rows.filter(F.col("crtr_ym") == ym) if "crtr_ym" in flow.columns else rows


def month_sums(flow: DataFrame, ym: str) -> DataFrame:
    """The month summed by type, hour, day and district.

    All four reports are sums over parts of these keys, so a job scans the month once, keeps
    this small frame and derives them from it.
    """
    sums = [F.sum(c).alias(c) for c in [*TEN_YEAR_COLUMNS, "total"]]
    return month_rows(flow, ym).groupBy("type", "timezn_cd", "etl_ymd", "admi_cd").agg(*sums)


def _report(rows: DataFrame, ym: str, keys: list[Column]) -> DataFrame:
    return (
        rows.groupBy(*keys)
        .agg(rounded2(F.sum("total")).alias("total_population"))
        .withColumn("crtr_ym", F.lit(ym))
    )


def flow_by_sex_age(flow: DataFrame, ym: str) -> DataFrame:
    """Month total by type, sex and ten-year band: 14 sums per type first, rows after."""
    sums = month_rows(flow, ym).groupBy("type").agg(*[F.sum(c).alias(c) for c in TEN_YEAR_COLUMNS])
    entries = ", ".join(f"'{c[0].upper()}', '{c[1:]}', {c}" for c in TEN_YEAR_COLUMNS)
    long = sums.selectExpr("type", f"stack({len(TEN_YEAR_COLUMNS)}, {entries}) AS (gender, age, people)")
    return long.select(
        F.lit(ym).alias("crtr_ym"), "type", "gender", "age", rounded2(F.col("people")).alias("total_population")
    )


def flow_by_hour(flow: DataFrame, ym: str) -> DataFrame:
    keys = [F.col("timezn_cd"), F.col("type")]
    return _report(month_rows(flow, ym), ym, keys).select("crtr_ym", "timezn_cd", "type", "total_population")


def flow_by_weekday(flow: DataFrame, ym: str) -> DataFrame:
    # Summed by day first: at most 31 days and the types are left to be named.
    days = month_rows(flow, ym).groupBy("etl_ymd", "type").agg(F.sum("total").alias("total"))
    keys = [weekday_short(F.col("etl_ymd")).alias("dayname"), F.col("type")]
    return _report(days, ym, keys).select("crtr_ym", "dayname", "type", "total_population")


def flow_by_district_day(flow: DataFrame, ym: str) -> DataFrame:
    keys = [F.col("admi_cd"), F.col("etl_ymd")]
    return _report(month_rows(flow, ym), ym, keys).select("crtr_ym", "admi_cd", "etl_ymd", "total_population")


MONTH_REPORTS = {
    "flow_by_sex_age": flow_by_sex_age,
    "flow_by_hour": flow_by_hour,
    "flow_by_weekday": flow_by_weekday,
    "flow_by_district_day": flow_by_district_day,
}


def flow_extract(raw: DataFrame) -> DataFrame:
    """Total per cell, day, hour and district over all types; rows with a missing key are left out."""
    keys = ["id", "etl_ymd", "timezn_cd", "admi_cd"]
    total = F.coalesce(F.sum(optional_count(raw, "total")), F.lit(0.0))
    return raw.na.drop(subset=keys).groupBy(*keys).agg(total.alias("total"))
