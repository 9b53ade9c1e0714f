"""Access-point counts: per cell and slot, with flow beside them, active points, quantile trim."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.functions.dates import calendar_features, slot_timestamp
from citypulse.functions.values import integer_text
from citypulse.operators.flow import optional_count
from citypulse.operators.lookup import keep_known, map_column
from citypulse.operators.shape import drop_missing, sum_or_zero
from citypulse.session import cut_lineage

SKETCH_ACCURACY = 10_000


def cell_counts(summary: DataFrame, ap_cells: DataFrame) -> DataFrame:
    """Accesses per cell and slot; access points outside every cell are left out.

    ``summary(std_date, ap_id, cnt)``, ``ap_cells(ap_id, grid_id)``.
    """
    return (
        map_column(summary, "ap_id", ap_cells, "ap_id", "grid_id", "grid_id", split_hot=True)
        .na.drop(subset=["grid_id", "std_date"])
        .groupBy("grid_id", "std_date")
        .agg(sum_or_zero("cnt").alias("acs_cnt"))
    )


def flow_slots(flow_raw: DataFrame) -> DataFrame:
    """Raw flow rows with the timestamp of their day and hour code: id, std_date, type, total, admi_cd."""
    return flow_raw.select(
        integer_text(F.col("id")).alias("grid_id"),
        slot_timestamp(F.col("etl_ymd"), F.col("timezn_cd")).alias("std_date"),
        "type",
        optional_count(flow_raw, "total").alias("total"),
        "admi_cd",
    )


def training_frame(counts: DataFrame, flow: DataFrame, pre_aggregate: bool = False) -> DataFrame:
    """Cell slots that have both accesses and flow, with calendar features.

    ``flow`` keeps one row per type, so a slot may repeat; ``pre_aggregate`` sums the types first.
    """
    known = flow
    if pre_aggregate:
        known = (
            keep_known(flow, "grid_id", counts, "grid_id").na.drop(subset=["admi_cd"])
            .groupBy("grid_id", "std_date", "admi_cd")
            .agg(sum_or_zero("total").alias("total"))
        )
    joined = drop_missing(counts.join(known, ["grid_id", "std_date"]))
    return with_calendar(joined)


def with_calendar(df: DataFrame, ts: str = "std_date") -> DataFrame:
    return df.withColumns(calendar_features(F.col(ts)))


def active_points(summary: DataFrame) -> DataFrame:
    """Access points with accesses, per slot.

    Equal to counting over :func:`dense_counts`, whose added rows are all 0, without building it.
    """
    return (
        summary.na.drop(subset=["std_date"])
        .groupBy("std_date")
        .agg(F.count_if(F.col("cnt") > 0).alias("active_ap"))
    )


def dense_counts(summary: DataFrame) -> DataFrame:
    """One row for every access point and slot that occur in the data, 0 where the pair does not.

    The result has points times slots rows. Slots are laid out over the days of the data and met
    by day, so no task holds more than one day's share of a point and there is no cross join.
    """
    day = F.to_date("std_date")
    slots = summary.select("std_date").distinct().select("std_date", day.alias("_day"))
    span = slots.agg(F.min("_day").alias("first"), F.max("_day").alias("last"))
    points = summary.select("ap_id").distinct().select(
        "ap_id",
        F.explode(F.sequence(span.select("first").scalar(), span.select("last").scalar())).alias("_day"),
    )
    frame = points.join(slots, "_day").select("ap_id", "std_date")
    return frame.join(summary.select("ap_id", "std_date", "cnt"), ["ap_id", "std_date"], "left").select(
        "ap_id", "std_date", F.coalesce("cnt", F.lit(0)).alias("cnt")
    )


def exact_quantile(df: DataFrame, column: str, q: float) -> float | None:
    """Quantile with linear interpolation between neighbouring values, exact at any size.

    Approximate quantiles propose two cut values near the wanted rank; exact counts of what lies
    under, on, between and over them decide where it is. Repeated on that part, which is about
    one in two thousand of the rows before, until a cut value is the wanted one: among fewer
    values than the sketch tells apart, it is. Only counts and cut values reach the driver.
    """
    values = df.select(F.col(column).cast("double").alias("v"))
    values = values.filter(F.col("v").isNotNull() & ~F.isnan("v"))
    total = values.count()
    if total == 0:
        return None
    position = q * (total - 1)
    low_rank, high_rank = math.floor(position), math.ceil(position)
    low = _value_at(values, low_rank, total)
    if high_rank == low_rank:
        return low
    following = values.agg(
        F.count_if(F.col("v") <= low).alias("upto"), F.min(F.when(F.col("v") > low, F.col("v"))).alias("above")
    ).first()
    high = low if following["upto"] > high_rank else following["above"]
    return low + (high - low) * (position - low_rank)


def _value_at(values: DataFrame, rank: int, total: int) -> float:
    """Value at 0-based ``rank`` of the sorted values."""
    remaining, count, v = values, total, F.col("v")
    margin = 2.0 / SKETCH_ACCURACY
    while True:
        centre = rank / max(count - 1, 1)
        ends = [max(centre - margin, 0.0), min(centre + margin, 1.0)]
        lo, hi = remaining.agg(F.percentile_approx("v", ends, SKETCH_ACCURACY)).first()[0]
        parts = [v < lo, v == lo, (v > lo) & (v < hi), (v == hi) & (v > lo), v > hi]
        sizes = remaining.agg(*[F.count_if(p).alias(f"n{i}") for i, p in enumerate(parts)]).first()
        part = 0
        while rank >= sizes[part]:
            rank, part = rank - sizes[part], part + 1
        if part in (1, 3):
            return lo if part == 1 else hi
        # What is left is a small part of the data: keep it, so the next rounds do not scan all again.
        remaining, count = cut_lineage(remaining.filter(parts[part])), sizes[part]


def trim_upper(df: DataFrame, column: str, q: float = 0.995) -> DataFrame:
    """Rows up to and including the quantile of a column."""
    threshold = exact_quantile(df, column, q)
    return df.limit(0) if threshold is None else df.filter(F.col(column) <= F.lit(threshold))


def in_period(df: DataFrame, column: str, first: str, last: str) -> DataFrame:
    """Rows between two times, both included."""
    return df.filter(F.col(column).between(F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp")))
