"""Who was there, from Wi-Fi logs: daily counts, runs of days, stay categories, places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citypulse.functions.dates import month_label
from citypulse.functions.values import not_in_keep_nulls

# Event kinds that are no visit, and the stay categories.
IGNORED_EVENTS = ["ClientInfoUpdate"]
ONE_TIME = "일회성 접속"
TOURIST = "관광(3일 이하 체류)"
LONG_STAY = "장기 체류(7일 이하)"
RESIDENT = "거주 추정"
ALWAYS_ON = "항상 접속"
STAY_CATEGORIES = [ONE_TIME, TOURIST, LONG_STAY, RESIDENT, ALWAYS_ON]

DEVICE = "client_mac_addr"


def describe_log(log: DataFrame, events: DataFrame, aps: DataFrame, places: DataFrame) -> DataFrame:
    """Log rows with event, access point and place, counted per device, time, event, AP and place.

    ``log(client_mac_addr, logging_date, event_id, ap_id)``, ``events(id, name)``, ``aps(id, name)``,
    ``places(id, lon, lat)``. Missing names form groups of their own.
    """
    event = events.select(F.col("id").alias("_event"), F.col("name").alias("event_name"))
    ap = aps.select(F.col("id").alias("_ap"), F.col("name").alias("ap_name"))
    place = places.select(F.col("id").alias("_place"), "lon", "lat")
    return (
        log.select(DEVICE, "logging_date", "event_id", "ap_id")
        .join(event, F.col("event_id") == F.col("_event"), "left")
        .join(ap, F.col("ap_id") == F.col("_ap"), "left")
        .join(place, F.col("_ap") == F.col("_place"), "left")
        .groupBy(DEVICE, "logging_date", "event_name", "ap_name", "lon", "lat")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def visits(log: DataFrame, ignored: list[str] | None = None) -> DataFrame:
    """Log rows that count as visits (an unknown event does), with day and month."""
    return log.filter(not_in_keep_nulls(F.col("event_name"), ignored or IGNORED_EVENTS)).withColumns(
        {"access_date": F.to_date("logging_date"), "month": month_label(F.col("logging_date"))}
    )


def daily_counts(visit_rows: DataFrame) -> DataFrame:
    """Rows per device, month and day."""
    keys = [DEVICE, "month", "access_date"]
    return visit_rows.na.drop(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("daily_count"))


def device_stats(daily: DataFrame, by_month: bool = False) -> DataFrame:
    """Days, events, mean and largest day of each device, over all time or per month."""
    keys = [DEVICE, "month"] if by_month else [DEVICE]
    return daily.groupBy(*keys).agg(
        F.count("access_date").alias("total_days"),
        F.sum("daily_count").alias("total_events"),
        F.avg("daily_count").alias("avg_daily"),
        F.max("daily_count").alias("max_daily"),
    )


def _day_bit(day: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), F.dayofmonth(day) - 1)


def longest_run(day_bits: Column) -> Column:
    """Longest run of set bits."""
    runs = F.split(F.bin(day_bits), "0+")
    return F.array_max(F.transform(runs, F.length)).cast("int")


def longest_runs(visit_rows: DataFrame) -> DataFrame:
    """Longest run of consecutive days per device and month.

    A run ends with its month, so the days of a month fit a 31-bit mask. Masks combine by OR,
    map side first: one shuffle, no sort, and a hot device costs one row per map task.
    """
    return (
        visit_rows.na.drop(subset=[DEVICE, "month", "access_date"])
        .groupBy(DEVICE, "month")
        .agg(F.bit_or(_day_bit(F.col("access_date"))).alias("day_bits"))
        .select(DEVICE, "month", longest_run(F.col("day_bits")).alias("max_streak"))
    )


def visit_runs(visit_rows: DataFrame) -> DataFrame:
    """Every run of consecutive days per device and month, with first day, last day and length.

    Windows hold the distinct days of one device in one month, 31 at most.
    """
    days = visit_rows.na.drop(subset=[DEVICE, "month", "access_date"]).select(DEVICE, "month", "access_date").distinct()
    in_month = Window.partitionBy(DEVICE, "month").orderBy("access_date")
    starts = F.coalesce(F.datediff("access_date", F.lag("access_date").over(in_month)) != 1, F.lit(True))
    return (
        days.withColumn("_starts", starts.cast("int"))
        .withColumn("run_no", F.sum("_starts").over(in_month))
        .groupBy(DEVICE, "month", "run_no")
        .agg(
            F.min("access_date").alias("first_day"),
            F.max("access_date").alias("last_day"),
            F.count(F.lit(1)).alias("run_days"),
        )
    )


def days_with_data(daily: DataFrame) -> DataFrame:
    """Days of each month on which any device was seen: one row per month."""
    return daily.groupBy("month").agg(F.countDistinct("access_date").alias("period_days"))


def stay_category(streak: Column, period_days: Column) -> Column:
    return (
        F.when(streak == 1, ONE_TIME)
        .when(streak <= 3, TOURIST)
        .when(streak <= 7, LONG_STAY)
        .when(streak < period_days, RESIDENT)
        .otherwise(ALWAYS_ON)
    )


def stay_categories(visit_rows: DataFrame) -> DataFrame:
    """Stats, longest run and stay category per device and month."""
    return stay_categories_of_days(daily_counts(visit_rows))


def stay_categories_of_days(daily: DataFrame) -> DataFrame:
    """The same from daily counts, for jobs that keep them."""
    per_month = daily.groupBy(DEVICE, "month").agg(
        F.count("access_date").alias("total_days"),
        F.sum("daily_count").alias("total_events"),
        F.avg("daily_count").alias("avg_daily"),
        F.max("daily_count").alias("max_daily"),
        F.bit_or(_day_bit(F.col("access_date"))).alias("day_bits"),
    )
    # One row per calendar month: a decade is 120 rows, so broadcasting it is safe at any data size.
    period = F.broadcast(days_with_data(daily))
    return (
        per_month.join(period, "month")
        .withColumn("max_streak", longest_run(F.col("day_bits")))
        .withColumn("category", stay_category(F.col("max_streak"), F.col("period_days")))
        .select(
            DEVICE, "month", "total_days", "total_events", "avg_daily", "max_daily", "max_streak", "category"
        )
    )


def category_pivot(categories: DataFrame) -> DataFrame:
    """Devices per month, one column per stay category; NULL where there are none."""
    return categories.groupBy("month").pivot("category", STAY_CATEGORIES).agg(F.count(DEVICE))


def visits_by_place(visit_rows: DataFrame, categories: DataFrame) -> DataFrame:
    """Visits per stay category, place and month, always-on devices left out.

    Rows are counted per device, month and place before the join, so a busy device brings
    as many rows as it saw places.
    """
    counted = (
        visit_rows.na.drop(subset=[DEVICE, "month", "lon", "lat"])
        .groupBy(DEVICE, "month", "lon", "lat")
        .agg(F.count(F.lit(1)).alias("size"))
    )
    of_device = categories.select(DEVICE, "month", "category")
    return (
        counted.join(of_device, [DEVICE, "month"])
        .filter(F.col("category") != ALWAYS_ON)
        .groupBy("category", "lon", "lat", "month")
        .agg(F.sum("size").alias("size"))
    )
