"""Dates, months, hour slots, calendar features and ages as Columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from citypulse.functions.values import stripped

# Days that count as weekend in the feature set.
WEEKEND_GROUP = ["Friday", "Saturday", "Sunday"]


def _parsed_day(text: Column) -> Column:
    year_month = F.concat(F.substring(text, 1, 4), F.lit("-"), F.substring(text, 5, 2), F.lit("-"))
    iso = (
        F.when(text.contains("-"), text)
        .when(F.length(text) == 8, F.concat(year_month, F.substring(text, 7, 2)))
        .when(F.length(text) == 6, F.concat(year_month, F.lit("01")))
    )
    return iso.try_cast("date")


def date_from_text(col: Column, on_error: str = "raise") -> Column:
    """``yyyy-MM-dd``, ``yyyyMMdd`` or ``yyyyMM`` (first of the month) to a date.

    Other text stops the job, or gives NULL with ``on_error='null'``.
    """
    # A one-element transform names the text, so a computed column is evaluated once, not per branch.
    parsed = F.transform(F.array(stripped(col)), _parsed_day)[0]
    if on_error == "null":
        return parsed
    message = F.concat(F.lit("unrecognised date text: "), F.coalesce(col, F.lit("NULL")))
    return F.coalesce(parsed, F.raise_error(message).cast("date"))


def month_key(col: Column) -> Column:
    """``yyyyMM``."""
    return F.date_format(col, "yyyyMM")


def month_label(col: Column) -> Column:
    """``yyyy-MM``."""
    return F.date_format(col, "yyyy-MM")


def month_bounds(ym: str) -> tuple[dt.date, dt.date]:
    """First day of the month ``yyyyMM`` and of the month after it."""
    start = dt.datetime.strptime(ym, "%Y%m").date()
    months = start.year * 12 + start.month
    return start, dt.date(months // 12, months % 12 + 1, 1)


def in_month(col: Column, ym: str) -> Column:
    start, following = month_bounds(ym)
    return (col >= F.lit(start)) & (col < F.lit(following))


def slot_timestamp(day_text: Column, hour_code: Column) -> Column:
    """Timestamp of a ``yyyyMMdd`` day and an hour code of one or two digits."""
    hour = F.lpad(hour_code.cast("string"), 2, "0")
    return F.to_timestamp(F.concat(day_text.cast("string"), hour), "yyyyMMddHH")


def weekday_short(col: Column) -> Column:
    """Lower-case three-letter day name."""
    return F.lower(F.date_format(col, "EEE"))


def calendar_features(ts: Column) -> dict[str, Column]:
    """month, hour, dayname and is_weekend_group of a timestamp."""
    dayname = F.date_format(ts, "EEEE")
    return {
        "month": F.month(ts),
        "hour": F.hour(ts),
        "dayname": dayname,
        "is_weekend_group": dayname.isin(WEEKEND_GROUP).cast("int"),
    }


def age_on(day: Column, birth: Column) -> Column:
    """Full years between two dates: the year difference, less one before the birthday."""
    before_birthday = (F.month(day) < F.month(birth)) | (
        (F.month(day) == F.month(birth)) & (F.dayofmonth(day) < F.dayofmonth(birth))
    )
    return F.year(day) - F.year(birth) - before_birthday.cast("int")


def text_day_from(col: Column, first_day: dt.date) -> Column:
    """Rows whose timestamp text starts with a day on or after ``first_day``."""
    return F.to_date(F.substring(col, 1, 10)) >= F.lit(first_day)
