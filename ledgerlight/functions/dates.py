"""Date arithmetic shared by the as-of filters."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column, SparkSession, functions as F

DateLike = dt.date | str


def as_date(value: DateLike | None) -> dt.date:
    """Resolve an as-of argument once on the driver; None means today in the session's time zone."""
    if value is None:
        spark = SparkSession.getActiveSession()
        if spark is None:
            return dt.datetime.now(dt.timezone.utc).date()
        return spark.sql("SELECT current_date() AS d").first().d
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def shift_months(day: dt.date, months: int) -> dt.date:
    """Calendar month shift with month-end clamp (2024-03-31 - 1 month = 2024-02-29)."""
    index = day.year * 12 + (day.month - 1) + months
    year, month = divmod(index, 12)
    month += 1
    last = calendar.monthrange(year, month)[1]
    return dt.date(year, month, min(day.day, last))


def month_start(day: dt.date) -> dt.date:
    return day.replace(day=1)


def date_lit(day: DateLike) -> Column:
    return F.lit(as_date(day))


def month_of(col: Column | str) -> Column:
    """First day of the column's month (the fact tables' partition value)."""
    return F.trunc(F.col(col) if isinstance(col, str) else col, "month")
