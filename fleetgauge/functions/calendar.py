"""Calendar attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _flag(condition: Column) -> Column:
    return F.when(condition, "Y").otherwise("N")


def calendar_columns(day: Column) -> list[Column]:
    """The 14 columns of the date dimension for one date column.

    Weeks are ISO weeks. ``DayOfWeek`` counts from Sunday = 1,
    ``DayOfWeekStartMonday`` from Monday = 1.
    """
    from_monday = F.weekday(day) + 1
    date_int = F.year(day) * 10000 + F.month(day) * 100 + F.day(day)
    return [
        date_int.alias("dateInt"),
        day.alias("CalendarDate"),
        F.year(day).alias("CalendarYear"),
        F.date_format(day, "MMMM").alias("CalendarMonth"),
        F.month(day).alias("MonthOfYear"),
        F.date_format(day, "EEEE").alias("CalendarDay"),
        F.dayofweek(day).alias("DayOfWeek"),
        from_monday.alias("DayOfWeekStartMonday"),
        _flag(from_monday <= 5).alias("IsWeekDay"),
        F.dayofmonth(day).alias("DayOfMonth"),
        _flag(day == F.last_day(day)).alias("IsLastDayOfMonth"),
        F.dayofyear(day).alias("DayOfYear"),
        F.weekofyear(day).alias("WeekOfYearIso"),
        F.quarter(day).alias("QuarterOfYear"),
    ]
