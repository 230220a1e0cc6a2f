"""Device and date dimensions, and checks on them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.functions.calendar import calendar_columns


def date_dimension(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    if end < start:
        raise ValueError(f"empty range {start} .. {end}")
    days = spark.range(0, 1, 1, 1).select(
        F.explode(
            F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))
        ).alias("day")
    )
    return days.select(*calendar_columns(F.col("day")))


def date_bounds(df: DataFrame, time_col: str = "datetime") -> tuple[dt.date, dt.date]:
    """First and last day of a column; reads that column only."""
    ends = df.agg(F.min(time_col).alias("low"), F.max(time_col).alias("high"))
    low, high = ends.select(F.to_date("low"), F.to_date("high")).first()
    if low is None:
        raise ValueError(f"{time_col} has no values")
    return low, high


def date_dimension_for(df: DataFrame, time_col: str = "datetime") -> DataFrame:
    """Date dimension covering every reading, so the join loses none."""
    return date_dimension(df.sparkSession, *date_bounds(df, time_col))


def device_dimension(df: DataFrame, device: str, name: str, location: str) -> DataFrame:
    return df.select(
        F.col(device).alias("device"),
        F.col(name).alias("deviceName"),
        F.col(location).alias("location"),
    )


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """Refuse a dimension in which a key occurs twice."""
    repeated = df.groupBy(key).count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"{key} = {repeated[0][0]!r} occurs {repeated[0][1]} times")
    return df


def unmatched(readings: DataFrame, devices: DataFrame, dates: DataFrame) -> DataFrame:
    """How many readings inner joins with both dimensions would drop, and why.

    Silver itself keeps a reading of a date outside the dimension.

    Counting per device and day first leaves little to join.
    """
    tally = readings.groupBy("device", F.to_date("datetime").alias("CalendarDate")).agg(
        F.count(F.lit(1)).alias("n")
    )
    known_device = devices.select("device").withColumn("known_device", F.lit(True))
    known_date = dates.select("CalendarDate").withColumn("known_date", F.lit(True))
    joined = tally.join(known_device, "device", "left").join(known_date, "CalendarDate", "left")

    def rows(condition: str):
        return F.coalesce(F.sum(F.when(F.expr(condition), F.col("n"))), F.lit(0))

    return joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("readings"),
        rows("known_device IS NULL").alias("unknown_device"),
        rows("known_date IS NULL").alias("date_outside"),
        rows("known_device IS NULL OR known_date IS NULL").alias("dropped"),
    )
