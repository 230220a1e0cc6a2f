"""Silver: readings with their device and calendar attributes, and scored."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.operators.lookups import BROADCAST_LIMIT, lookup
from fleetgauge.schemas import SENSORS

VARIANCES = {
    "sensor2Variance": ("sensor2", "sensor1"),
    "sensor4Variance": ("sensor4", "sensor3"),
}

Scorer = Callable[[DataFrame], DataFrame]


def variance_columns(sensors: Iterable[str]) -> list[Column]:
    """Differences between paired sensors, where both are present."""
    present = set(sensors)
    return [
        (F.col(a) - F.col(b)).alias(name)
        for name, (a, b) in VARIANCES.items()
        if {a, b} <= present
    ]


def enrich(
    readings: DataFrame,
    devices: DataFrame,
    dates: DataFrame,
    scorer: Scorer | None = None,
    sensors: tuple[str, ...] = SENSORS,
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Join readings to both dimensions and derive the silver columns.

    ``scorer`` adds ``sensor5Prediction``; it sees the sensor columns.
    A date that the dimension lacks gets its attributes by arithmetic. Readings
    of unknown devices are left out; :func:`unknown_devices` returns them.
    """
    day = F.to_date("datetime")
    calendar = dates.select(
        F.col("CalendarDate").alias("knownDate"), F.col("CalendarDay").alias("knownDay")
    )
    joined = lookup(readings, devices.select("device", "deviceName", "location"), "device", limit)
    joined = lookup(joined, calendar, day == F.col("knownDate"), limit, "left")
    predicted = []
    if scorer is not None:
        joined = scorer(joined)
        predicted = ["sensor5Prediction"]
    return joined.select(
        day.alias("CalendarDate"),
        F.coalesce("knownDay", F.date_format(day, "EEEE")).alias("CalendarDay"),
        F.hour("datetime").alias("hourOfDay"),
        "datetime",
        "device",
        "deviceName",
        "location",
        *sensors,
        *predicted,
        *variance_columns(sensors),
    )


def unknown_devices(
    readings: DataFrame, devices: DataFrame, limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """The readings, as they came, of devices that the dimension lacks, or of none."""
    return lookup(readings, devices.select("device"), "device", limit, "left_anti")
