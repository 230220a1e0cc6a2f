"""Gold: averages per device name and tumbling event-time window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.schemas import SENSORS

WINDOW = "30 seconds"
WATERMARK = "1 minute"


def window_averages(
    silver: DataFrame,
    sensors: tuple[str, ...] = SENSORS,
    window: str = WINDOW,
    watermark: str | None = WATERMARK,
) -> DataFrame:
    """Average of each sensor by (window, deviceName).

    Map-side partial averages go into the shuffle, so a hot device costs one
    row per task and window. The watermark bounds state in append and update
    mode; in complete mode and in batch it has no effect.
    """
    if watermark and silver.isStreaming:
        silver = silver.withWatermark("datetime", watermark)
    return silver.groupBy(F.window("datetime", window), "deviceName").agg(
        *[F.avg(s).alias(f"{s}_avg") for s in sensors]
    )


def window_partials(
    silver: DataFrame, sensors: tuple[str, ...] = SENSORS, window: str = WINDOW
) -> DataFrame:
    """Sums and counts by (window, deviceName): what averages are made of."""
    return silver.groupBy(F.window("datetime", window), "deviceName").agg(
        *[F.sum(s).alias(f"{s}_sum") for s in sensors],
        *[F.count(s).alias(f"{s}_n") for s in sensors],
    )


def merge_partials(partials: DataFrame, sensors: tuple[str, ...] = SENSORS) -> DataFrame:
    """Averages from any number of partial rows per (window, deviceName)."""
    return partials.groupBy("window", "deviceName").agg(
        *[
            (F.sum(f"{s}_sum") / F.nullif(F.sum(f"{s}_n"), F.lit(0))).alias(f"{s}_avg")
            for s in sensors
        ]
    )


def flatten_window(df: DataFrame) -> DataFrame:
    """Replace the window struct by ``window_start`` and ``window_end``."""
    others = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *others,
    )
