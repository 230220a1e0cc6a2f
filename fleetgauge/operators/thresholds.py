"""Alert thresholds derived from the history of window averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FACTOR = 0.97


def device_statistics(gold: DataFrame, measure: str = "sensor5_avg") -> DataFrame:
    """Mean, maximum and sample deviation of the window averages of a device."""
    stem = measure.removesuffix("_avg")
    return gold.groupBy("deviceName").agg(
        F.avg(measure).alias(f"{stem}_Avg"),
        F.max(measure).alias(f"{stem}_Max"),
        F.stddev(measure).alias(f"{stem}_Std"),
    )


def derive_thresholds(
    gold: DataFrame, factor: float = FACTOR, measure: str = "sensor5_avg"
) -> DataFrame:
    """Threshold = the share ``factor`` of the maximum."""
    return gold.groupBy("deviceName").agg((F.max(measure) * factor).alias("Threshold"))
