"""Alerts: window averages above the threshold of their device."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def alerts(
    gold: DataFrame,
    thresholds: DataFrame,
    measure: str = "sensor5_avg",
    ordered: bool = False,
) -> DataFrame:
    """Rows of ``gold`` whose measure is strictly above the threshold.

    A device without threshold, or a null on either side, gives no alert.
    Wrap stored ``thresholds`` in ``bounded_broadcast``, so that gold is not
    shuffled for them while they are small.
    """
    found = (
        gold.join(thresholds.select("deviceName", "Threshold"), "deviceName")
        .where(F.col(measure) > F.col("Threshold"))
        .select(
            F.col("window.start").alias("start"),
            F.col("window.end").alias("end"),
            *gold.columns,
            "Threshold",
        )
    )
    return found.orderBy("deviceName", "start") if ordered else found
