"""Shapes of the tables, and the binding of any table to the reading shape."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SENSORS = ("sensor1", "sensor2", "sensor3", "sensor4", "sensor5")

# Sensors are double: the default decimal has no fraction digits and would
# round every reading.
READING_SCHEMA = T.StructType(
    [
        T.StructField("device", T.IntegerType()),
        T.StructField("datetime", T.TimestampType()),
        *[T.StructField(s, T.DoubleType()) for s in SENSORS],
    ]
)

DEVICE_SCHEMA = T.StructType(
    [
        T.StructField("device", T.IntegerType()),
        T.StructField("deviceName", T.StringType()),
        T.StructField("location", T.StringType()),
    ]
)

THRESHOLD_SCHEMA = T.StructType(
    [
        T.StructField("deviceName", T.StringType()),
        T.StructField("Threshold", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class ReadingSpec:
    """Says which columns of a table are the device, event time and sensors.

    ``sensors`` maps the sensor name to a SQL expression over the source
    table. ``keep`` names columns to carry along unchanged.
    """

    device: str
    time: str
    sensors: Mapping[str, str]
    keep: tuple[str, ...] = field(default=())

    def bind(self, df: DataFrame) -> DataFrame:
        """Project ``df`` to ``device, datetime, <sensors>``.

        The time becomes TIMESTAMP, since a watermark needs that type and
        sources often store TIMESTAMP_NTZ; the session zone decides how, so
        cast back under the same zone to get the stored wall clock time.
        """
        measures: list[Column] = [
            F.expr(expression).cast("double").alias(name)
            for name, expression in self.sensors.items()
        ]
        return df.select(
            F.col(self.device).alias("device"),
            F.col(self.time).cast("timestamp").alias("datetime"),
            *measures,
            *self.keep,
        )
