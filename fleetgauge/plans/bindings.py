"""The given tables in the roles of readings, devices and dates."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge import storage
from fleetgauge.operators.dimensions import date_dimension_for, device_dimension
from fleetgauge.schemas import SENSORS, ReadingSpec
from fleetgauge.session import MOST_PARTITIONS, fresh_path, widen_shuffles
from fleetgauge.streaming.replay import replay_files

EVENT_SENSORS = SENSORS[:2]
NUDGE = 1e-9
REPLAY_BYTES = 64 * 2**20

EVENTS = ReadingSpec(
    device="user_id",
    time="ts",
    sensors={
        "sensor1": "value",
        "sensor2": "TRY_CAST(get_json_object(props, '$.k') AS DOUBLE)",
    },
)

LINEITEM = ReadingSpec(
    device="l_suppkey",
    time="l_shipdate",
    sensors=dict(
        zip(SENSORS, ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"))
    ),
    keep=("l_orderkey", "l_partkey"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _readings(df: DataFrame, spec: ReadingSpec) -> DataFrame:
    readings = spec.bind(df)
    widen_shuffles(readings)
    return readings


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readings(table(spark, sf_dir, "events"), EVENTS)


def item_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readings(table(spark, sf_dir, "lineitem"), LINEITEM)


def event_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return device_dimension(named, "c_custkey", "c_name", "n_name")


def item_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return device_dimension(named, "s_suppkey", "s_name", "n_name")


def event_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day from the first event to the last."""
    return date_dimension_for(table(spark, sf_dir, "events"), "ts")


def item_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_dimension_for(table(spark, sf_dir, "lineitem"), "l_shipdate")


def wall_clock(df: DataFrame) -> DataFrame:
    """Timestamps as the wall clock time they were read from."""
    return df.select(
        [
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if f.dataType.typeName() == "timestamp"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Aggregates and predictions rounded.

    The last bits of a sum depend on the order of addition, which no engine
    fixes. Averages of cents over 32 rows can fall exactly on half a digit,
    where those bits would decide; the nudge moves them off it.
    """
    return df.withColumns({c: F.round(F.col(c) + NUDGE, digits) for c in columns})


@dataclass(frozen=True)
class Replayed:
    """Files in event-time order, and how many make a micro-batch."""

    path: str
    schema: object
    max_files: int


def replayed(
    df: DataFrame, sf_dir: str, source: str, fmt: str = "parquet", order: str = "datetime"
) -> Replayed:
    """Replay readings, in the order of a column, into files of about 64 MB of source, at least eight.

    A task sorts the rows of one file in memory, so its share must not grow with the table.

    A micro-batch takes as many files as keep the cores busy, but no more
    than a quarter of them, so that there are several batches at any size.
    """
    spark = df.sparkSession
    size = storage.total_bytes(spark, f"{sf_dir}/{source}.parquet")
    slices = max(8, min(math.ceil(size / REPLAY_BYTES), MOST_PARTITIONS))
    path = fresh_path(spark, f"replay-{source}")
    files = replay_files(df, path, order, slices, fmt)
    cores = spark.sparkContext.defaultParallelism
    per_batch = max(1, min(math.ceil(len(files) / 4), 4 * cores))
    return Replayed(path, df.schema, per_batch)
