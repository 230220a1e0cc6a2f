"""Figures of a stream that add up: distinct counts and moments, per batch.

Each micro-batch stores a small summary. Summaries merge in any order and in
any grouping, so readers get the figures of all batches without going through
the rows again, and no state is held between batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetgauge.operators.thresholds import FACTOR
from fleetgauge.sinks.snapshots import read_all, stream_batches

# 2 ** 14 registers: relative error 0.65 % (one deviation), exact up to some 1,500 values.
SKETCH_BITS = 14


def distinct_sketch(df: DataFrame, column: str, by: tuple[str, ...] = ()) -> DataFrame:
    """A sketch of the distinct values of a column, per group."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(column, F.lit(SKETCH_BITS)).alias("sketch"))


def estimated_distinct(sketches: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The number of distinct values in the union of sketches."""
    union = F.hll_union_agg("sketch")
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(union).alias(name))


def start_distinct_count(
    rows: DataFrame,
    column: str,
    path: str,
    checkpoint: str,
    by: tuple[str, ...] = (),
    query_name: str | None = None,
    trigger: str | None = "10 seconds",
) -> StreamingQuery:
    return stream_batches(
        rows, lambda batch: distinct_sketch(batch, column, by), path, checkpoint, query_name, trigger
    )


def read_distinct_count(
    spark: SparkSession, path: str, name: str, by: tuple[str, ...] = ()
) -> DataFrame:
    return estimated_distinct(read_all(spark, path), name, by)


def moments(df: DataFrame, measure: str, by: tuple[str, ...] = ("deviceName",)) -> DataFrame:
    """Count, mean, sum of squared distances from the mean, and maximum, per group."""
    return df.groupBy(*by).agg(
        F.count(measure).alias("n"),
        F.avg(measure).alias("mean"),
        (F.var_pop(measure) * F.count(measure)).alias("m2"),
        F.max(measure).alias("most"),
    )


def merged_moments(parts: DataFrame, by: tuple[str, ...] = ("deviceName",)) -> DataFrame:
    """The moments of all rows, from those of any parts of them.

    Distances are moved from each part's mean to the common one, so nothing
    large is subtracted from something large.
    """
    held = parts.where("n > 0")
    common = held.groupBy(*by).agg(
        F.sum("n").alias("all_n"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("all_mean"),
        F.max("most").alias("most"),
    )
    moved = held.drop("most").join(common, list(by))
    off = F.col("mean") - F.col("all_mean")
    known = moved.groupBy(*by).agg(
        F.first("all_n").alias("n"),
        F.first("all_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * off * off).alias("m2"),
        F.first("most").alias("most"),
    )
    # Groups of nulls only keep their row.
    return parts.select(*by).distinct().join(known, list(by), "left")


def start_moments(
    gold: DataFrame,
    measure: str,
    path: str,
    checkpoint: str,
    query_name: str | None = None,
    trigger: str | None = "10 seconds",
) -> StreamingQuery:
    """Moments of the window averages of each device, stored per batch."""
    return stream_batches(
        gold, lambda batch: moments(batch, measure), path, checkpoint, query_name, trigger
    )


def read_statistics(spark: SparkSession, path: str, measure: str = "sensor5_avg") -> DataFrame:
    """Mean, maximum and sample deviation per device, as ``device_statistics`` gives them."""
    stem = measure.removesuffix("_avg")
    known = merged_moments(read_all(spark, path))
    spread = F.sqrt(F.col("m2") / F.nullif(F.col("n") - 1, F.lit(0)))
    return known.select(
        "deviceName",
        F.col("mean").alias(f"{stem}_Avg"),
        F.col("most").alias(f"{stem}_Max"),
        spread.alias(f"{stem}_Std"),
    )


def read_thresholds(
    spark: SparkSession, path: str, measure: str = "sensor5_avg", factor: float = FACTOR
) -> DataFrame:
    """Thresholds as ``derive_thresholds`` gives them, from the stored maxima."""
    most = read_all(spark, path).groupBy("deviceName").agg(F.max("most").alias("most"))
    return most.select("deviceName", (F.col("most") * factor).alias("Threshold"))
