"""Table sources, static and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def stream_table(
    spark: SparkSession, table: str, max_files: int | None = None, max_bytes: str | None = None
) -> DataFrame:
    """Stream the rows appended to a table, whole or throttled."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.table(table)


def view_of_table(spark: SparkSession, table: str, view: str) -> DataFrame:
    """Expose a catalog table under a session-local name."""
    df = spark.table(table)
    df.createOrReplaceTempView(view)
    return df


def register_stream(df: DataFrame, view: str) -> DataFrame:
    """Name a (streaming) frame so that SQL can read it."""
    df.createOrReplaceTempView(view)
    return df
