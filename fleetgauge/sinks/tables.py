"""Table sinks, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def overwrite_table(
    df: DataFrame,
    table: str,
    path: str,
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = (),
) -> DataFrame:
    """Replace an external table, and return it."""
    writer = df.write.format(fmt).mode("overwrite").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def overwrite_path(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Replace the files of a folder, and return what is there now."""
    df.write.format(fmt).mode("overwrite").save(path)
    return df.sparkSession.read.format(fmt).load(path)


def with_trigger(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """``"availableNow"`` drains the source and stops; else an interval."""
    if trigger is None:
        return writer
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def stream_to_path(
    df: DataFrame,
    path: str,
    checkpoint: str,
    query_name: str | None = None,
    trigger: str | None = "10 seconds",
    partition_by: tuple[str, ...] = (),
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append a stream to a folder, exactly once."""
    return _append(df, checkpoint, query_name, trigger, partition_by, fmt).start(path)


def stream_to_table(
    df: DataFrame,
    table: str,
    path: str,
    checkpoint: str,
    query_name: str | None = None,
    trigger: str | None = "10 seconds",
    partition_by: tuple[str, ...] = (),
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append a stream to an external table, exactly once.

    Complete output needs :mod:`fleetgauge.sinks.snapshots`: the file sink
    only appends.
    """
    writer = _append(df, checkpoint, query_name, trigger, partition_by, fmt)
    return writer.option("path", path).toTable(table)


def _append(df, checkpoint, query_name, trigger, partition_by, fmt) -> DataStreamWriter:
    writer = (
        df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return with_trigger(writer, trigger)


def preview(df: DataFrame, rows: int = 20, truncate: bool = True) -> StreamingQuery | None:
    """Print some rows, of each micro-batch if the frame is a stream."""
    if not df.isStreaming:
        df.show(rows, truncate)
        return None
    writer = df.writeStream.format("console").option("numRows", rows).option("truncate", truncate)
    return writer.start()
