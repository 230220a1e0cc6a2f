"""Message sinks: a Kafka-compatible broker, or files of the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetgauge.sinks.tables import stream_to_path, with_trigger
from fleetgauge.sources.broker import BrokerConnection


def sink_options(connection: BrokerConnection, batch_bytes: int = 5_000) -> dict[str, str]:
    """Producer options; the batch size is in bytes, as producers define it."""
    return connection.client_options() | {
        "topic": connection.topic,
        "kafka.batch.size": str(batch_bytes),
    }


def stream_to_broker(
    messages: DataFrame,
    connection: BrokerConnection,
    checkpoint: str,
    payload: str = "value",
    query_name: str | None = None,
    trigger: str | None = "10 seconds",
    **settings,
) -> StreamingQuery:
    """Send the ``payload`` column; each query needs a checkpoint of its own."""
    writer = (
        messages.select(F.col(payload).alias("value"))
        .writeStream.format("kafka")
        .options(**sink_options(connection, **settings))
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    return with_trigger(writer, trigger).start()


def stream_to_envelope_files(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    sequence: str,
    payload: str = "value",
    query_name: str | None = None,
    trigger: str | None = "availableNow",
) -> StreamingQuery:
    """Write messages as files with the columns a broker would deliver.

    Stands in for a broker where none is at hand; the column ``sequence``
    takes the place of the number a broker would give.
    """
    envelope = messages.select(
        F.col(payload).cast("binary").alias("body"),
        F.col(sequence).alias("sequenceNumber"),
        F.current_timestamp().alias("enqueuedTime"),
    )
    return stream_to_path(envelope, path, checkpoint, query_name, trigger)
