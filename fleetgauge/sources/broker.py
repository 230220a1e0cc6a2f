"""Kafka-compatible brokers: connection options and the stream source.

The connector is a separate jar. Nothing here imports it; Spark looks the
format up when the stream is built.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class BrokerConnection:
    """How to reach a broker. ``password`` comes from the caller's secret store."""

    servers: str
    topic: str
    username: str | None = None
    password: str | None = None
    session_timeout_ms: int = 60_000
    request_timeout_ms: int = 30_000

    def __repr__(self) -> str:
        return f"BrokerConnection(servers={self.servers!r}, topic={self.topic!r})"

    def client_options(self) -> dict[str, str]:
        """Options shared by the source and the sink."""
        options = {
            "kafka.bootstrap.servers": self.servers,
            "kafka.request.timeout.ms": str(self.request_timeout_ms),
        }
        if self.password is not None:
            options |= {
                "kafka.security.protocol": "SASL_SSL",
                "kafka.sasl.mechanism": "PLAIN",
                "kafka.sasl.jaas.config": (
                    "org.apache.kafka.common.security.plain.PlainLoginModule required "
                    f'username="{self.username}" password="{self.password}";'
                ),
            }
        return options


def starting_offsets(
    position: str | dict[int, int], topic: str | None = None
) -> str:
    """Start position in the source's own words.

    Takes ``"earliest"``, ``"latest"``, the AMQP spellings ``"-1"`` and
    ``"@latest"`` of the same, or offsets by partition.
    """
    if isinstance(position, dict):
        if topic is None:
            raise ValueError("offsets by partition need the topic")
        return json.dumps({topic: {str(p): o for p, o in sorted(position.items())}})
    # Start positions of the two protocols.
    words = {"earliest": "earliest", "-1": "earliest", "latest": "latest", "@latest": "latest"}
    if position not in words:
        raise ValueError(f"unknown start position {position!r}")
    return words[position]


def source_options(
    connection: BrokerConnection,
    start: str | dict[int, int] = "earliest",
    max_per_trigger: int | None = None,
    group: str | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    options = connection.client_options() | {
        "subscribe": connection.topic,
        "startingOffsets": starting_offsets(start, connection.topic),
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "kafka.session.timeout.ms": str(connection.session_timeout_ms),
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if group:
        options["kafka.group.id"] = group
    return options


def broker_stream(spark: SparkSession, connection: BrokerConnection, **settings) -> DataFrame:
    """Messages of a topic; see :func:`source_options` for the settings."""
    return spark.readStream.format("kafka").options(**source_options(connection, **settings)).load()


def as_envelope(messages: DataFrame) -> DataFrame:
    """Kafka's columns under the names of the message envelope."""
    return messages.selectExpr(
        "value AS body", "offset AS sequenceNumber", "timestamp AS enqueuedTime"
    )
