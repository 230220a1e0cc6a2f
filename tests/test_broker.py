import json

import pytest
from pyspark.errors import AnalysisException

from fleetgauge.sinks.broker import sink_options, stream_to_broker
from fleetgauge.sources.broker import (
    BrokerConnection,
    as_envelope,
    broker_stream,
    source_options,
    starting_offsets,
)

PLAIN = BrokerConnection("host:9092", "iot")
SECURE = BrokerConnection("host:9093", "iot", "user", "secret")


def test_source_options():
    options = source_options(SECURE, group="readers", max_per_trigger=50_000)
    assert options["subscribe"] == "iot"
    assert options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "50000"
    assert options["failOnDataLoss"] == "true"
    assert options["kafka.group.id"] == "readers"
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert 'password="secret"' in options["kafka.sasl.jaas.config"]
    assert (options["kafka.session.timeout.ms"], options["kafka.request.timeout.ms"]) == (
        "60000", "30000",
    )
    bare = source_options(PLAIN, max_per_trigger=None)
    assert "maxOffsetsPerTrigger" not in bare
    assert not any("sasl" in key for key in bare)


def test_sink_options_are_producer_options():
    options = sink_options(SECURE)
    assert options["topic"] == "iot" and options["kafka.batch.size"] == "5000"
    assert "subscribe" not in options and "kafka.group.id" not in options


def test_secret_is_not_shown():
    assert "secret" not in repr(SECURE)


def test_start_positions():
    assert starting_offsets("-1") == "earliest"
    assert starting_offsets("@latest") == "latest"
    assert json.loads(starting_offsets({1: 5, 0: 7}, "iot")) == {"iot": {"0": 7, "1": 5}}
    for wrong in ("yesterday", {0: 1}):
        with pytest.raises(ValueError):
            starting_offsets(wrong)


def test_without_the_connector_spark_says_so(spark, tmp_path):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        broker_stream(spark, PLAIN)
    rate = spark.readStream.format("rate").load().selectExpr("CAST(value AS STRING) AS payload")
    with pytest.raises(Exception, match="(?i)kafka"):
        stream_to_broker(rate, PLAIN, str(tmp_path), payload="payload")


def test_envelope_names(spark):
    messages = spark.sql("SELECT 'x' AS value, 3L AS offset, current_timestamp() AS timestamp, 't' AS topic")
    assert as_envelope(messages).columns == ["body", "sequenceNumber", "enqueuedTime"]
