"""Every query by name, over the given tables.

Each takes ``(spark, folder of parquet tables)`` and returns a frame. Those
that stream drain their streams first and return what was stored.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge import catalog
from fleetgauge.functions.codec import FORMATS, decode, encode, land, to_message
from fleetgauge.models.registry import ModelRegistry
from fleetgauge.models.scoring import linear_scorer, register_function, score, scorer
from fleetgauge.models.training import fit_linear, train_sensor_model
from fleetgauge.operators.alerts import alerts
from fleetgauge.operators.dimensions import date_bounds, date_dimension, require_unique, unmatched
from fleetgauge.operators.quality import (
    Expectation,
    apply_expectations,
    quality_metrics,
    rejected,
)
from fleetgauge.operators.silver import enrich, unknown_devices
from fleetgauge.operators.thresholds import derive_thresholds, device_statistics
from fleetgauge.operators.windows import flatten_window, window_averages
from fleetgauge.plans import bindings as b
from fleetgauge.plans.bi import SavedQueries
from fleetgauge.plans.flow import Flow
from fleetgauge.plans.medallion import BatchLayers, batch_layers, stream_layers
from fleetgauge.schemas import SENSORS
from fleetgauge.session import fresh_path, stateful_session, stored
from fleetgauge.settings import Settings
from fleetgauge.sinks.broker import stream_to_envelope_files
from fleetgauge.sinks.ledger import rule_totals
from fleetgauge.sinks.snapshots import read_all, read_latest
from fleetgauge.sinks.tables import overwrite_path, overwrite_table, stream_to_path, stream_to_table
from fleetgauge.sources.evolving import decode_all, merged_schema
from fleetgauge.sources.files import (
    infer_schema,
    ingest_files,
    load_reference_csv,
    read_json,
    stream_files,
)
from fleetgauge.sources.tables import stream_table
from fleetgauge.streaming.corrected import read_corrected_gold, start_corrected_gold
from fleetgauge.streaming.early import standing_alerts, start_early_alerts_log
from fleetgauge.streaming.late import start_late_silver
from fleetgauge.streaming.layers import (
    read_additive_gold,
    start_gold,
    start_refreshed_silver,
)
from fleetgauge.streaming.replay import replay_files
from fleetgauge.streaming.runner import drain
from fleetgauge.streaming.summaries import (
    read_distinct_count,
    read_statistics,
    start_distinct_count,
    start_moments,
)

Query = Callable[[SparkSession, str], DataFrame]

MEASURE = "sensor1_avg"

# Of hours in which little is sent, of Sundays, and of a ratio that a zero leaves open.
RULES = (
    Expectation("awake", "hourOfDay NOT BETWEEN 2 AND 3", "drop"),
    Expectation("notSunday", "CalendarDay != 'Sunday'"),
    Expectation("steepness", "sensor1 / nullif(sensor2, 0) <= 25"),
)

# A fixed linear model, to check scoring apart from fitting.
WEIGHTS = [0.05, 0.00002, -1.5, 2.0]
INTERCEPT = 3.0


def _settings(spark: SparkSession, name: str, **changes) -> Settings:
    return Settings(
        database=f"fleet_{uuid.uuid4().hex}",
        base_path=fresh_path(spark, name),
        trigger="availableNow",
        **changes,
    )


def _event_layers(spark: SparkSession, sf_dir: str) -> BatchLayers:
    """Layers that store gold once, since thresholds and alerts both need it."""
    return batch_layers(
        b.event_readings(spark, sf_dir),
        b.event_devices(spark, sf_dir),
        b.event_dates(spark, sf_dir),
        sensors=b.EVENT_SENSORS,
        measure=MEASURE,
    )


def _event_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(
        b.event_readings(spark, sf_dir),
        b.event_devices(spark, sf_dir),
        b.event_dates(spark, sf_dir),
        sensors=b.EVENT_SENSORS,
    )


def _event_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_averages(_event_silver(spark, sf_dir), b.EVENT_SENSORS)


def _present(df: DataFrame) -> DataFrame:
    """Gold or alert rows for comparison: flat, wall clock times, rounded."""
    if "start" in df.columns:
        df = df.drop("window").withColumnsRenamed({"start": "window_start", "end": "window_end"})
    else:
        df = flatten_window(df)
    computed = [c for c in df.columns if c.endswith("_avg") or c == "Threshold"]
    return b.rounded(b.wall_clock(df), *computed)


# Sources


def json_batch_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write readings as JSON, sample one file's schema, scan them all with it."""
    path = fresh_path(spark, "json")
    files = replay_files(b.event_readings(spark, sf_dir), path, "datetime", 8)
    return b.wall_clock(read_json(spark, path, infer_schema(spark, files[0])))


def json_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as JSON whose fields and types differ by file, read with the schema of all files."""
    events = b.table(spark, sf_dir, "events")
    fields = {
        0: ("CAST(floor(value) AS BIGINT) AS sensor1",),
        1: ("value AS sensor1", "TRY_CAST(get_json_object(props, '$.k') AS BIGINT) AS sensor2"),
        2: ("named_struct('kind', event_type, 'number', event_id) AS origin",),
    }
    folder = fresh_path(spark, "uneven-json")
    for k, columns in fields.items():
        rows = events.where(f"event_id % 3 = {k}").selectExpr(
            "user_id AS device", "CAST(ts AS TIMESTAMP) AS datetime", *columns
        )
        rows.write.options(**FORMATS).json(f"{folder}/source={k}")
    merged = merged_schema(spark, folder)
    rows = spark.read.schema(merged).options(**FORMATS).option("recursiveFileLookup", "true").json(folder)
    return b.wall_clock(
        rows.select("device", "datetime", "sensor1", "sensor2", "origin.kind", "origin.number")
    )


# Messages cut short, with a text for a number, with a field that nobody announced.
BROKEN_BY = """CASE event_id % 11
  WHEN 0 THEN left(body, length(body) - 6)
  WHEN 1 THEN replace(body, '"value":', '"value":"n/a","was":')
  WHEN 2 THEN replace(body, '"value":', '"firmware":"v2","value":')
  ELSE body END"""


def json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which some are broken by a fixed rule: decoded with their rest, or rejected."""
    events = b.table(spark, sf_dir, "events")
    body = events.select("event_id", to_message("user_id", "event_type", "value").alias("body"))
    topic, out = fresh_path(spark, "topic"), fresh_path(spark, "decoded")
    body.select("event_id", F.expr(BROKEN_BY).alias("body")).write.parquet(topic)
    messages = stream_files(spark, topic, "event_id bigint, body string", "parquet")
    schema = events.select("user_id", "event_type", "value").schema
    decoded = decode_all(messages, schema, "body", keep=("event_id",))
    drain(stream_to_path(decoded, out, fresh_path(spark, "cp"), trigger="availableNow"))
    rows = spark.read.schema(decoded.schema).parquet(out)
    return rows.withColumns({"rescued": F.to_json("rescued"), "raw": F.length("raw")})


def csv_reference_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device dimension through CSV into a table, keys checked."""
    path, settings = fresh_path(spark, "csv"), _settings(spark, "reference")
    b.event_devices(spark, sf_dir).write.option("header", True).csv(path)
    loaded = load_reference_csv(
        spark, path, "device BIGINT, deviceName STRING, location STRING", key="device"
    )
    stored = settings.data_path("device_info")
    overwrite_path(loaded, stored)
    catalog.init_catalog(spark, settings.database, settings.base_path)
    return catalog.external_table(spark, settings.table("device_info"), stored)


def bronze_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON files through incremental ingest into the bronze table."""
    source = b.replayed(b.event_readings(spark, sf_dir), sf_dir, "events", "json")
    settings = _settings(spark, "bronze")
    catalog.init_catalog(spark, settings.database, settings.base_path)
    stream = ingest_files(spark, source.path, source.schema, max_files=source.max_files)
    drain(
        stream_to_table(
            stream,
            settings.table("bronze"),
            settings.data_path("bronze"),
            settings.checkpoint_path("bronze"),
            "bronze",
            settings.trigger,
        )
    )
    return b.wall_clock(spark.table(settings.table("bronze")))


def training_table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite the training table and count it."""
    settings = _settings(spark, "training")
    catalog.init_catalog(spark, settings.database, settings.base_path)
    stored = overwrite_table(
        b.item_readings(spark, sf_dir), settings.table("training"), settings.data_path("training")
    )
    return stored.agg(F.count(F.lit(1)).alias("row_count"))


# Dimensions


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date dimension over the days of lineitem, as a view and then a table."""
    settings = _settings(spark, "dates")
    catalog.init_catalog(spark, settings.database, settings.base_path)
    b.item_dates(spark, sf_dir).createOrReplaceTempView("fleet_dates")
    return catalog.ctas_if_absent(
        spark, settings.table("dim_date"), settings.data_path("dim_date"), "SELECT * FROM fleet_dates"
    )


def silver_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings, as a stream, of devices that a dimension without one nation lacks."""
    events = b.table(spark, sf_dir, "events")
    rows = b.EVENTS.bind(stream_files(spark, f"{sf_dir}/event[s].parquet", events.schema, "parquet"))
    known = b.event_devices(spark, sf_dir).where("location <> 'NATION_3'")
    out = fresh_path(spark, "unmatched")
    lost = unknown_devices(rows, known).select("device", "datetime", *b.EVENT_SENSORS)
    drain(stream_to_path(lost, out, fresh_path(spark, "cp"), trigger="availableNow"))
    return b.wall_clock(spark.read.schema(lost.schema).parquet(out))


def unmatched_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings lost to a date dimension that ends halfway through their days."""
    readings = b.event_readings(spark, sf_dir)
    first, last = date_bounds(readings)
    early = date_dimension(spark, first, first + (last - first) // 2)
    return unmatched(readings, b.event_devices(spark, sf_dir), early)


def table_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts the catalog holds after analyzing the reference tables."""
    settings = _settings(spark, "statistics")
    catalog.init_catalog(spark, settings.database, settings.base_path)
    gold = _event_gold(spark, sf_dir)
    roles = {
        "device_info": b.event_devices(spark, sf_dir),
        "thresholds": derive_thresholds(gold, measure=MEASURE),
        "dim_date": b.item_dates(spark, sf_dir),
    }
    for name, df in roles.items():
        overwrite_table(df, settings.table(name), settings.data_path(name))
    tables = [settings.table(name) for name in roles]
    catalog.analyze(spark, *tables)
    return catalog.statistics(spark, *tables).select("table_name", "row_count")


# Silver


def silver_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.wall_clock(_event_silver(spark, sf_dir))


def silver_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fifteen silver columns, over lineitem."""
    silver = enrich(
        b.item_readings(spark, sf_dir),
        b.item_devices(spark, sf_dir),
        b.item_dates(spark, sf_dir),
        linear_scorer(WEIGHTS, INTERCEPT),
    )
    return b.rounded(b.wall_clock(silver), "sensor5Prediction")


def silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze table streamed through both joins into the silver table."""
    settings = _settings(spark, "silver")
    catalog.init_catalog(spark, settings.database, settings.base_path)
    bronze = settings.table("bronze")
    overwrite_table(b.event_readings(spark, sf_dir), bronze, settings.data_path("bronze"))
    silver = enrich(
        stream_table(spark, bronze),
        b.event_devices(spark, sf_dir),
        b.event_dates(spark, sf_dir),
        sensors=b.EVENT_SENSORS,
    )
    drain(
        stream_to_table(
            silver,
            settings.table("silver"),
            settings.data_path("silver"),
            settings.checkpoint_path("silver"),
            "silver",
            settings.trigger,
        )
    )
    return b.wall_clock(spark.table(settings.table("silver")))


def silver_refreshed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver whose dimensions are read again for every micro-batch."""
    source = b.replayed(b.event_readings(spark, sf_dir), sf_dir, "events")
    settings = _settings(spark, "refreshed")
    drain(
        start_refreshed_silver(
            stream_files(spark, source.path, source.schema, "parquet", source.max_files),
            lambda: b.event_devices(spark, sf_dir),
            lambda: b.event_dates(spark, sf_dir),
            settings.data_path("silver"),
            settings.checkpoint_path("silver"),
            sensors=b.EVENT_SENSORS,
            trigger=settings.trigger,
        )
    )
    return b.wall_clock(read_all(spark, settings.data_path("silver")).drop("batch_id"))


def silver_late_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver where the devices of half the nations are known only after half the readings."""
    events = b.event_readings(spark, sf_dir)
    devices, place = b.event_devices(spark, sf_dir), fresh_path(spark, "devices")
    settings, folder = _settings(spark, "late"), fresh_path(spark, "late-readings")
    even = F.pmod(F.xxhash64("datetime"), F.lit(2)) == 0
    known = F.pmod(F.xxhash64("location"), F.lit(2)) == 0
    for rows, found in ((even, known), (~even, ~known)):
        replay_files(events.where(rows), folder, "datetime", 8, "parquet")
        devices.where(found).write.mode("append").parquet(place)
        drain(
            start_late_silver(
                stream_files(spark, folder, events.schema, "parquet", 3),
                lambda: spark.read.schema(devices.schema).parquet(place),
                lambda: b.event_dates(spark, sf_dir),
                settings.data_path("silver"),
                settings.checkpoint_path("silver"),
                sensors=b.EVENT_SENSORS,
                trigger=settings.trigger,
            )
        )
    return b.wall_clock(spark.read.parquet(settings.data_path("silver")).drop("batch_id"))


def arrival_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest that stamps each reading with the time of its micro-batch."""
    source = b.replayed(b.event_readings(spark, sf_dir), sf_dir, "events", "json")
    out, begun = fresh_path(spark, "stamped"), dt.datetime.now(dt.timezone.utc)
    rows = ingest_files(
        spark, source.path, source.schema, max_files=source.max_files, stamp="arrival"
    )
    drain(stream_to_path(rows, out, fresh_path(spark, "cp"), trigger="availableNow"))
    ended = dt.datetime.now(dt.timezone.utc)
    within = F.col("datetime").between(F.lit(begun), F.lit(ended))
    found = spark.read.schema(rows.schema).parquet(out)
    return found.select("device", *b.EVENT_SENSORS, within.alias("stamped_in_run"))


# Quality


def silver_expect_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.wall_clock(apply_expectations(_event_silver(spark, sf_dir), RULES))


def silver_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rejected(_event_silver(spark, sf_dir), RULES)
    return b.wall_clock(found.withColumn("broken", F.array_join("broken", ",")))


def expectation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_metrics(_event_silver(spark, sf_dir), RULES)


# Gold


def gold_window_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _present(_event_gold(spark, sf_dir))


def sensor_wide_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five averages by supplier and window."""
    silver = enrich(
        b.item_readings(spark, sf_dir), b.item_devices(spark, sf_dir), b.item_dates(spark, sf_dir)
    )
    return _present(window_averages(silver))


def _gold_stream(spark: SparkSession, sf_dir: str, mode: str) -> str:
    source = b.replayed(_event_silver(spark, sf_dir), sf_dir, "events")
    settings = _settings(spark, f"gold-{mode}")
    session = stateful_session(spark)
    drain(
        start_gold(
            stream_files(session, source.path, source.schema, "parquet", source.max_files),
            settings.data_path("gold"),
            settings.checkpoint_path("gold"),
            mode,
            sensors=b.EVENT_SENSORS,
            trigger=settings.trigger,
        )
    )
    return settings.data_path("gold")


def gold_window_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete mode: the last snapshot holds every group."""
    path = _gold_stream(spark, sf_dir, "complete")
    return _present(read_latest(spark, path))


def gold_additive_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same answer from stateless partial sums."""
    path = _gold_stream(spark, sf_dir, "additive")
    return _present(read_additive_gold(spark, path, b.EVENT_SENSORS))


def gold_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode: windows the watermark has closed."""
    path = _gold_stream(spark, sf_dir, "append")
    return _present(spark.read.parquet(path))


def gold_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows and the corrections to them, after a replay in no order of time."""
    mixed = _event_silver(spark, sf_dir).withColumn("mixed", F.xxhash64("datetime", "device"))
    source = b.replayed(mixed, sf_dir, "events", order="mixed")
    settings = _settings(spark, "corrected")
    drain(
        start_corrected_gold(
            stream_files(spark, source.path, source.schema, "parquet", source.max_files),
            settings.data_path("gold"),
            settings.checkpoint_path("gold"),
            b.EVENT_SENSORS,
            trigger=settings.trigger,
        )
    )
    return _present(read_corrected_gold(spark, settings.data_path("gold"), b.EVENT_SENSORS))


def device_count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct devices from the sketches of each micro-batch."""
    source = b.replayed(_event_silver(spark, sf_dir), sf_dir, "events")
    out = fresh_path(spark, "sketches")
    rows = stream_files(spark, source.path, source.schema, "parquet", source.max_files)
    cp = fresh_path(spark, "cp")
    drain(start_distinct_count(rows, "deviceName", out, cp, trigger="availableNow"))
    return read_distinct_count(spark, out, "device_count")


# Thresholds and alerts


def threshold_statistics_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean, maximum and deviation from moments that each batch of windows stored."""
    source = b.replayed(_event_gold(spark, sf_dir), sf_dir, "events", order="window.start")
    out = fresh_path(spark, "moments")
    rows = stream_files(spark, source.path, source.schema, "parquet", source.max_files)
    drain(start_moments(rows, MEASURE, out, fresh_path(spark, "cp"), trigger="availableNow"))
    found = read_statistics(spark, out, MEASURE)
    return b.rounded(found, "sensor1_Avg", "sensor1_Max", "sensor1_Std")


def alerts_early(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows on which an alert stands, raised while they were open."""
    source = b.replayed(_event_silver(spark, sf_dir), sf_dir, "events")
    limits = stored(derive_thresholds(_event_gold(spark, sf_dir), measure=MEASURE), "thresholds")
    rows = stream_files(
        stateful_session(spark), source.path, source.schema, "parquet", source.max_files
    )
    settings = _settings(spark, "early")
    places = settings.data_path("events"), settings.checkpoint_path("events")
    drain(start_early_alerts_log(rows, limits, *places, MEASURE, trigger="availableNow"))
    found = standing_alerts(spark.read.parquet(places[0]))
    return _present(found.select("start", "end", "deviceName", "Threshold"))


def threshold_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = device_statistics(_event_gold(spark, sf_dir), MEASURE)
    return b.rounded(found, "sensor1_Avg", "sensor1_Max", "sensor1_Std")


def thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(
        derive_thresholds(_event_gold(spark, sf_dir), measure=MEASURE), "Threshold"
    )


def alerts_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _present(_event_layers(spark, sf_dir).alerts)


def alerts_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _event_layers(spark, sf_dir)
    return _present(alerts(layers.gold, layers.thresholds, MEASURE, ordered=True))


def alerts_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts on the fifth sensor, over lineitem."""
    layers = batch_layers(
        b.item_readings(spark, sf_dir), b.item_devices(spark, sf_dir), b.item_dates(spark, sf_dir)
    )
    return _present(layers.alerts)


def alerts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four layers as streams; one alert row per closed window."""
    source = b.replayed(b.event_readings(spark, sf_dir), sf_dir, "events", "json")
    settings = _settings(spark, "layers")
    limits = stored(derive_thresholds(_event_gold(spark, sf_dir), measure=MEASURE), "thresholds")
    stream_layers(
        spark,
        settings,
        ingest_files(spark, source.path, source.schema, max_files=source.max_files),
        b.event_devices(spark, sf_dir),
        b.event_dates(spark, sf_dir),
        limits,
        sensors=b.EVENT_SENSORS,
        measure=MEASURE,
    )
    return _present(spark.read.parquet(settings.data_path("alerts")))


# Messages


def envelope_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream whole rows out as messages, and decode what was sent."""
    schema = b.table(spark, sf_dir, "events").schema
    rows = stream_files(spark, f"{sf_dir}/event[s].parquet", schema, "parquet")
    topic = fresh_path(spark, "topic")
    messages = encode(rows, keep=("event_id",))
    drain(stream_to_envelope_files(messages, topic, fresh_path(spark, "cp"), "event_id"))
    return decode(spark.read.parquet(topic), schema, "body")


def landing_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages into a landing table partitioned by date of arrival.

    The event time stands in for the arrival time, which a rerun would change.
    """
    events = b.table(spark, sf_dir, "events")
    path, out = fresh_path(spark, "topic"), fresh_path(spark, "landing")
    envelope = events.select(
        to_message("user_id", "event_type", "value", "props").cast("binary").alias("body"),
        F.col("event_id").alias("sequenceNumber"),
        F.col("ts").cast("timestamp").alias("enqueuedTime"),
    )
    envelope.write.parquet(path)
    fields = "user_id STRING, event_type STRING, value STRING, props STRING"
    landed = land(stream_files(spark, path, envelope.schema, "parquet"), fields)
    drain(
        stream_to_path(
            landed,
            out,
            fresh_path(spark, "cp"),
            trigger="availableNow",
            partition_by=("stream_date",),
        )
    )
    return spark.read.parquet(out)


def stream_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A limit on a stream counts rows over the whole query, not per batch."""
    source = b.replayed(b.event_readings(spark, sf_dir), sf_dir, "events")
    out = fresh_path(spark, "limited")
    stream = stream_files(
        stateful_session(spark), source.path, source.schema, "parquet", source.max_files
    )
    drain(stream_to_path(stream.limit(500), out, fresh_path(spark, "cp"), trigger="availableNow"))
    return spark.read.parquet(out).agg(F.count(F.lit(1)).alias("row_count"))


# Models


def _scored_rows(df: DataFrame, digits: int = 4) -> DataFrame:
    kept = df.select("l_orderkey", "l_partkey", "device", "sensor5", "sensor5Prediction")
    return b.rounded(kept, "sensor5Prediction", digits=digits)


def model_score_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = b.item_readings(spark, sf_dir)
    return _scored_rows(linear_scorer(WEIGHTS, INTERCEPT)(readings), digits=6)


def model_fit_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least squares of the fifth sensor on the other four, then every row scored."""
    readings = b.item_readings(spark, sf_dir)
    return _scored_rows(score(readings, fit_linear(readings)))


def model_registered_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, register, promote, load by stage, and call from SQL."""
    readings = b.item_readings(spark, sf_dir)
    registry = ModelRegistry(spark, fresh_path(spark, "models"))
    version = registry.register("SensorRegression", fit_linear(readings))
    registry.describe("SensorRegression", version, "Predicts sensor5 from the first four sensors.")
    registry.transition("SensorRegression", version, "Production")
    register_function(spark, registry.load("SensorRegression", stage="Production"), "sensorPredictor")
    readings.createOrReplaceTempView("fleet_readings")
    return _scored_rows(
        spark.sql(
            "SELECT *, sensorPredictor(sensor1, sensor2, sensor3, sensor4) AS sensor5Prediction "
            "FROM fleet_readings"
        )
    )


def model_stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score a stream of readings with a fitted model."""
    readings = b.item_readings(spark, sf_dir)
    predict = scorer(fit_linear(readings))
    source = b.replayed(readings, sf_dir, "lineitem")
    out = fresh_path(spark, "scored")
    stream = stream_files(spark, source.path, source.schema, "parquet", source.max_files)
    drain(stream_to_path(predict(stream), out, fresh_path(spark, "cp"), trigger="availableNow"))
    return _scored_rows(spark.read.parquet(out))


def model_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search over three families for a rule that is known, and score every row with the winner."""
    planted = linear_scorer(WEIGHTS, INTERCEPT)(b.item_readings(spark, sf_dir))
    readings = planted.withColumn("sensor5", F.col("sensor5Prediction")).drop("sensor5Prediction")
    found = train_sensor_model(
        readings, features=SENSORS[:4], trials_path=fresh_path(spark, "trials")
    )
    return _scored_rows(score(readings, found.model)).drop("sensor5")


# Tables and flows


def compact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small files packed into few without a shuffle."""
    settings = _settings(spark, "compact")
    catalog.init_catalog(spark, settings.database, settings.base_path)
    path, name = settings.data_path("readings"), settings.table("readings")
    b.event_readings(spark, sf_dir).repartition(64).write.parquet(path)
    catalog.external_table(spark, name, path)
    return b.wall_clock(catalog.compact_table(spark, name, settings.base_path))


def compact_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for a table partitioned by day."""
    settings = _settings(spark, "compact")
    catalog.init_catalog(spark, settings.database, settings.base_path)
    path, name = settings.data_path("readings"), settings.table("readings")
    dated = b.event_readings(spark, sf_dir).withColumn("stream_date", F.to_date("datetime"))
    dated.write.partitionBy("stream_date").parquet(path)
    catalog.external_table(spark, name, path)
    packed = catalog.compact_table(spark, name, settings.base_path, partition_by="stream_date")
    return b.wall_clock(packed)


BUSY_SQL = """
WITH hours AS (
  SELECT location, hourOfDay, count(*) AS readings, max(sensor1) AS highest
  FROM silver GROUP BY location, hourOfDay
), places AS (
  SELECT location, max(readings) AS most FROM hours GROUP BY location
)
SELECT hours.location, hours.hourOfDay, hours.readings, hours.highest
FROM hours JOIN places ON hours.location = places.location AND hours.readings = places.most
"""


def _silver_flow(spark: SparkSession, sf_dir: str) -> Flow:
    """Bronze and silver as a declared flow over replayed files, and a summary in SQL."""
    source = b.replayed(b.event_readings(spark, sf_dir), sf_dir, "events", "json")
    flow = Flow(spark, _settings(spark, "flow"))
    flow.view(
        "raw",
        lambda s, _: ingest_files(s, source.path, source.schema, max_files=source.max_files),
    )
    flow.table("bronze", lambda s, i: i["raw"], reads=("raw",), comment="Readings as received")
    flow.view("device_info", lambda s, _: b.event_devices(s, sf_dir))
    flow.view("dim_date", lambda s, _: b.event_dates(s, sf_dir))
    flow.table(
        "silver",
        lambda s, i: enrich(i["bronze"], i["device_info"], i["dim_date"], sensors=b.EVENT_SENSORS),
        reads=("device_info", "dim_date"),
        streams=("bronze",),
        comment="Readings with device and calendar attributes",
        expectations=RULES,
    )
    flow.sql_table("busy_hours", BUSY_SQL, reads=("silver",), comment="The fullest hours of a place")
    flow.run()
    return flow


def flow_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    flow = _silver_flow(spark, sf_dir)
    return b.wall_clock(spark.table(flow.settings.table("silver")).drop("batch_id"))


def flow_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts from the ledger that the flow's stream wrote."""
    flow = _silver_flow(spark, sf_dir)
    return rule_totals(spark, flow.settings.data_path("silver")).drop("action")


def flow_busy_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that the flow builds by SQL with common table expressions."""
    return spark.table(_silver_flow(spark, sf_dir).settings.table("busy_hours"))


def flow_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each definition of the flow is made of, and how many rows that holds."""
    flow = _silver_flow(spark, sf_dir)
    counts = [
        spark.table(flow.settings.table(name)).agg(
            F.lit(name).alias("ancestor"), F.count("*").alias("ancestor_rows")
        )
        for name, node in flow.nodes.items()
        if node.stored
    ]
    return flow.ancestry().join(reduce(DataFrame.unionByName, counts), "ancestor", "left")


# Saved queries


def _saved(spark: SparkSession, sf_dir: str, *roles: str) -> SavedQueries:
    """Store the tables that a saved query needs."""
    settings = _settings(spark, "bi")
    catalog.init_catalog(spark, settings.database, settings.base_path)
    builders = {
        "device_info": lambda: require_unique(b.event_devices(spark, sf_dir), "device"),
        "dim_date": lambda: b.event_dates(spark, sf_dir),
        "bronze": lambda: b.event_readings(spark, sf_dir),
        "silver": lambda: _event_silver(spark, sf_dir),
        "gold": lambda: _event_gold(spark, sf_dir),
        "thresholds": lambda: derive_thresholds(
            spark.table(settings.table("gold")), measure=MEASURE
        ),
    }
    for role in roles:
        overwrite_table(builders[role](), settings.table(role), settings.data_path(role))
    return SavedQueries(spark, settings)


def bi_sensor_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _saved(spark, sf_dir, "device_info").sensor_reference()


def bi_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _saved(spark, sf_dir, "dim_date").date_dimension()


def bi_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.wall_clock(_saved(spark, sf_dir, "silver").silver())


def bi_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _present(_saved(spark, sf_dir, "gold").gold())


def bi_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    saved = _saved(spark, sf_dir, "gold", "thresholds")
    return _present(saved.alerts(ordered=True, measure=MEASURE))


def bi_device_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.wall_clock(_saved(spark, sf_dir, "silver").device(8))


def device_drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.wall_clock(b.event_readings(spark, sf_dir).where("device = 8"))


def device_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _saved(spark, sf_dir, "gold").device_count()


def bi_star_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings by place and weekday through the star schema's views."""
    saved = _saved(spark, sf_dir, "device_info", "dim_date", "silver", "gold")
    star = saved.star_schema()
    fact = star["fact_reading"].groupBy("device", "CalendarDate").agg(
        F.count(F.lit(1)).alias("n"), F.sum("sensor1").alias("total")
    )
    by_place = (
        fact.join(star["dim_device"], "device")
        .join(star["dim_calendar"], "CalendarDate")
        .groupBy("location", "CalendarDay", "IsWeekDay")
        .agg(F.sum("n").alias("readings"), (F.sum("total") / F.sum("n")).alias("sensor1_avg"))
    )
    return b.rounded(by_place, "sensor1_avg")


REGISTERED: tuple[Query, ...] = (
    alerts_current,
    alerts_early,
    alerts_ordered,
    alerts_stream,
    alerts_wide,
    arrival_stamped,
    bi_alerts,
    bi_dates,
    bi_device_silver,
    bi_gold,
    bi_sensor_reference,
    bi_silver,
    bi_star_schema,
    bronze_stream_ingest,
    compact_partitioned,
    compact_table,
    csv_reference_load,
    device_count,
    device_count_stream,
    device_drilldown,
    dim_date,
    envelope_roundtrip,
    expectation_metrics,
    flow_busy_hours,
    flow_lineage,
    flow_quality,
    flow_silver,
    gold_additive_stream,
    gold_closed_windows,
    gold_corrected,
    gold_window_batch,
    gold_window_stream,
    json_batch_scan,
    json_rejects,
    json_schema_merge,
    landing_partitioned,
    model_fit_linear,
    model_registered_function,
    model_score_linear,
    model_search,
    model_stream_score,
    sensor_wide_windows,
    silver_enriched,
    silver_expect_drop,
    silver_late_device,
    silver_refreshed_stream,
    silver_rejected,
    silver_scored,
    silver_stream,
    stream_limit,
    table_statistics,
    threshold_statistics,
    threshold_statistics_stream,
    thresholds,
    training_table_count,
    silver_unmatched,
    unmatched_counts,
)


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in REGISTERED}
