"""The four layers over one set of readings, in batch and as streams."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fleetgauge import storage
from fleetgauge.operators.alerts import alerts
from fleetgauge.operators.lookups import bounded_broadcast
from fleetgauge.operators.silver import Scorer, enrich, unknown_devices
from fleetgauge.operators.thresholds import derive_thresholds
from fleetgauge.operators.windows import window_averages
from fleetgauge.schemas import SENSORS
from fleetgauge.session import stateful_session, stored, widen_shuffles
from fleetgauge.settings import Settings
from fleetgauge.sinks.tables import stream_to_path
from fleetgauge.sources.files import stream_files
from fleetgauge.streaming.late import start_late_silver
from fleetgauge.streaming.layers import start_alerts_log, start_gold
from fleetgauge.streaming.runner import drain, start_in_pool

LAYERS = ("bronze", "silver", "gold", "alerts", "silver_unmatched")


@dataclass(frozen=True)
class BatchLayers:
    silver: DataFrame
    gold: DataFrame
    thresholds: DataFrame
    alerts: DataFrame


def batch_layers(
    readings: DataFrame,
    devices: DataFrame,
    dates: DataFrame,
    thresholds: DataFrame | None = None,
    scorer: Scorer | None = None,
    sensors: tuple[str, ...] = SENSORS,
    measure: str = "sensor5_avg",
    window: str = "30 seconds",
) -> BatchLayers:
    """All layers as frames.

    The sizes of the dimensions are measured at once. Without given thresholds they are derived from
    gold, which two branches then read: gold and the thresholds are written
    to the shared folder first, so that the readings are scanned and shuffled
    once and gold, with the thresholds broadcast, not again.
    """
    widen_shuffles(readings)
    silver = enrich(readings, devices, dates, scorer, sensors)
    gold = window_averages(silver, sensors, window)
    if thresholds is None:
        gold = stored(gold, "gold")
        thresholds = stored(derive_thresholds(gold, measure=measure), "thresholds")
    thresholds = bounded_broadcast(thresholds)
    return BatchLayers(silver, gold, thresholds, alerts(gold, thresholds, measure))


def stream_layers(
    spark: SparkSession,
    settings: Settings,
    bronze: DataFrame,
    devices: DataFrame | Callable[[], DataFrame],
    dates: DataFrame | Callable[[], DataFrame],
    thresholds: DataFrame,
    scorer: Scorer | None = None,
    sensors: tuple[str, ...] = SENSORS,
    measure: str = "sensor5_avg",
) -> dict[str, StreamingQuery]:
    """Start one query per layer, coupled through parquet folders.

    Under ``availableNow`` each layer is drained before the next starts;
    otherwise all run side by side in the pools of the settings. Gold is
    append mode, so alerts hold one row per closed window. A fifth query stores
    the readings of unknown devices, as they came, in ``silver_unmatched``.

    With a function in place of ``devices``, the dimension is read anew for
    every batch of silver, and readings of devices that come later are joined
    then; see :mod:`fleetgauge.streaming.late`, which also keeps what waits.
    """
    stateful = stateful_session(spark)
    drained = settings.trigger == "availableNow"
    queries: dict[str, StreamingQuery] = {}

    def run(name: str, start: Callable[[], StreamingQuery]) -> None:
        pool = settings.pools[len(queries) % len(settings.pools)] if settings.pools else None
        queries[name] = start_in_pool(spark, pool, start)
        if drained:
            drain(queries[name])

    def source(session: SparkSession, name: str, schema) -> DataFrame:
        path = settings.data_path(name)
        storage.make_folder(session, path)
        return stream_files(
            session,
            path,
            schema,
            "parquet",
            settings.max_files_per_trigger,
            settings.max_bytes_per_trigger,
        )

    def places(name: str) -> dict:
        return {
            "path": settings.data_path(name),
            "checkpoint": settings.checkpoint_path(name),
            "query_name": name,
            "trigger": settings.trigger,
        }

    run("bronze", lambda: stream_to_path(bronze, **places("bronze")))
    live = callable(devices)
    known_dates = dates() if callable(dates) else dates
    silver = enrich(
        source(spark, "bronze", bronze.schema), devices() if live else devices, known_dates, scorer, sensors
    )
    schema = silver.schema
    if live:
        rows = source(spark, "bronze", bronze.schema)
        load_dates = dates if callable(dates) else lambda: dates
        run(
            "silver",
            lambda: start_late_silver(rows, devices, load_dates, scorer=scorer, sensors=sensors, **places("silver")),
        )
        schema = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    else:
        run("silver", lambda: stream_to_path(silver, **places("silver")))
    silver_rows = source(stateful, "silver", schema).drop("batch_id")
    gold_schema = window_averages(silver_rows, sensors, settings.window).schema
    run(
        "gold",
        lambda: start_gold(
            silver_rows,
            mode="append",
            sensors=sensors,
            window=settings.window,
            watermark=settings.watermark,
            **places("gold"),
        ),
    )
    closed = source(spark, "gold", gold_schema)
    run("alerts", lambda: start_alerts_log(closed, thresholds, measure=measure, **places("alerts")))
    if not live:
        unmatched = unknown_devices(source(spark, "bronze", bronze.schema), devices)
        run("silver_unmatched", lambda: stream_to_path(unmatched, **places("silver_unmatched")))
    return queries
