"""One streaming query per layer, coupled only through stored tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetgauge.operators.alerts import alerts
from fleetgauge.operators.lookups import bounded_broadcast
from fleetgauge.operators.silver import Scorer, enrich
from fleetgauge.operators.windows import (
    WATERMARK,
    WINDOW,
    merge_partials,
    window_averages,
    window_partials,
)
from fleetgauge.schemas import SENSORS
from fleetgauge.sinks.snapshots import (
    finished_batches,
    read_batches,
    stream_batches,
    stream_changes,
    stream_complete,
)
from fleetgauge.sinks.tables import stream_to_path

GOLD_MODES = ("append", "complete", "additive")


def start_refreshed_silver(
    bronze: DataFrame,
    load_devices: Callable[[], DataFrame],
    load_dates: Callable[[], DataFrame],
    path: str,
    checkpoint: str,
    scorer: Scorer | None = None,
    sensors: tuple[str, ...] = SENSORS,
    query_name: str | None = None,
    trigger: str | None = "10 seconds",
) -> StreamingQuery:
    """Silver that reads the dimensions anew for every micro-batch.

    A static frame lists its files once, when it is made; a plain stream
    would not see devices that are added while it runs.
    """

    def transform(batch: DataFrame) -> DataFrame:
        return enrich(batch, load_devices(), load_dates(), scorer, sensors)

    return stream_batches(bronze, transform, path, checkpoint, query_name, trigger)


def start_gold(
    silver: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    sensors: tuple[str, ...] = SENSORS,
    window: str = WINDOW,
    watermark: str = WATERMARK,
    view: str | None = None,
    query_name: str | None = None,
    trigger: str | None = "10 seconds",
) -> StreamingQuery:
    """Window averages as a stream.

    ``append``: each window once, after the watermark closed it; bounded
    state, rows later than the watermark are lost. ``complete``: the whole
    result anew each batch, late rows included; state and output grow with
    the number of groups. ``additive``: the answer of ``complete`` without
    state, from sums and counts that each batch adds; read it with
    :func:`read_additive_gold`.
    """
    if mode not in GOLD_MODES:
        raise ValueError(f"mode is one of {GOLD_MODES}, not {mode!r}")
    if mode == "additive":
        return stream_batches(
            silver,
            lambda batch: window_partials(batch, sensors, window),
            path,
            checkpoint,
            query_name,
            trigger,
        )
    averages = window_averages(silver, sensors, window, watermark)
    if mode == "complete":
        return stream_complete(averages, path, checkpoint, view, query_name, trigger)
    return stream_to_path(averages, path, checkpoint, query_name, trigger)


def _partials(
    spark: SparkSession, path: str, sensors: tuple[str, ...]
) -> tuple[DataFrame, int | None]:
    """Every partial row once, and the last batch among them that is not folded."""
    folds = finished_batches(spark, f"{path}/folded")
    upto = folds[-1] if folds else -1
    later = finished_batches(spark, path, after=upto)
    columns = ["window", "deviceName", *[f"{s}_{k}" for k in ("sum", "n") for s in sensors]]
    parts = []
    if folds:
        parts.append(read_batches(spark, f"{path}/folded", folds[-1:]).select(columns))
    if later:
        parts.append(read_batches(spark, path, later).select(columns))
    if not parts:
        raise FileNotFoundError(f"no finished batch in {path}")
    return reduce(DataFrame.unionByName, parts), (later[-1] if later else None)


def read_additive_gold(
    spark: SparkSession, path: str, sensors: tuple[str, ...] = SENSORS
) -> DataFrame:
    return merge_partials(_partials(spark, path, sensors)[0], sensors)


def fold_additive_gold(
    spark: SparkSession, path: str, sensors: tuple[str, ...] = SENSORS
) -> None:
    """Add up the partial rows of all finished batches, to keep reads short.

    The sums go to ``folded/batch_id=<last batch>``, and only batches after
    that one are read beside it. It may run while the stream runs; an
    unfinished fold is ignored.
    """
    partials, last = _partials(spark, path, sensors)
    if last is None:
        return
    sums = [f"{s}_{k}" for k in ("sum", "n") for s in sensors]
    folded = partials.groupBy("window", "deviceName").agg(*[F.sum(c).alias(c) for c in sums])
    folded.write.mode("overwrite").parquet(f"{path}/folded/batch_id={last}")


def start_alerts_log(
    closed_windows: DataFrame,
    thresholds: DataFrame,
    path: str,
    checkpoint: str,
    measure: str = "sensor5_avg",
    query_name: str | None = None,
    trigger: str | None = "10 seconds",
) -> StreamingQuery:
    """Exactly one alert row per closed window above its threshold.

    ``closed_windows`` streams the append-mode gold table.
    """
    found = alerts(closed_windows, bounded_broadcast(thresholds), measure)
    return stream_to_path(found, path, checkpoint, query_name, trigger)


def start_early_alerts(
    silver: DataFrame,
    thresholds: DataFrame,
    path: str,
    checkpoint: str,
    measure: str = "sensor5_avg",
    sensors: tuple[str, ...] = SENSORS,
    window: str = WINDOW,
    watermark: str = WATERMARK,
    query_name: str | None = None,
    trigger: str | None = "10 seconds",
) -> StreamingQuery:
    """Alert while a window is still open, again whenever it changes.

    A window may alert and later fall below its threshold; unchanged windows
    are not repeated.
    """
    changed = window_averages(silver, sensors, window, watermark)
    found = alerts(changed, bounded_broadcast(thresholds), measure)
    return stream_changes(found, path, checkpoint, query_name, trigger)
