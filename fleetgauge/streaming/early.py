"""One alert while a window is still open, taken back if later rows undo it.

Each (device, window) keeps its sum, its count and whether it has alerted.
The first average above the threshold emits ``raised``; one that falls back
emits ``retracted``, and it may rise again. When the watermark has passed the
window's end, a timer emits ``closed`` with the final average, if the window
stands above its threshold, and the state goes. Rows later than that are lost;
``lateness`` says how long to wait for them.

Every task adds up its rows by device and window before they are shuffled, so
a hot device sends a row per task and window to the task that keeps its state.

State is kept by groups of windows: those of one shard of the devices that start
within the same hour. A call serves a group, not a window, so a backlog costs calls
by its length in time, and a group holds open windows only. More devices than some
hundreds of thousands want more shards, which a checkpoint pins.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from fleetgauge.operators.lookups import bounded_broadcast
from fleetgauge.operators.windows import WATERMARK, WINDOW
from fleetgauge.sinks.tables import stream_to_path

# Times are whole microseconds on the way through Python, which knows no session time zone.
_EVENTS = (
    "deviceName string, start_us long, end_us long, version int, kind string, "
    "average double, Threshold double"
)
_COLUMNS = [c.split()[0] for c in _EVENTS.split(", ")]
_GIVEN = ("deviceName", "start_us", "end_us", "total", "n", "Threshold")
_PARTIAL = "deviceName string, start_us long, end_us long, total double, n long"
# The open windows of a group, as one Arrow table: arrays of a state schema are pickled value by value.
_WINDOWS = pa.schema(
    [
        ("deviceName", pa.string()),
        ("start_us", pa.int64()),
        ("end_us", pa.int64()),
        ("total", pa.float64()),
        ("n", pa.int64()),
        ("raised", pa.bool_()),
        ("version", pa.int32()),
        ("Threshold", pa.float64()),
    ]
)

SPAN = 60 * 60 * 1_000_000
SHARDS = 16


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = ["deviceName", "start_us", "end_us"]
    for batch in batches:
        sums = pa.Table.from_batches([batch]).group_by(keys).aggregate([("value", "sum"), ("value", "count")])
        sums = sums.select([*keys, "value_sum", "value_count"]).rename_columns([*keys, "total", "n"])
        yield from sums.to_batches()


def _due(end: int) -> int:
    """The watermark in milliseconds that closes a window."""
    return -(-end // 1000)


class _Alerting(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("windows", "windows binary")

    def _windows(self) -> dict[tuple, tuple]:
        """Facts of the open windows by device and start."""
        held = self._state.get()
        if not held:
            return {}
        columns = pa.ipc.open_stream(held[0]).read_all().columns
        return {(name, start): facts for name, start, *facts in zip(*(c.to_pylist() for c in columns))}

    def _keep(self, windows: dict[tuple, tuple]) -> None:
        """Store the windows, with a timer for the first to end."""
        if not windows:
            self._state.clear()
            return
        values = zip(*((*at, *facts) for at, facts in windows.items()))
        table = pa.table([pa.array(v, f.type) for v, f in zip(values, _WINDOWS)], schema=_WINDOWS)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _WINDOWS) as writer:
            writer.write_table(table)
        self._state.update((sink.getvalue().to_pybytes(),))
        self._handle.registerTimer(_due(min(facts[0] for facts in windows.values())))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        windows, touched, events = self._windows(), set(), []
        for frame in rows:
            for name, start, end, more, count, threshold in zip(*(frame[c].tolist() for c in _GIVEN)):
                end, total, n, raised, version, _ = windows.get((name, start)) or (end, 0.0, 0, False, 0, None)
                windows[name, start] = (end, total + more, n + count, raised, version, threshold)
                touched.add((name, start))
        for at in touched:
            end, total, n, raised, version, threshold = windows[at]
            above = n > 0 and total / n > threshold
            if above != raised:
                version += 1
                events.append((*at, end, version, "raised" if above else "retracted", total / n, threshold))
                windows[at] = (end, total, n, above, version, threshold)
        self._keep(windows)
        if events:
            yield pd.DataFrame(events, columns=_COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark, still, events = timerValues.getCurrentWatermarkInMs(), {}, []
        for at, facts in self._windows().items():
            end, total, n, raised, version, threshold = facts
            if _due(end) > watermark:
                still[at] = facts
            elif raised:
                events.append((*at, end, version + 1, "closed", total / n, threshold))
        self._keep(still)
        if events:
            yield pd.DataFrame(events, columns=_COLUMNS)


def early_alerts(
    silver: DataFrame,
    thresholds: DataFrame,
    measure: str = "sensor5_avg",
    window: str = WINDOW,
    lateness: str = WATERMARK,
    shards: int = SHARDS,
) -> DataFrame:
    """The stream of raised, retracted and closed alerts.

    A device without a threshold, or a null one, never alerts.
    """
    cut = F.window("datetime", window)
    rows = silver.where("datetime IS NOT NULL").select(
        "deviceName",
        F.unix_micros(cut.start).alias("start_us"),
        F.unix_micros(cut.end).alias("end_us"),
        F.col(measure.removesuffix("_avg")).cast("double").alias("value"),
    )
    limits = thresholds.select("deviceName", "Threshold").where("Threshold IS NOT NULL")
    sums = rows.mapInArrow(_added_up, _PARTIAL)
    sums = sums.withColumn("_end", F.timestamp_micros("end_us")).withWatermark("_end", lateness)
    known = sums.join(bounded_broadcast(limits), "deviceName").select(
        F.floor(F.col("start_us") / SPAN).alias("span"),
        F.pmod(F.xxhash64("deviceName"), F.lit(shards)).alias("shard"),
        "deviceName",
        "start_us",
        "end_us",
        F.coalesce("total", F.lit(0.0)).alias("total"),
        "n",
        "Threshold",
        "_end",
    )
    events = known.groupBy("span", "shard").transformWithStateInPandas(
        _Alerting(), _EVENTS, "Append", "EventTime"
    )
    return events.select(
        "deviceName",
        F.timestamp_micros("start_us").alias("start"),
        F.timestamp_micros("end_us").alias("end"),
        "version",
        "kind",
        "average",
        "Threshold",
    )


def start_early_alerts_log(
    silver: DataFrame,
    thresholds: DataFrame,
    path: str,
    checkpoint: str,
    measure: str = "sensor5_avg",
    window: str = WINDOW,
    lateness: str = WATERMARK,
    query_name: str | None = None,
    trigger: str | None = "10 seconds",
) -> StreamingQuery:
    """Append the events; ``silver`` streams in a session for stateful queries."""
    events = early_alerts(silver, thresholds, measure, window, lateness)
    return stream_to_path(events, path, checkpoint, query_name, trigger)


def standing_alerts(events: DataFrame) -> DataFrame:
    """Windows whose last event is no retraction, with the average of that event."""
    last = F.max_by(F.struct("kind", "average", "Threshold", "end"), "version").alias("last")
    found = events.groupBy("deviceName", "start").agg(last).where("last.kind <> 'retracted'")
    return found.select("start", "last.end", "deviceName", "last.average", "last.Threshold", "last.kind")
