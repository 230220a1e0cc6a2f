"""Silver whose devices may become known after their readings.

The device dimension is read anew for every micro-batch and kept in versions,
so each batch has one fixed answer. Readings of devices that no version knows
are kept; the batch that first sees a device also takes that device's waiting
readings. A device once known stays known, with its latest attributes.

A batch's rows are moved into the table last. Until then a retry does the
batch again from the version before it; from then on it changes nothing. So
every reading of a device that is ever known gets into silver exactly once.

What waits is stored by batch and read only when a device arrives, joined with
the arrivals: there is no keyed state, so a hot device burdens no single task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fleetgauge import storage
from fleetgauge.operators.dimensions import require_unique
from fleetgauge.operators.lookups import bounded_broadcast
from fleetgauge.operators.silver import Scorer, enrich, unknown_devices
from fleetgauge.schemas import SENSORS
from fleetgauge.sinks.snapshots import each_batch, finished_batches, read_batches

_COLUMNS = ("device", "deviceName", "location")


def versions_path(path: str) -> str:
    return f"{path.rstrip('/')}-devices"


def waiting_path(path: str) -> str:
    return f"{path.rstrip('/')}-unmatched"


def _version_before(spark: SparkSession, path: str, number: int) -> DataFrame | None:
    """The devices as they were known before a batch."""
    earlier = [n for n in finished_batches(spark, versions_path(path)) if n < number]
    if not earlier:
        return None
    return spark.read.parquet(f"{versions_path(path)}/batch_id={earlier[-1]}")


def known_devices(spark: SparkSession, path: str) -> DataFrame | None:
    """The latest version of the dimension."""
    return _version_before(spark, path, 2**63)


def waiting_readings(spark: SparkSession, path: str) -> DataFrame | None:
    """Readings whose device is still unknown, as they came."""
    batches = finished_batches(spark, waiting_path(path))
    if not batches:
        return None
    rows = read_batches(spark, waiting_path(path), batches).drop("batch_id")
    return unknown_devices(rows, known_devices(spark, path))


def start_late_silver(
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
    """Stream readings into silver; both loaders are called once per batch.

    A loader that finds two rows of one device is refused, as are its batches.
    """
    path = path.rstrip("/")

    def version(spark: SparkSession, number: int) -> tuple[DataFrame, DataFrame | None]:
        """The dimension for this batch, and the devices new in it."""
        loaded = require_unique(load_devices().select(*_COLUMNS), "device")
        place = f"{versions_path(path)}/batch_id={number}"
        before = _version_before(spark, path, number)
        if before is None:
            loaded.write.mode("overwrite").parquet(place)
            return spark.read.schema(loaded.schema).parquet(place), None
        changed = not loaded.exceptAll(before).isEmpty()
        if not changed and not storage.exists(spark, place):
            return before, None
        # A rest of an earlier attempt is written over.
        gone = before.join(loaded, "device", "left_anti").select(*_COLUMNS)
        loaded.unionByName(gone).write.mode("overwrite").parquet(place)
        current = spark.read.schema(before.schema).parquet(place)
        return current, current.join(before.select("device"), "device", "left_anti")

    def waiting_for(spark: SparkSession, arrived: DataFrame, number: int) -> DataFrame | None:
        batches = [n for n in finished_batches(spark, waiting_path(path)) if n < number]
        if not batches or arrived.isEmpty():
            return None
        rows = read_batches(spark, waiting_path(path), batches).drop("batch_id")
        return rows.join(bounded_broadcast(arrived.select("device")), "device", "left_semi")

    def write(batch: DataFrame, number: int) -> None:
        spark, name = batch.sparkSession, f"batch_id={number}"
        if storage.exists(spark, f"{path}/{name}"):
            return
        devices, arrived = version(spark, number)
        unknown = unknown_devices(batch, devices)
        unknown.write.mode("overwrite").parquet(f"{waiting_path(path)}/{name}")
        rows = batch
        late = waiting_for(spark, arrived, number) if arrived is not None else None
        if late is not None:
            rows = rows.unionByName(late.select(*rows.columns))
        staged = f"{path}/_incoming/{name}"
        enrich(rows, devices, load_dates(), scorer, sensors).write.mode("overwrite").parquet(staged)
        storage.move(spark, staged, f"{path}/{name}")

    return each_batch(bronze, path, write, "append", checkpoint, query_name, trigger)
