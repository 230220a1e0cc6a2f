"""Gold that keeps what comes late: closed windows, and corrections to them.

Each batch adds sums and counts of its windows, once and without any state.
What the batches before it have seen sets the watermark, the latest event time
less a delay. Windows that end behind it are closed; rows of theirs that still
come go to the corrections. The closed windows never change, and together with
the corrections they give the answer of a batch job, in whatever order the
readings came. A reader may take either, or both.

The latest event time is stored with each batch, and the batch is moved into
the table last, so a retry finds the same watermark and changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetgauge import storage
from fleetgauge.operators.windows import WATERMARK, WINDOW, merge_partials, window_partials
from fleetgauge.schemas import SENSORS
from fleetgauge.sinks.ledger import published_batches
from fleetgauge.sinks.snapshots import each_batch

_MARK = "latest timestamp"


def marks_path(path: str) -> str:
    return f"{path.rstrip('/')}-marks"


def _latest_before(spark: SparkSession, path: str, number: int | None = None):
    """Latest event time of the batches before one, or of all."""
    earlier = [n for n in published_batches(spark, path) if number is None or n < number]
    if not earlier:
        return None
    return spark.read.schema(_MARK).parquet(f"{marks_path(path)}/batch_id={earlier[-1]}").first().latest


def _closed(latest, watermark: str) -> Column:
    """Whether a window ends behind the watermark."""
    if latest is None:
        return F.lit(False)
    return F.col("window.end") <= F.lit(latest) - F.expr(f"INTERVAL {watermark}")


def start_corrected_gold(
    silver: DataFrame,
    path: str,
    checkpoint: str,
    sensors: tuple[str, ...] = SENSORS,
    window: str = WINDOW,
    watermark: str = WATERMARK,
    query_name: str | None = None,
    trigger: str | None = "10 seconds",
) -> StreamingQuery:
    path = path.rstrip("/")

    def write(batch: DataFrame, number: int) -> None:
        spark, name = batch.sparkSession, f"batch_id={number}"
        if storage.exists(spark, f"{path}/{name}"):
            return
        before = _latest_before(spark, path, number)
        # The largest value is the same however often a task is run again.
        seen = Observation(f"latest-{uuid.uuid4().hex}")
        sums = window_partials(batch.observe(seen, F.max("datetime").alias("latest")), sensors, window)
        staged = f"{path}/_incoming/{name}"
        late = sums.withColumn("late", _closed(before, watermark))
        late.write.mode("overwrite").partitionBy("late").parquet(staged)
        latest = max((t for t in (before, seen.get["latest"]) if t is not None), default=None)
        mark = spark.createDataFrame([(latest,)], _MARK).coalesce(1)
        mark.write.mode("overwrite").parquet(f"{marks_path(path)}/{name}")
        storage.move(spark, staged, f"{path}/{name}")

    return each_batch(silver, path, write, "append", checkpoint, query_name, trigger)


def _sums(spark: SparkSession, path: str, sensors: tuple[str, ...]) -> DataFrame:
    columns = [f"{s}_sum double" for s in sensors] + [f"{s}_n bigint" for s in sensors]
    window = "window struct<start: timestamp, end: timestamp>"
    schema = ", ".join([window, "deviceName string", *columns, "late boolean", "batch_id bigint"])
    return spark.read.schema(schema).parquet(path)


def read_closed_gold(
    spark: SparkSession, path: str, sensors: tuple[str, ...] = SENSORS, watermark: str = WATERMARK
) -> DataFrame:
    """Windows behind the watermark, as they were when it passed them."""
    on_time = _sums(spark, path, sensors).where("NOT late")
    return merge_partials(on_time.where(_closed(_latest_before(spark, path), watermark)), sensors)


def read_corrected_gold(
    spark: SparkSession,
    path: str,
    sensors: tuple[str, ...] = SENSORS,
    watermark: str | None = None,
) -> DataFrame:
    """All windows with their corrections; with ``watermark``, only those behind it."""
    rows = _sums(spark, path, sensors)
    if watermark:
        rows = rows.where(_closed(_latest_before(spark, path), watermark))
    return merge_partials(rows, sensors)


def read_corrections(
    spark: SparkSession, path: str, sensors: tuple[str, ...] = SENSORS
) -> DataFrame:
    """Windows that late rows changed or added: averages before (null if new) and after."""
    rows = _sums(spark, path, sensors)
    keys = ["window", "deviceName"]
    touched = rows.where("late").select(*keys).distinct()
    changed = rows.join(touched, keys, "left_semi")
    before = merge_partials(changed.where("NOT late"), sensors)
    before = before.withColumnsRenamed({f"{s}_avg": f"{s}_before" for s in sensors})
    return merge_partials(changed, sensors).join(before, keys, "left")
