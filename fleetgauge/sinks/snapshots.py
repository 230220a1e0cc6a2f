"""Sinks that write one folder per micro-batch.

A folder is named after its batch and overwritten when the batch is retried,
so a retry after a crash changes nothing. Batches are counted by the checkpoint,
so a folder belongs to one checkpoint and another is refused. Complete output keeps the latest
folder as the table; update and partial output keep all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fleetgauge import storage
from fleetgauge.sinks.tables import with_trigger

_PREFIX = "batch_id="
_OWNER = "_checkpoint-"


def _folder(path: str, batch: int) -> str:
    return f"{path.rstrip('/')}/{_PREFIX}{batch}"


def finished_batches(spark: SparkSession, path: str, after: int = -1) -> list[int]:
    """Batches later than ``after`` whose write job has committed, in order."""
    found = [n for n in storage.names(spark, path) if n.startswith(_PREFIX)]
    numbers = sorted(n for n in (int(f.removeprefix(_PREFIX)) for f in found) if n > after)
    return [b for b in numbers if storage.exists(spark, f"{_folder(path, b)}/_SUCCESS")]


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete snapshot."""
    batches = finished_batches(spark, path)
    if not batches:
        raise FileNotFoundError(f"no finished snapshot in {path}")
    return spark.read.parquet(_folder(path, batches[-1]))


def read_all(spark: SparkSession, path: str) -> DataFrame:
    """The rows of every finished batch, with their ``batch_id``."""
    batches = finished_batches(spark, path)
    if not batches:
        raise FileNotFoundError(f"no finished batch in {path}")
    return read_batches(spark, path, batches)


def read_batches(spark: SparkSession, path: str, batches: list[int]) -> DataFrame:
    folders = [_folder(path, b) for b in batches]
    return spark.read.option("basePath", path).parquet(*folders)


def _take(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Mark a folder as this checkpoint's; refuse one whose batches it would overwrite."""
    mark = _OWNER + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]
    held = storage.names(spark, path)
    owners = [n for n in held if n.startswith(_OWNER)]
    written = any(n.startswith(_PREFIX) for n in held)
    resumed = storage.exists(spark, f"{checkpoint.rstrip('/')}/metadata")
    if (owners and mark not in owners) or (written and not resumed):
        raise ValueError(
            f"{path} holds the batches of another checkpoint than {checkpoint}; "
            "go on with that one, or write to a new folder"
        )
    storage.make_folder(spark, path)
    storage.claim(spark, f"{path.rstrip('/')}/{mark}")


def each_batch(
    df: DataFrame,
    path: str,
    write: Callable[[DataFrame, int], None],
    mode: str,
    checkpoint: str,
    query_name: str | None,
    trigger: str | None,
) -> StreamingQuery:
    _take(df.sparkSession, path, checkpoint)
    writer = (
        df.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    return with_trigger(writer, trigger).start()


def stream_complete(
    df: DataFrame,
    path: str,
    checkpoint: str,
    view: str | None = None,
    query_name: str | None = None,
    trigger: str | None = "10 seconds",
    keep: int = 3,
) -> StreamingQuery:
    """Complete output: each batch writes the whole result as a new snapshot.

    ``view`` is a persistent view moved to each new snapshot. The newest
    ``keep`` snapshots stay, so that running readers finish; older ones are
    deleted.
    """
    if keep < 2:
        raise ValueError("keep at least two snapshots: readers may be on the last one")

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        folder = _folder(path, number)
        batch.write.mode("overwrite").parquet(folder)
        if view:
            spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{folder}`")
        for old in finished_batches(spark, path)[:-keep]:
            storage.drop_folder(spark, _folder(path, old))

    return each_batch(df, path, write, "complete", checkpoint, query_name, trigger)


def stream_changes(
    df: DataFrame,
    path: str,
    checkpoint: str,
    query_name: str | None = None,
    trigger: str | None = "10 seconds",
) -> StreamingQuery:
    """Update output: each batch writes the groups it changed."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(_folder(path, number))

    return each_batch(df, path, write, "update", checkpoint, query_name, trigger)


def stream_batches(
    df: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    query_name: str | None = None,
    trigger: str | None = "10 seconds",
) -> StreamingQuery:
    """Write ``transform(batch)`` for each micro-batch of a stateless stream.

    ``transform`` is plain batch code: it may re-read a dimension for every
    batch, or aggregate the batch, without any streaming state.
    """

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(_folder(path, number))

    return each_batch(df, path, write, "append", checkpoint, query_name, trigger)
