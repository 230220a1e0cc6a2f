"""Replay of a stored table as a stream of files in event-time order."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge import storage
from fleetgauge.functions.codec import FORMATS


def replay_files(
    df: DataFrame, path: str, time_col: str, slices: int, fmt: str = "json"
) -> list[str]:
    """Split ``df`` by time into about ``slices`` files that stream in order.

    The file source takes files by modification time. One job writes all
    files, range partitioned on the time; a hash of the row splits a time
    that very many rows share. Each file then gets a later modification time
    than the one before and is moved into ``path``, where a running stream
    sees only finished files. Returns the paths in order.
    """
    spark = df.sparkSession
    storage.make_folder(spark, path)
    staging = f"{path.rstrip('/')}/_incoming-{uuid.uuid4().hex}"
    spread = F.xxhash64(*df.columns)
    ordered = df.repartitionByRange(slices, F.col(time_col), spread)
    ordered.sortWithinPartitions(time_col).write.format(fmt).options(**FORMATS).save(staging)

    parts = [n for n in storage.names(spark, staging) if n.startswith("part-")]
    first = int(time.time() * 1000) - 1000 * len(parts)
    published = []
    for i, part in enumerate(parts):
        storage.set_modified(spark, f"{staging}/{part}", first + 1000 * i)
        target = f"{path.rstrip('/')}/slice-{i:06d}-{part}"
        storage.move(spark, f"{staging}/{part}", target)
        published.append(target)
    storage.drop_folder(spark, staging)

    times = [storage.modified(spark, p) for p in published]
    if any(later <= earlier for earlier, later in zip(times, times[1:])):
        raise OSError(f"the file system of {path} keeps no distinct modification times")
    return published
