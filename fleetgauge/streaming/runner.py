"""Starting several streaming queries side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

Start = Callable[[], StreamingQuery]


def start_in_pool(spark: SparkSession, pool: str | None, start: Start) -> StreamingQuery:
    """Start a query whose jobs run in a scheduler pool.

    The query's thread inherits the property of the starting thread. Pools
    share the cluster only under ``spark.scheduler.mode=FAIR``.
    """
    context = spark.sparkContext
    before = context.getLocalProperty("spark.scheduler.pool")
    context.setLocalProperty("spark.scheduler.pool", pool)
    try:
        return start()
    finally:
        context.setLocalProperty("spark.scheduler.pool", before)


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait for an ``availableNow`` query to end; raises what it raised."""
    query.awaitTermination()
    return query


def rows_read(query: StreamingQuery) -> int:
    """Rows of the micro-batches that the query still has reports of."""
    return sum(p.numInputRows for p in query.recentProgress)


def rows_dropped_late(query: StreamingQuery) -> int:
    """Rows (after partial aggregation) that came behind the watermark."""
    return sum(
        op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators
    )
