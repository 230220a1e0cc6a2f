"""A streamed table that keeps the rule counts of every micro-batch beside it.

A batch is written to a hidden folder while its rules are counted in the same
pass, its counts go to the ledger, and then the folder is moved into the
table. The move makes the batch: until then a retry writes both again, from
then on it changes nothing. So neither rows nor counts are lost or doubled by
a restart, a crash at any point or a retried batch, and readers and streams of
the table see whole batches only.

The table has ``batch_id`` as a partition column; the ledger is a folder next
to it with one entry per batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetgauge import storage
from fleetgauge.operators.quality import Expectation, apply_expectations, metric_columns
from fleetgauge.sinks.snapshots import each_batch

BATCH = "batch_id"
ENTRY = "rule string, action string, passed bigint, failed bigint, nulls bigint"
_COUNTS = ("passed", "failed", "nulls")


def ledger_path(path: str) -> str:
    return f"{path.rstrip('/')}-rules"


def published_batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches that are in the table, in order, from one listing."""
    found = [n for n in storage.names(spark, path) if n.startswith(f"{BATCH}=")]
    return sorted(int(n.removeprefix(f"{BATCH}=")) for n in found)


def _entry(rules: Iterable[Expectation], counts: dict) -> list[tuple]:
    return [(r.name, r.action, *(counts[f"{r.name}_{k}"] for k in _COUNTS)) for r in rules]


def stream_with_ledger(
    df: DataFrame,
    rules: Iterable[Expectation],
    path: str,
    checkpoint: str,
    table: str | None = None,
    query_name: str | None = None,
    trigger: str | None = "10 seconds",
    partition_by: tuple[str, ...] = (),
) -> StreamingQuery:
    """Append the rows that the rules let through, and count all rows by rule.

    With ``table``, the folder is also a table of the catalog.
    """
    rules = tuple(rules)
    spark = df.sparkSession
    path = path.rstrip("/")
    if table:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        parts = ", ".join(f"`{c}`" for c in (BATCH, *partition_by))
        storage.make_folder(spark, path)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {BATCH} bigint) "
            f"USING parquet PARTITIONED BY ({parts}) LOCATION '{path}'"
        )
        # A batch may have been moved just before a crash.
        spark.sql(f"MSCK REPAIR TABLE {table}")

    def register(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        if table and partition_by:
            session.sql(f"MSCK REPAIR TABLE {table}")
        elif table:
            session.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({BATCH} = {number})")

    def write(batch: DataFrame, number: int) -> None:
        session, name = batch.sparkSession, f"{BATCH}={number}"
        if not storage.exists(session, f"{path}/{name}"):
            seen = Observation(f"rules-{uuid.uuid4().hex}")
            counted = batch.observe(seen, *metric_columns(rules)) if rules else batch
            staged = f"{path}/_incoming/{name}"
            kept = apply_expectations(counted, rules).write.mode("overwrite")
            (kept.partitionBy(*partition_by) if partition_by else kept).parquet(staged)
            rows = _entry(rules, seen.get) if rules else []
            entry = session.createDataFrame(rows, ENTRY).coalesce(1)
            entry.write.mode("overwrite").parquet(f"{ledger_path(path)}/{name}")
            storage.move(session, staged, f"{path}/{name}")
        register(batch, number)

    return each_batch(df, path, write, "append", checkpoint, query_name, trigger)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """One row per rule and batch that is in the table."""
    batches = published_batches(spark, path)
    schema = f"{ENTRY}, {BATCH} bigint"
    if not batches:
        return spark.createDataFrame([], schema)
    # Only the last entry can be of a batch that is not in the table yet.
    return spark.read.schema(schema).parquet(ledger_path(path)).where(F.col(BATCH) <= batches[-1])


def rule_totals(spark: SparkSession, path: str) -> DataFrame:
    """Counts of each rule over all batches, whoever wrote them."""
    entries = read_ledger(spark, path).groupBy("rule", "action")
    return entries.agg(*[F.sum(k).alias(k) for k in _COUNTS])
