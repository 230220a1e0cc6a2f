"""Databases, tables, views and their upkeep."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fleetgauge import storage
from fleetgauge.session import MOST_PARTITIONS


def init_catalog(
    spark: SparkSession, database: str, location: str | None = None, reset: bool = False
) -> None:
    """Create the database; ``reset`` first drops it with all its tables.

    External files outlive a reset. A fresh run takes a fresh base path, so
    nothing has to be wiped in place under a running reader.
    """
    if reset:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def external_table(
    spark: SparkSession,
    table: str,
    path: str,
    fmt: str = "parquet",
    comment: str | None = None,
    schema: T.StructType | None = None,
    partition_by: str | None = None,
) -> DataFrame:
    """(Re)create a table over existing files, of which the schema is inferred unless given."""
    drop_table(spark, table)
    columns = ""
    if schema is not None:
        columns = "(" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ")"
        columns += f" USING {fmt}" + (f" PARTITIONED BY (`{partition_by}`)" if partition_by else "")
    spark.sql(f"CREATE TABLE {table} {columns or f'USING {fmt}'} LOCATION '{path}'")
    partitioned = any(c.isPartition for c in spark.catalog.listColumns(table))
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    if comment:
        comment_on(spark, table, comment)
    return spark.table(table)


def comment_on(spark: SparkSession, table: str, comment: str) -> None:
    text = comment.replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {table} IS '{text}'")


def create_view(spark: SparkSession, view: str, query: str) -> DataFrame:
    """Create or replace a persistent view from SQL text."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {query}")
    return spark.table(view)


def ctas_if_absent(
    spark: SparkSession, table: str, path: str, query: str, fmt: str = "parquet"
) -> DataFrame:
    """Materialise a query at a location unless the table is already there."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING {fmt} LOCATION '{path}' AS {query}")
    return spark.table(table)


def analyze(spark: SparkSession, *tables: str) -> None:
    for table in tables:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")


def statistics(spark: SparkSession, *tables: str) -> DataFrame:
    """Row count and bytes the catalog holds for each analyzed table."""
    found = []
    for table in tables:
        details = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Statistics'")
        text = details.first()["data_type"]  # "1234 bytes, 56 rows"
        numbers = [int(word) for word in text.replace(",", "").split() if word.isdigit()]
        found.append((table.split(".")[-1], numbers[0], numbers[1]))
    return spark.createDataFrame(found, "table_name string, size_bytes bigint, row_count bigint")


def save_dimension(
    df: DataFrame, table: str, path: str, key: str, buckets: int | None = None
) -> DataFrame:
    """Overwrite a dimension table.

    ``buckets`` clusters and sorts it by its key, so that a dimension too
    large to broadcast is not shuffled again for every join or micro-batch.
    """
    writer = df.write.format("parquet").mode("overwrite").option("path", path)
    if buckets:
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def compact_path(
    spark: SparkSession,
    source: str,
    target: str,
    file_bytes: int = 2**30,
    partition_by: str | None = None,
    schema: T.StructType | None = None,
) -> str:
    """Rewrite many small parquet files as few of about ``file_bytes`` each.

    Unpartitioned data needs no shuffle: the scan itself packs small files
    into tasks of the wanted size and each task writes one file. Partitioned
    data is rebalanced on the partition column, which lets adaptive execution
    merge small partitions and split one that holds most of the rows. Values of
    partition columns are in the folders' names, as text: their types are inferred
    unless ``schema`` gives them.
    """
    if partition_by:
        session = spark.newSession()
        session.conf.set("spark.sql.adaptive.enabled", "true")
        session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(file_bytes))
        # A hot partition is split between the tasks that read it, so none
        # of them may read more than one file's worth.
        session.conf.set("spark.sql.files.maxPartitionBytes", str(file_bytes))
        wanted = min(math.ceil(storage.total_bytes(spark, source) / file_bytes), MOST_PARTITIONS)
        current = int(spark.conf.get("spark.sql.shuffle.partitions"))
        session.conf.set("spark.sql.shuffle.partitions", str(max(wanted, current)))
        df = _parquet(session, source, schema)
        df.hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(target)
        return target
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(file_bytes))
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    _parquet(session, source, schema).write.parquet(target)
    return target


def _parquet(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def compact_table(
    spark: SparkSession,
    table: str,
    base_path: str,
    file_bytes: int = 2**30,
    partition_by: str | None = None,
) -> DataFrame:
    """Compact a table's files into a new folder, then point the table there.

    Readers of the old files are not disturbed; the old folder stays until
    its owner retires it. Schema and comment stay. A table that a stream appends
    to is refused: the stream's log of its files lies in the old folder.
    """
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    source = details.first()["data_type"]
    target = f"{base_path.rstrip('/')}/compact-{uuid.uuid4().hex}"
    if storage.exists(spark, f"{source}/_spark_metadata"):
        raise ValueError(f"{table} is written by a stream, which could not go on after a compaction")
    schema, comment = spark.table(table).schema, spark.catalog.getTable(table).description
    compact_path(spark, source, target, file_bytes, partition_by, schema)
    return external_table(
        spark, table, target, comment=comment, schema=schema, partition_by=partition_by
    )

