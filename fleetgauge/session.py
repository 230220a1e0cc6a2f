"""Session helpers: shared work folders and sessions for stateful queries."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# The driver tracks every map task against every reducer. Beyond this many,
# larger partitions, which may spill, cost less than the bookkeeping.
MOST_PARTITIONS = 20_000

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without it; it gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="fleetgauge-")
    return _local_folders[application]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/fleetgauge/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder once and read it from there.

    For a result that several branches of a plan need: the table outlives
    lost executors, and each branch reads only its columns.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def widen_shuffles(df: DataFrame, target: int = 256 * 2**20) -> int:
    """Raise the session's shuffle width to suit a frame that will be shuffled.

    Adaptive execution merges partitions that turn out small, but it cannot
    make more of them. What the frame reads is added up from the statistics
    of its sources, which runs nothing; sources of unknown size do not count.
    Never lowers the setting, and stops at ``MOST_PARTITIONS``.
    """
    spark = df.sparkSession
    unknown = spark._jsparkSession.sessionState().conf().defaultSizeInBytes()
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    estimate = sum(size for size in sizes if size < unknown)
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(math.ceil(estimate / target), MOST_PARTITIONS)
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return max(wanted, current)


def stateful_session(
    spark: SparkSession, partitions: int | None = None, rocksdb: bool = True
) -> SparkSession:
    """A sister session, same catalog, set up for queries that keep state.

    The number of state partitions is pinned by a query's first checkpoint
    and adaptive execution cannot change it, so it follows the cores of the
    cluster unless given. RocksDB keeps state off the JVM heap and uploads
    change logs instead of whole snapshots.
    """
    sister = spark.newSession()
    for key, value in [(r["key"], r["value"]) for r in spark.sql("SET").collect()]:
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            sister.conf.set(key, value)
    cores = spark.sparkContext.defaultParallelism
    sister.conf.set("spark.sql.shuffle.partitions", str(partitions or cores))
    if rocksdb:
        sister.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        sister.conf.set(
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
        )
    return sister
