"""File operations on whatever file system a path names, through Hadoop."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.mkdirs(p)


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if somebody else already has."""
    fs, p = _open(spark, path)
    return fs.createNewFile(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Entry names of one folder, sorted; empty when it does not exist."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(p))


def modified(spark: SparkSession, path: str) -> int:
    fs, p = _open(spark, path)
    return fs.getFileStatus(p).getModificationTime()


def set_modified(spark: SparkSession, path: str, millis: int) -> None:
    fs, p = _open(spark, path)
    fs.setTimes(p, millis, -1)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _open(spark, source)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot move {source} to {target}")


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)


def total_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _open(spark, path)
    return fs.getContentSummary(p).getLength()
