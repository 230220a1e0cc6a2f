"""File sources: schema sampling, batch scans, incremental ingest, CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.operators.dimensions import require_unique


def infer_schema(spark: SparkSession, sample_path: str, time_col: str = "datetime") -> T.StructType:
    """Schema of one JSON sample, with the event time forced to TIMESTAMP.

    JSON inference leaves ISO timestamps as text. Sample one file: inferring
    from a whole directory reads all of it before the real read starts.
    """
    found = spark.read.json(sample_path).schema
    return T.StructType(
        [
            T.StructField(f.name, T.TimestampType()) if f.name == time_col else f
            for f in found.fields
        ]
    )


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Batch scan of JSON lines with a fixed schema, so without inference."""
    return spark.read.schema(schema).json(path)


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    fmt: str = "json",
    max_files: int | None = None,
    max_bytes: str | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Stream the files of a folder as they appear, oldest first.

    ``max_files`` and ``max_bytes`` throttle a micro-batch; Spark takes one
    of them. Without a schema, parquet takes that of the files present. Every
    trigger lists the folder, so a folder that fills up for long should move
    finished files to ``archive``, a folder outside it.
    """
    if max_files and max_bytes:
        raise ValueError("throttle by files or by bytes, not by both")
    if schema is None:
        if fmt != "parquet":
            raise ValueError("text formats need a schema; see infer_schema()")
        schema = spark.read.parquet(path).schema
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path)


def ingest_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "json",
    max_files: int | None = None,
    max_bytes: str | None = None,
    stamp: str = "event",
    time_col: str = "datetime",
    archive: str | None = None,
) -> DataFrame:
    """Incremental ingest of readings.

    ``stamp="arrival"`` overwrites the event time with the time of the
    micro-batch, for demonstrations with old files. The default keeps it.
    """
    if stamp not in ("event", "arrival"):
        raise ValueError(f"unknown stamp {stamp!r}")
    df = stream_files(spark, path, schema, fmt, max_files, max_bytes, archive)
    if stamp == "arrival":
        df = df.withColumn(time_col, F.current_timestamp())
    return df


def load_reference_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    key: str | None = None,
) -> DataFrame:
    """Reference data from CSV with a header; trailing blanks are trimmed.

    A schema spares the extra pass that inference needs. With ``key`` the
    load is refused when two rows share a key, since a join with such a
    dimension would multiply readings.
    """
    reader = spark.read.option("header", True).option("ignoreTrailingWhiteSpace", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    if key:
        require_unique(df, key)
    return df
