"""Rows to JSON messages and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The default formats stop at milliseconds and would change most event times.
FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def to_message(*columns: str) -> Column:
    """One JSON text holding the named columns; null fields are left out."""
    return F.to_json(F.struct(*columns), FORMATS)


def encode(
    df: DataFrame,
    payload: str = "value",
    columns: list[str] | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Pack whole rows (or ``columns``) into a single JSON column.

    ``keep`` names columns to carry beside it, such as a message key.
    """
    return df.select(*keep, to_message(*(columns or df.columns)).alias(payload))


def decode(
    df: DataFrame,
    schema: T.StructType | str,
    payload: str = "value",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Unpack JSON text or bytes; broken text gives null fields, not an error."""
    reading = F.from_json(F.col(payload).cast("string"), schema, FORMATS)
    return df.select(*keep, reading.alias("reading")).select(*keep, "reading.*")


def land(
    envelope: DataFrame,
    schema: T.StructType | str,
    payload: str = "body",
    sequence: str = "sequenceNumber",
    arrived: str = "enqueuedTime",
) -> DataFrame:
    """Landing table rows: sequence number, payload fields, arrival date."""
    unpacked = decode(envelope, schema, payload, keep=(sequence, arrived))
    return unpacked.withColumn("stream_date", F.to_date(arrived)).drop(arrived)
