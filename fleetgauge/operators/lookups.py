"""Joins of readings with a dimension.

All are equi-joins. An inner one drops a reading without a partner, a left one
keeps it with nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT = 64 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Size of a frame's values, counted on the data in one aggregation.

    Text and binary columns count their bytes, others their fixed width.
    """
    fixed = 0
    variable = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            variable.append(F.coalesce(F.octet_length(f.name), F.lit(0)).cast("bigint"))
            fixed += 16
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            variable.append(
                F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0)).cast("bigint")
            )
        else:
            fixed += 16
    per_row = sum(variable, F.lit(fixed).cast("bigint"))
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0))).first()[0]


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Ask for a broadcast if the frame is measured to be small enough.

    Otherwise it is returned as is: the join then shuffles both sides, and
    adaptive execution splits the partitions of hot keys.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def lookup(
    readings: DataFrame,
    dimension: DataFrame,
    on: str | Column,
    limit: int = BROADCAST_LIMIT,
    how: str = "inner",
) -> DataFrame:
    return readings.join(bounded_broadcast(dimension, limit), on, how)
