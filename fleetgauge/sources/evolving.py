"""JSON whose fields change from file to file, read without losing any.

Schemas form a lattice: the join of two has the fields of both, with types
wide enough for either. A schema is taken from all files, by tasks, and joined
with what earlier files had. What a message holds beyond its schema, or in a
form that its type cannot take, comes along as text; what is no JSON object at
all is rejected with the reason. Nothing is left out without a trace.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge import storage
from fleetgauge.functions.codec import FORMATS

CORRUPT = "_corrupt_record"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REAL = (T.FloatType, T.DoubleType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def _join_numbers(a: T.DataType, b: T.DataType) -> T.DataType:
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: _DIGITS[type(t)])
    if isinstance(a, _REAL) or isinstance(b, _REAL):
        return T.DoubleType()
    a, b = (t if isinstance(t, T.DecimalType) else T.DecimalType(_DIGITS[type(t)], 0) for t in (a, b))
    scale = max(a.scale, b.scale)
    digits = max(a.precision - a.scale, b.precision - b.scale) + scale
    return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()


def join_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that takes values of both; text takes all."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return join_schemas(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(join_types(a.elementType, b.elementType))
    if all(isinstance(t, (*_WHOLE, *_REAL, T.DecimalType)) for t in (a, b)):
        return _join_numbers(a, b)
    return T.StringType()


def join_schemas(a: T.StructType, b: T.StructType) -> T.StructType:
    """Fields of both, by name; those of ``a`` come first."""
    known = {f.name: f.dataType for f in a}
    for field in b:
        known[field.name] = join_types(known.get(field.name, T.NullType()), field.dataType)
    return T.StructType([T.StructField(name, kind) for name, kind in known.items()])


def _without_unknowns(kind: T.DataType) -> T.DataType:
    """Fields that are null wherever they occur become text."""
    if isinstance(kind, T.NullType):
        return T.StringType()
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _without_unknowns(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_without_unknowns(kind.elementType))
    return kind


def merged_schema(
    spark: SparkSession,
    path: str | list[str],
    time_col: str | None = "datetime",
    known: T.StructType | None = None,
) -> T.StructType:
    """Schema of all JSON files under a path, joined with what is known.

    One pass over the files; each task joins the schemas of its lines, and
    those of the tasks are joined pairwise. For a folder that grows, pass the
    new files and the schema so far.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("columnNameOfCorruptRecord", CORRUPT)
    found = reader.json(path).schema
    found = T.StructType(
        [
            T.StructField(f.name, T.TimestampType()) if f.name == time_col else f
            for f in found
            if f.name != CORRUPT
        ]
    )
    return _without_unknowns(join_schemas(known, found) if known is not None else found)


class SchemaLog:
    """Versions of a schema in a shared folder, each wider than the one before."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        names = [n for n in storage.names(self.spark, self.path) if n.startswith("version=")]
        numbers = sorted(int(n.removeprefix("version=")) for n in names)
        return [n for n in numbers if storage.exists(self.spark, f"{self.path}/version={n}/_SUCCESS")]

    def current(self) -> T.StructType | None:
        versions = self.versions()
        if not versions:
            return None
        text = self.spark.read.text(f"{self.path}/version={versions[-1]}").first().value
        return T.StructType.fromJson(json.loads(text))

    def widen(self, found: T.StructType) -> T.StructType:
        """Join a schema into the log; a new version only if it adds something."""
        before = self.current()
        after = join_schemas(before, found) if before is not None else found
        if after != before:
            number = max(self.versions(), default=0) + 1
            row = self.spark.createDataFrame([(after.json(),)], "value string").coalesce(1)
            row.write.mode("overwrite").text(f"{self.path}/version={number}")
        return after


def _holds_structs(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return isinstance(kind.elementType, T.StructType) or _holds_structs(kind.elementType)
    return isinstance(kind, T.MapType)


def _beyond(text: Column, typed: Column, schema: T.StructType, prefix: str = "") -> Column:
    """What an object's text holds and its typed form doesn't, by name."""
    raw = F.from_json(text, "map<string,string>")
    held = F.array_compact(F.array(*[F.when(typed[f.name].isNotNull(), F.lit(f.name)) for f in schema]))
    lost = F.map_filter(raw, lambda k, v: v.isNotNull() & ~F.array_contains(held, k))
    if prefix:
        lost = F.transform_keys(lost, lambda k, v: F.concat(F.lit(prefix), k))
    parts = [F.coalesce(lost, F.create_map().cast("map<string,string>"))]
    for f in schema:
        inner, whole = raw[f.name], typed[f.name]
        if isinstance(f.dataType, T.StructType):
            below = _beyond(inner, whole, f.dataType, f"{prefix}{f.name}.")
            parts.append(F.when(whole.isNotNull(), below))
        elif _holds_structs(f.dataType):
            # Not looked into: where writing it again gives another text, the text is kept.
            again = F.to_json(F.struct(whole.alias("v")), FORMATS)
            other = F.concat(F.lit('{"v":'), F.regexp_replace(inner, r"\s", ""), F.lit("}")) != again
            parts.append(F.when(whole.isNotNull() & other, F.create_map(F.lit(prefix + f.name), inner)))
    empty = F.create_map().cast("map<string,string>")
    return parts[0] if len(parts) == 1 else F.map_concat(*[F.coalesce(p, empty) for p in parts])


def decode_all(
    df: DataFrame, schema: T.StructType, payload: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Unpack JSON text or bytes into the schema's fields, and keep the rest.

    ``rescued`` maps names (dotted, inside objects) to the text of fields that
    the schema lacks or whose value its type cannot take; null if there are
    none. ``rejected`` is null, or why the message is no JSON object; its text
    is then in ``raw``.
    """
    text = F.col(payload).cast("string")
    parsed = df.select(
        *keep,
        text.alias("raw"),
        F.from_json(text, "map<string,string>").isNotNull().alias("_object"),
        F.from_json(text, schema, FORMATS).alias("_typed"),
    )
    whole = F.col("_object")
    beyond = F.when(whole, _beyond(F.col("raw"), F.col("_typed"), schema))
    reason = F.when(F.col("raw").isNull(), F.lit("no message")).when(~whole, F.lit("not an object"))
    return parsed.select(
        *keep,
        *[F.when(whole, F.col("_typed")[f.name]).alias(f.name) for f in schema],
        F.when(F.size(beyond) > 0, beyond).alias("rescued"),
        reason.alias("rejected"),
        F.when(~whole, F.col("raw")).alias("raw"),
    )


def decoded_rows(decoded: DataFrame) -> DataFrame:
    return decoded.where("rejected IS NULL").drop("rejected", "raw")


def rejected_rows(decoded: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return decoded.where("rejected IS NOT NULL").select(*keep, "raw", "rejected")


def reject_counts(decoded: DataFrame) -> DataFrame:
    """How many messages came through whole, with a rest, or not at all, by reason."""
    outcome = F.coalesce("rejected", F.when(F.col("rescued").isNotNull(), F.lit("rescued")), F.lit("whole"))
    return decoded.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("messages"))
