"""Schemas as a lattice, fields the schema lacks, and messages that are none."""

import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from fleetgauge.sources import evolving as e
from fleetgauge.sources.files import stream_files
from fleetgauge.sinks.tables import stream_to_path
from fleetgauge.streaming.runner import drain

atoms = st.sampled_from(
    [T.NullType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.DecimalType(20, 0)]
)
kinds = st.recursive(
    atoms,
    lambda inner: st.one_of(
        inner.map(T.ArrayType),
        st.dictionaries(st.sampled_from("abc"), inner, max_size=3).map(
            lambda d: T.StructType([T.StructField(k, v) for k, v in d.items()])
        ),
    ),
    max_leaves=6,
)


def plain(kind):
    """Without the order of fields."""
    if isinstance(kind, T.StructType):
        return {f.name: plain(f.dataType) for f in kind}
    return [plain(kind.elementType)] if isinstance(kind, T.ArrayType) else kind.simpleString()


@settings(max_examples=200, deadline=None, suppress_health_check=list(HealthCheck))
@given(kinds, kinds, kinds)
def test_types_form_a_lattice(a, b, c):
    join = e.join_types
    assert plain(join(a, a)) == plain(a)
    assert plain(join(a, b)) == plain(join(b, a))
    assert plain(join(join(a, b), c)) == plain(join(a, join(b, c)))
    assert plain(join(a, join(a, b))) == plain(join(a, b))


def write(folder, **files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, lines in files.items():
        (folder / f"{name}.json").write_text("\n".join(lines))
    return str(folder)


def test_two_files_lose_nothing(spark, tmp_path):
    path = write(tmp_path / "in", one=['{"sensor1":1}'], two=['{"sensor1":1.5,"sensor2":7.0}'])
    schema = e.merged_schema(spark, path)
    assert plain(schema) == {"sensor1": "double", "sensor2": "double"}
    rows = spark.read.schema(schema).json(path).collect()
    assert {(r.sensor1, r.sensor2) for r in rows} == {(1.0, None), (1.5, 7.0)}


def test_a_folder_that_grows(spark, tmp_path):
    log = e.SchemaLog(spark, str(tmp_path / "log"))
    first = write(tmp_path / "a", x=['{"k":1,"datetime":"2024-01-01T00:00:00"}', "broken{", '{"n":null}'])
    one = log.widen(e.merged_schema(spark, first))
    assert plain(one) == {"datetime": "timestamp", "k": "bigint", "n": "string"}
    assert log.widen(e.merged_schema(spark, first, known=one)) == one and log.versions() == [1]
    second = write(tmp_path / "b", x=['{"k":2.5,"place":{"x":1}}', '{"place":{"y":"s"},"tags":[1,2.5]}'])
    two = log.widen(e.merged_schema(spark, second, known=one))
    assert plain(two) == plain(one) | {"k": "double", "place": {"x": "bigint", "y": "string"}, "tags": ["double"]}
    assert log.versions() == [1, 2] and log.current() == two


INNER = T.StructType().add("x", "integer").add("in", T.StructType().add("y", "integer"))
SCHEMA = (
    T.StructType()
    .add("device", "integer")
    .add("datetime", "timestamp")
    .add("sensor1", "double")
    .add("place", INNER)
    .add("tags", T.ArrayType(T.StructType().add("t", "integer")))
)
MESSAGES = {
    "whole": ('{"device":1,"datetime":"2024-01-01T00:00:00.000001Z","sensor1":2}', None),
    "extra": ('{"device":1,"sensor9":1.5,"o":{"a":[1,2]}}', {"sensor9": "1.5", "o": '{"a":[1,2]}'}),
    "type": ('{"device":"x","sensor1":"n/a","datetime":"noon"}', {"device": "x", "sensor1": "n/a", "datetime": "noon"}),
    "fraction": ('{"device":1.5}', {"device": "1.5"}),
    "null": ('{"device":null,"more":null}', None),
    "inside": ('{"place":{"x":1,"z":2,"in":{"y":"q","w":3}}}', {"place.z": "2", "place.in.y": "q", "place.in.w": "3"}),
    "list": ('{"tags":[{"t":1,"u":2}]}', {"tags": '[{"t":1,"u":2}]'}),
    "known list": ('{"tags":[{"t":1}, {"t":2}]}', None),
    "empty": ("{}", None),
    "twice": ('{"device":1,"device":2}', None),
}
BROKEN = {"cut": '{"device":1,"sensor1":', "text": "hello", "blank": "", "number": "12", "array": "[1]", "none": None}


def test_rest_and_rejects(spark):
    rows = [(k, v[0]) for k, v in MESSAGES.items()] + list(BROKEN.items())
    df = spark.createDataFrame(rows, "key string, value string")
    got = {r.key: r for r in e.decode_all(df, SCHEMA, keep=("key",)).collect()}
    for key, (text, rest) in MESSAGES.items():
        assert (got[key].rescued, got[key].rejected, got[key].raw) == (rest, None, None), key
    for key, text in BROKEN.items():
        assert got[key].rescued is None and got[key].device is None and got[key].raw == text, key
        assert got[key].rejected == ("no message" if text is None else "not an object")
    assert (got["whole"].device, got["whole"].sensor1) == (1, 2.0)
    assert got["extra"].device == 1 and got["inside"].place.x == 1
    counts = {r.outcome: r.messages for r in e.reject_counts(e.decode_all(df, SCHEMA)).collect()}
    assert counts == {"whole": 5, "rescued": 5, "not an object": 5, "no message": 1}


def test_bytes_and_no_messages(spark):
    df = spark.createDataFrame([(bytearray(b'{"device":3}'),), (bytearray(b"\xff\xfe"),)], "value binary")
    assert [r.device for r in e.decoded_rows(e.decode_all(df, SCHEMA)).collect()] == [3]
    assert e.rejected_rows(e.decode_all(df, SCHEMA)).count() == 1
    assert e.decode_all(df.limit(0), SCHEMA).collect() == []


def test_both_kinds_are_stored_by_a_stream(spark, tmp_path):
    path = write(tmp_path / "in", a=['{"device":1}', "x{"], b=['{"device":2,"n":5}'])
    lines = stream_files(spark, path, "value string", "text", max_files=1)
    out = str(tmp_path / "out")
    for _ in range(2):  # a restart adds nothing
        drain(stream_to_path(e.decode_all(lines, SCHEMA), out, str(tmp_path / "cp"), trigger="availableNow"))
    stored = spark.read.parquet(out)
    assert sorted((r.device, r.rescued) for r in e.decoded_rows(stored).collect()) == [(1, None), (2, {"n": "5"})]
    assert [tuple(r) for r in e.rejected_rows(stored).collect()] == [("x{", "not an object")]
