import datetime as dt

from fleetgauge.functions.codec import decode, encode, land


def test_roundtrip_keeps_micros_nulls_and_odd_values(spark):
    df = spark.sql(
        """
        SELECT 1 AS i, TIMESTAMP '2024-01-01 00:00:00.000001' AS at,
               TIMESTAMP_NTZ '2024-02-29 23:59:59.999999' AS ntz, 'say "hi"\\n' AS s, 0.1D AS x
        UNION ALL SELECT NULL, NULL, NULL, NULL, NULL
        UNION ALL SELECT 2, TIMESTAMP '1969-12-31 23:59:59.5', TIMESTAMP_NTZ '1900-01-01', 'ü', 1e300D
        UNION ALL SELECT 3, TIMESTAMP '2024-01-01', TIMESTAMP_NTZ '2024-01-01', '', DOUBLE('Infinity')
        """
    )
    back = decode(encode(df), df.schema)
    assert back.schema == df.schema
    key = lambda r: str(r.i)
    assert sorted(back.collect(), key=key) == sorted(df.collect(), key=key)


def test_roundtrip_in_another_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT TIMESTAMP '2024-07-01 12:00:00.123456' AS at")
        assert decode(encode(df), df.schema).collect() == df.collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_broken_payloads_give_nulls(spark):
    rows = [(1, '{"a": 1, "b": "x"}'), (2, '{"a": 1, "b'), (3, None), (4, '{"a": "no", "b": "y"}')]
    df = spark.createDataFrame(rows, "n int, value string")
    found = {r.n: (r.a, r.b) for r in decode(df, "a INT, b STRING", keep=("n",)).collect()}
    assert found[1] == (1, "x")
    assert found[3] == (None, None)
    assert found[2][1] is None
    assert found[4][0] is None


def test_landing_rows(spark):
    body = '{"user_id": "m1", "event_type": "click", "value": "3"}'
    envelope = spark.createDataFrame(
        [(bytearray(body, "utf8"), 9, dt.datetime(2024, 1, 2, 3, 4, 5))],
        "body binary, sequenceNumber bigint, enqueuedTime timestamp",
    )
    landed = land(envelope, "user_id string, event_type string, value string, props string")
    assert landed.columns == ["sequenceNumber", "user_id", "event_type", "value", "props", "stream_date"]
    row = landed.first()
    assert (row.sequenceNumber, row.user_id, row.value, row.props) == (9, "m1", "3", None)
    assert row.stream_date == dt.date(2024, 1, 2)
