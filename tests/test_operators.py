import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetgauge.operators.alerts import alerts
from fleetgauge.operators.dimensions import (
    date_bounds,
    date_dimension,
    date_dimension_for,
    require_unique,
    unmatched,
)
from fleetgauge.operators.lookups import bounded_broadcast, lookup, measured_bytes
from fleetgauge.operators.quality import (
    Expectation,
    apply_expectations,
    quality_metrics,
    rejected,
)
from fleetgauge.operators.silver import enrich
from fleetgauge.operators.thresholds import derive_thresholds, device_statistics
from fleetgauge.operators.windows import merge_partials, window_averages, window_partials
from fleetgauge.schemas import READING_SCHEMA, ReadingSpec


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_ends(spark):
    days = date_dimension(spark, dt.date(2021, 12, 31), dt.date(2024, 12, 31))
    rows = {r.CalendarDate: r for r in days.collect()}
    assert len(rows) == 1 + 365 + 365 + 366
    last = rows[dt.date(2021, 12, 31)]
    assert (last.dateInt, last.IsLastDayOfMonth, last.WeekOfYearIso) == (20211231, "Y", 52)
    new_year = rows[dt.date(2022, 1, 1)]  # a Saturday in ISO week 52 of 2021
    assert (new_year.DayOfWeek, new_year.DayOfWeekStartMonday) == (7, 6)
    assert (new_year.IsWeekDay, new_year.WeekOfYearIso) == ("N", 52)
    leap = rows[dt.date(2024, 2, 29)]
    assert (leap.IsLastDayOfMonth, leap.DayOfYear, leap.QuarterOfYear) == ("Y", 60, 1)
    monday = rows[dt.date(2024, 12, 30)]
    assert (monday.WeekOfYearIso, monday.CalendarDay, monday.DayOfWeek) == (1, "Monday", 2)
    assert (monday.CalendarMonth, monday.MonthOfYear) == ("December", 12)


def test_date_bounds(spark, readings):
    df = readings((1, "00:00:01", 1.0)).unionByName(
        readings((1, "23:59:59", 1.0), day="2024-01-03")
    )
    assert date_bounds(df) == (dt.date(2024, 1, 1), dt.date(2024, 1, 3))
    assert date_dimension_for(df).count() == 3
    with pytest.raises(ValueError):
        date_bounds(df.where("false"))
    with pytest.raises(ValueError):
        date_dimension(spark, dt.date(2024, 1, 2), dt.date(2024, 1, 1))


def test_require_unique(devices):
    assert require_unique(devices, "device") is devices
    with pytest.raises(ValueError, match="occurs 2 times"):
        require_unique(devices.union(devices.where("device = 2")), "device")


def test_silver_columns_and_dropped_readings(spark, readings, devices, dates):
    kept = readings((1, "10:30:00", 5.0))
    lost = readings((99, "10:30:00", 5.0)).union(
        readings((1, "10:30:00", 5.0), day="2023-12-31")
    )
    silver = enrich(kept.union(lost), devices, dates)
    early, row = silver.orderBy("datetime").collect()
    assert (str(early.CalendarDate), early.CalendarDay) == ("2023-12-31", "Sunday")
    assert silver.columns[:7] == [
        "CalendarDate", "CalendarDay", "hourOfDay", "datetime", "device", "deviceName", "location",
    ]
    assert silver.columns[-2:] == ["sensor2Variance", "sensor4Variance"]
    assert (row.CalendarDay, row.hourOfDay, row.sensor2Variance) == ("Monday", 10, 0.0)
    counts = unmatched(kept.union(lost), devices, dates).first()
    assert tuple(counts) == (3, 1, 1, 2)


def test_binding_makes_a_stream_ready_reading(spark):
    raw = spark.sql("SELECT 7L AS id, TIMESTAMP_NTZ '2024-01-01 00:00:00.123456' AS at, 3 AS x")
    bound = ReadingSpec("id", "at", {"sensor1": "x * 2"}, keep=("x",)).bind(raw)
    assert dict(bound.dtypes) == {
        "device": "bigint", "datetime": "timestamp", "sensor1": "double", "x": "int",
    }
    assert bound.first().datetime.microsecond == 123456


def test_lookup_broadcasts_only_what_is_measured_small(spark, readings, devices):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = readings((1, "00:00:01", 1.0), (2, "00:00:02", 2.0), (99, "00:00:03", 3.0))
        small = lookup(df, devices, "device")
        large = lookup(df, devices, "device", limit=measured_bytes(devices) - 1)
        assert "BroadcastHashJoin" in plan(small)
        assert "SortMergeJoin" in plan(large) and "Broadcast" not in plan(large)
        assert sorted(small.collect()) == sorted(large.collect())
        assert small.count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_measured_bytes(spark):
    df = spark.sql("SELECT 'abcd' AS a, 1 AS b UNION ALL SELECT NULL, 2")
    assert measured_bytes(df) == 4 + 2 * 32
    assert measured_bytes(df.where("false")) == 0
    assert measured_bytes(spark.sql("SELECT array('abc') AS a")) == len('{"a":["abc"]}')


RULES = (
    Expectation("device17X", "device NOT BETWEEN 1700 AND 1799", "drop"),
    Expectation("miamiClosed", "location != 'Miami, FL'"),
    Expectation("sensor5Max", "sensor5 <= 2500"),
)


def test_expectations_keep_nulls_and_count_them(spark):
    rows = [
        (1700, "Boston, MA", 1.0),
        (1799, None, 3000.0),
        (1800, "Miami, FL", 2500.0),
        (None, "Miami, FL", None),
        (1, "Boston, MA", 2500.1),
    ]
    df = spark.createDataFrame(rows, "device int, location string, sensor5 double")
    kept = apply_expectations(df, RULES)
    assert sorted(r.device or 0 for r in kept.collect()) == [0, 1, 1800]
    metrics = {r.rule: (r.action, r.passed, r.failed, r.nulls) for r in quality_metrics(df, RULES).collect()}
    assert metrics == {
        "device17X": ("drop", 2, 2, 1),
        "miamiClosed": ("warn", 2, 2, 1),
        "sensor5Max": ("warn", 2, 2, 1),
    }
    out = rejected(df, RULES)
    assert sorted((r.device, tuple(r.broken)) for r in out.collect()) == [
        (1700, ("device17X",)), (1799, ("device17X",)),
    ]
    assert kept.count() + out.count() == df.count()
    assert rejected(df, RULES[1:]).count() == 0
    with pytest.raises(ValueError):
        Expectation("x", "true", "fail")


def test_metrics_of_nothing(spark):
    df = spark.createDataFrame([], "device int, location string, sensor5 double")
    assert [tuple(r)[2:] for r in quality_metrics(df, RULES).collect()] == [(0, 0, 0)] * 3


def test_windows_and_partials_agree(readings, devices, dates):
    df = readings(
        (1, "00:00:00", 1.0), (1, "00:00:29.999999", 2.0), (1, "00:00:30", 10.0),
        (2, "00:00:15", 4.0), (1, "00:00:10", None),
    )
    silver = enrich(df, devices, dates)
    gold = window_averages(silver)
    found = {(r.window.start.second, r.deviceName): r.sensor5_avg for r in gold.collect()}
    assert found == {
        (0, "Device - 1"): 1.5, (30, "Device - 1"): 10.0, (0, "Device - 2"): 4.0,
    }
    halves = window_partials(silver.where("sensor1 > 1")).unionByName(
        window_partials(silver.where("sensor1 <= 1 OR sensor1 IS NULL"))
    )
    key = lambda r: (r.window.start, r.deviceName)
    assert sorted(merge_partials(halves).collect(), key=key) == sorted(gold.collect(), key=key)


def test_group_of_nulls_has_null_average(readings, devices, dates):
    silver = enrich(readings((1, "00:00:00", None)), devices, dates)
    assert window_averages(silver).first().sensor1_avg is None
    assert merge_partials(window_partials(silver)).first().sensor1_avg is None


def gold_of(spark, *rows):
    start = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    df = spark.createDataFrame(rows, "deviceName string, sensor5_avg double")
    window = F.struct(start.alias("start"), (start + F.expr("INTERVAL 30 SECONDS")).alias("end"))
    return df.select(window.alias("window"), "deviceName", "sensor5_avg")


def test_alert_edges(spark):
    gold = gold_of(
        spark, ("a", 10.0), ("b", 10.000001), ("c", 9.9), ("d", 99.0), ("e", None), ("f", 99.0)
    )
    limits = spark.createDataFrame(
        [("a", 10.0), ("b", 10.0), ("c", 10.0), ("d", None), ("e", 1.0)],
        "deviceName string, Threshold double",
    )
    found = alerts(gold, limits)
    assert found.columns == ["start", "end", "window", "deviceName", "sensor5_avg", "Threshold"]
    assert [r.deviceName for r in found.collect()] == ["b"]


def test_ordered_alerts(spark):
    gold = gold_of(spark, ("b", 2.0), ("c", 2.0), ("a", 2.0))
    limits = spark.createDataFrame(
        [(n, 1.0) for n in "abc"], "deviceName string, Threshold double"
    )
    found = alerts(gold, bounded_broadcast(limits), ordered=True)
    assert [r.deviceName for r in found.collect()] == ["a", "b", "c"]


def test_thresholds(spark):
    gold = gold_of(spark, ("a", 10.0), ("a", 20.0), ("b", 5.0))
    limits = {r.deviceName: r.Threshold for r in derive_thresholds(gold).collect()}
    assert limits == {"a": pytest.approx(19.4), "b": pytest.approx(4.85)}
    stats = {r.deviceName: r for r in device_statistics(gold).collect()}
    assert stats["a"].sensor5_Std == pytest.approx(50**0.5)
    assert (stats["a"].sensor5_Avg, stats["a"].sensor5_Max) == (15.0, 20.0)
    assert stats["b"].sensor5_Std is None


def test_reading_schema_keeps_fractions():
    assert {f.dataType.simpleString() for f in READING_SCHEMA.fields[2:]} == {"double"}
