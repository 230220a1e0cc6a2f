"""Devices known late, alerts raised early, windows corrected, and summaries that add up."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from fleetgauge import storage
from fleetgauge.operators.dimensions import date_dimension
from fleetgauge.operators.thresholds import device_statistics
from fleetgauge.operators.windows import window_averages
from fleetgauge.plans.medallion import batch_layers, stream_layers
from fleetgauge.schemas import READING_SCHEMA
from fleetgauge.session import stateful_session
from fleetgauge.settings import Settings
from fleetgauge.sources.files import stream_files
from fleetgauge.streaming import corrected, early, late, summaries
from fleetgauge.streaming.runner import drain
from test_streaming import LATE, NAMED, groups, write_slices

DAY = (dt.date(2024, 1, 1), dt.date(2024, 1, 1))


@pytest.fixture(scope="module")
def stateful(spark):
    return stateful_session(spark, partitions=2)


def forget_commit(checkpoint, batch):
    for name in (str(batch), f".{batch}.crc"):
        os.remove(os.path.join(checkpoint, "commits", name))


# Devices


class Fleet:
    """A late silver table over files that a test adds one by one."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.known, self.files = spark, folder, [], 0
        self.out = str(folder / "silver")

    def read(self, *devices):
        """A file with one reading per device, and a run of the stream."""
        (self.folder / "in").mkdir(exist_ok=True)
        lines = [
            f'{{"device": {d}, "datetime": "2024-01-01T00:00:{self.files:02d}Z", "sensor1": {self.files}.0}}\n'
            for d in devices
        ]
        path = self.folder / "in" / f"{self.files:03d}.json"
        path.write_text("".join(lines))
        os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1
        return self.run()

    def run(self):
        spark, known = self.spark, list(self.known)
        stream = stream_files(spark, str(self.folder / "in"), READING_SCHEMA, max_files=1)
        drain(
            late.start_late_silver(
                stream,
                lambda: spark.createDataFrame(known, "device int, deviceName string, location string"),
                lambda: date_dimension(spark, *DAY),
                self.out,
                str(self.folder / "cp"),
                trigger="availableNow",
            )
        )
        return self.rows()

    def rows(self):
        found = self.spark.read.parquet(self.out).collect()
        return sorted((r.batch_id, r.device, r.deviceName, int(r.sensor1)) for r in found)

    def waiting(self):
        rows = late.waiting_readings(self.spark, self.out).collect()
        return sorted((str(r.device), int(r.sensor1)) for r in rows)


def test_readings_wait_for_their_device(spark, tmp_path):
    fleet = Fleet(spark, tmp_path)
    fleet.known = [(1, "one", "x")]
    assert fleet.read(1, 2, 3, "null") == [(0, 1, "one", 0)]
    assert fleet.waiting() == [("2", 0), ("3", 0), ("None", 0)]
    fleet.known = [(1, "uno", "x"), (2, "two", "y")]
    assert fleet.read(1, 2) == [(0, 1, "one", 0), (1, 1, "uno", 1), (1, 2, "two", 0), (1, 2, "two", 1)]
    fleet.known = [(3, "three", None)]  # 1 and 2 are gone from the source, but stay known
    assert fleet.read(1, 2, 3)[4:] == [(2, 1, "uno", 2), (2, 2, "two", 2), (2, 3, "three", 0), (2, 3, "three", 2)]
    fleet.known = [(1, "uno", "x"), (2, "two", "y")]
    assert fleet.read(2)[8:] == [(3, 2, "two", 3)]
    assert fleet.waiting() == [("None", 0)]
    assert fleet.run() == fleet.rows()  # nothing new, nothing repeated


def test_retried_batch_doubles_nothing(spark, tmp_path):
    fleet = Fleet(spark, tmp_path)
    fleet.known = [(1, "one", "x")]
    fleet.read(1, 2)
    fleet.known.append((2, "two", "y"))
    rows = fleet.read(1)
    forget_commit(str(tmp_path / "cp"), 1)
    fleet.known.append((9, "nine", "z"))
    assert fleet.run() == rows


def test_crash_before_the_move(spark, tmp_path, monkeypatch):
    fleet = Fleet(spark, tmp_path)
    fleet.known = [(1, "one", "x")]
    fleet.read(1, 2)
    real, died = storage.move, []

    def move(session, source, target):
        if not died:
            died.append(target)
            raise RuntimeError("lost")
        real(session, source, target)

    monkeypatch.setattr(storage, "move", move)
    fleet.known.append((2, "two", "y"))
    with pytest.raises(Exception, match="lost"):
        fleet.read(1)
    fleet.known.pop()  # the second attempt finds another dimension than the first
    assert fleet.run() == [(0, 1, "one", 0), (1, 1, "one", 1)]
    fleet.known.append((2, "two", "y"))
    assert fleet.read(2)[2:] == [(2, 2, "two", 0), (2, 2, "two", 2)]


def test_a_repeated_device_is_refused(spark, tmp_path):
    fleet = Fleet(spark, tmp_path)
    fleet.known = [(1, "one", "x"), (1, "uno", "x")]
    with pytest.raises(Exception, match="device"):
        fleet.read(1)


def test_the_whole_chain_with_live_dimensions(spark, readings, devices, dates, tmp_path):
    from fleetgauge.streaming.replay import replay_files

    place = Settings("live", str(tmp_path / "base"), trigger="availableNow")
    df = readings(*[(1 + i % 2, f"00:{i:02d}:00", float(i)) for i in range(20)])
    limits = batch_layers(df, devices, dates).thresholds
    limits = spark.createDataFrame(limits.collect(), limits.schema)
    known = devices.where("device = 1")
    for half, found in ((df.where("sensor1 < 10"), known), (df.where("sensor1 >= 10"), devices)):
        replay_files(half, str(tmp_path / "in"), "datetime", 2)
        bronze = stream_files(spark, str(tmp_path / "in"), READING_SCHEMA, max_files=1)
        queries = stream_layers(spark, place, bronze, lambda: found, lambda: dates, limits)
    silver = spark.read.parquet(place.data_path("silver")).drop("batch_id")
    expected = batch_layers(df, devices, dates, limits).silver
    assert sorted(map(str, silver.collect())) == sorted(map(str, expected.collect()))
    assert set(queries) == {"bronze", "silver", "gold", "alerts"}
    assert spark.read.parquet(place.data_path("gold")).count() > 10


# Alerts


def run_early(spark, stateful, tmp_path, slices, lateness="1 minute", limit=4.0, name="early"):
    source = write_slices(spark, tmp_path / f"{name}-in", slices)
    limits = spark.createDataFrame(
        [("a", limit), ("b", limit), ("c", None)], "deviceName string, Threshold double"
    )
    out = str(tmp_path / name)
    stream = stream_files(stateful, source, NAMED, max_files=1)
    drain(early.start_early_alerts_log(stream, limits, out, f"{out}-cp", lateness=lateness, trigger="availableNow"))
    return spark.read.parquet(out)


def events(df):
    rows = [(r.deviceName, r.start.minute, r.version, r.kind, r.average) for r in df.collect()]
    return sorted(rows)


def test_one_alert_per_crossing_and_a_retraction(spark, stateful, tmp_path):
    slices = [
        [(0, 1, "a", 5.0), (0, 1, "b", 3.0), (0, 1, "c", 99.0), (0, 1, "d", 99.0)],
        [(0, 2, "a", 7.0), (0, 2, "b", 9.0)],
        [(0, 3, "a", -90.0)],
        [(0, 4, "a", 300.0)],
        [(9, 0, "b", 1.0)],
    ]
    found = run_early(spark, stateful, tmp_path, slices)
    assert events(found) == [
        ("a", 0, 1, "raised", 5.0),
        ("a", 0, 2, "retracted", -26.0),
        ("a", 0, 3, "raised", 55.5),
        ("a", 0, 4, "closed", 55.5),
        ("b", 0, 1, "raised", 6.0),
        ("b", 0, 2, "closed", 6.0),
    ]
    standing = early.standing_alerts(found).collect()
    assert sorted((r.deviceName, r.start.minute, r.end.second, r.kind) for r in standing) == [
        ("a", 0, 30, "closed"),
        ("b", 0, 30, "closed"),
    ]


def test_any_order_of_files_gives_the_batch_answer(spark, stateful, tmp_path):
    dice = random.Random(4)
    rows = [(dice.randint(0, 12), dice.randint(0, 59), dice.choice("ab"), dice.uniform(0, 8)) for _ in range(120)]
    slices = [sorted(rows)[i : i + 24] for i in range(0, 120, 24)]
    gold = window_averages(spark.read.schema(NAMED).json(write_slices(spark, tmp_path / "all", slices)))
    expected = sorted((r.deviceName, r.window.start) for r in gold.where("sensor5_avg > 4").collect())
    assert len(expected) > 5
    for name, order in (("forth", slices), ("back", slices[::-1])):
        found = run_early(spark, stateful, tmp_path, order, lateness="1 hour", name=name)
        assert sorted((r.deviceName, r.start) for r in early.standing_alerts(found).collect()) == expected


def test_a_backlog_keeps_state_by_group_not_by_window(spark, stateful, tmp_path):
    rows = [(minute, 5, f"d{i}", float(i)) for minute in range(20) for i in range(40)]
    source = write_slices(spark, tmp_path / "in", [rows, [(59, 0, "d0", 0.0)]])
    limits = spark.range(40).selectExpr("concat('d', id) AS deviceName", "29.5D AS Threshold")
    out = str(tmp_path / "out")
    stream = stream_files(stateful, source, NAMED, max_files=1)
    query = drain(early.start_early_alerts_log(stream, limits, out, f"{out}-cp", trigger="availableNow"))
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) < 200
    kinds = sorted((r.kind, r["count"]) for r in spark.read.parquet(out).groupBy("kind").count().collect())
    assert kinds == [("closed", 200), ("raised", 200)]


# Corrections


def run_corrected(spark, source, out):
    stream = stream_files(spark, source, NAMED, max_files=1)
    return drain(corrected.start_corrected_gold(stream, str(out), f"{out}-cp", trigger="availableNow"))


def test_late_rows_become_corrections(spark, tmp_path):
    source, out = write_slices(spark, tmp_path / "in", LATE), tmp_path / "out"
    run_corrected(spark, source, out)
    batch = groups(window_averages(spark.read.schema(NAMED).json(source)))
    assert groups(corrected.read_corrected_gold(spark, str(out))) == batch
    closed = groups(corrected.read_closed_gold(spark, str(out)))
    assert [(at.minute, value) for at, _, value in closed] == [(0, 2.0), (10, 5.0), (20, 7.0)]
    both = groups(corrected.read_corrected_gold(spark, str(out), watermark="1 minute"))
    assert both == batch[:-1]
    fixes = corrected.read_corrections(spark, str(out)).collect()
    assert [(r.sensor1_before, round(r.sensor1_avg, 9)) for r in fixes] == [(2.0, round(104 / 3, 9))]


def test_corrected_gold_in_any_order_and_after_retries(spark, tmp_path):
    dice = random.Random(9)
    slices = [
        [(dice.randint(0, 50), dice.randint(0, 59), dice.choice("ab"), float(i)) for i in range(8)] for _ in range(4)
    ]
    source, out = write_slices(spark, tmp_path / "in", slices), tmp_path / "out"
    run_corrected(spark, source, out)
    batch = groups(window_averages(spark.read.schema(NAMED).json(source)))
    assert groups(corrected.read_corrected_gold(spark, str(out))) == batch
    before = groups(corrected.read_closed_gold(spark, str(out)))
    forget_commit(f"{out}-cp", 3)
    run_corrected(spark, source, out)
    assert groups(corrected.read_corrected_gold(spark, str(out))) == batch
    assert groups(corrected.read_closed_gold(spark, str(out))) == before
    assert corrected.read_corrections(spark, str(out)).count() > 0


# Summaries


def test_sketch_of_halves_is_the_sketch_of_all(spark):
    rows = spark.range(200_000).select(F.concat(F.lit("d"), F.col("id") % 60_000).alias("k"), (F.col("id") % 2).alias("g"), "id")
    one = summaries.distinct_sketch(rows, "k")
    halves = [summaries.distinct_sketch(rows.where(f"g = {g}"), "k") for g in (0, 1)]
    whole = summaries.estimated_distinct(one, "n").first().n
    union = summaries.estimated_distinct(halves[0].unionByName(halves[1]), "n").first().n
    assert whole == union and abs(whole - 60_000) < 3 * 0.0065 * 60_000
    few = summaries.distinct_sketch(rows.where("id < 900"), "k", ("g",))
    assert {r.g: r.n for r in summaries.estimated_distinct(few, "n", ("g",)).collect()} == {0: 450, 1: 450}
    none = summaries.distinct_sketch(rows.limit(0), "k")
    assert summaries.estimated_distinct(none, "n").first().n == 0


def test_moments_merge_in_any_parts(spark):
    rows = spark.createDataFrame(
        [(f"d{i % 7}", 1e6 + (i * 37 % 101) / 100, i) for i in range(5000)] + [("lone", 5.0, 1), ("none", None, 2)],
        "deviceName string, sensor1_avg double, id int",
    )
    parts = [summaries.moments(rows.where(f"id % 5 = {k}"), "sensor1_avg") for k in range(5)]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    got = {r.deviceName: r for r in summaries.merged_moments(together).collect()}
    for row in device_statistics(rows, "sensor1_avg").collect():
        mine = got[row.deviceName]
        if row.deviceName == "none":
            assert mine.n is None and mine.mean is None
            continue
        assert mine.mean == pytest.approx(row.sensor1_Avg, rel=1e-12) and mine.most == row.sensor1_Max
        spread = None if mine.n < 2 else (mine.m2 / (mine.n - 1)) ** 0.5
        assert spread == (None if row.sensor1_Std is None else pytest.approx(row.sensor1_Std, rel=1e-9))


def test_streamed_statistics_after_a_retry(spark, tmp_path):
    slices = [[(i, s, "a", float(i * s)) for s in (1, 40)] for i in range(4)]
    gold = window_averages(spark.read.schema(NAMED).json(write_slices(spark, tmp_path / "in", slices)))
    gold.repartition(3).write.parquet(str(tmp_path / "gold"))
    out = str(tmp_path / "moments")

    def run():
        rows = stream_files(spark, str(tmp_path / "gold"), gold.schema, "parquet", max_files=1)
        drain(summaries.start_moments(rows, "sensor1_avg", out, f"{out}-cp", trigger="availableNow"))

    run()
    forget_commit(f"{out}-cp", 2)
    run()
    found = summaries.read_statistics(spark, out, "sensor1_avg").first()
    expected = device_statistics(gold, "sensor1_avg").first()
    assert (found.deviceName, found.sensor1_Max) == ("a", expected.sensor1_Max)
    assert found.sensor1_Std == pytest.approx(expected.sensor1_Std)
    assert summaries.read_thresholds(spark, out, "sensor1_avg").first().Threshold == pytest.approx(0.97 * 120)
