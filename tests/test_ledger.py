"""Stored rule counts: whole after restarts, retries and crashes at any point."""

import os

import pytest

from fleetgauge import storage
from fleetgauge.operators.quality import Expectation
from fleetgauge.schemas import READING_SCHEMA
from fleetgauge.sinks import ledger
from fleetgauge.sources.files import ingest_files
from fleetgauge.streaming.replay import replay_files
from fleetgauge.streaming.runner import drain

RULES = (
    Expectation("small", "sensor1 < 5", "drop"),
    Expectation("even", "sensor1 % 2 = 0"),
    Expectation("ratio", "1 / nullif(sensor1, 0) < 1"),
)
ALL = {"small": (5, 5, 0), "even": (5, 5, 0), "ratio": (8, 1, 1)}


@pytest.fixture
def place(spark, readings, tmp_path):
    ten = readings(*[(1, f"00:{i:02d}:00", float(i)) for i in range(10)])
    replay_files(ten, str(tmp_path / "in"), "datetime", 4)

    def run(table=None, rules=RULES, **kwargs):
        rows = ingest_files(spark, str(tmp_path / "in"), READING_SCHEMA, max_files=1)
        query = ledger.stream_with_ledger(
            rows, rules, str(tmp_path / "out"), str(tmp_path / "cp"), table, trigger="availableNow", **kwargs
        )
        return drain(query)

    run.readings, run.folder = ten, tmp_path
    return run


def totals(spark, folder):
    rows = ledger.rule_totals(spark, str(folder / "out")).collect()
    return {r.rule: (r.passed, r.failed, r.nulls) for r in rows}


def kept(spark, folder):
    return sorted(r.sensor1 for r in spark.read.parquet(str(folder / "out")).collect())


def forget_commit(folder, batch):
    for name in (str(batch), f".{batch}.crc"):
        os.remove(folder / "cp" / "commits" / name)


def test_counts_outlast_the_run_that_made_them(spark, place):
    assert totals(spark, place.folder) == {}
    place()
    assert totals(spark, place.folder) == ALL
    place()  # nothing new
    assert totals(spark, place.folder) == ALL
    replay_files(place.readings, str(place.folder / "in"), "datetime", 2)
    place()
    assert totals(spark, place.folder) == {k: tuple(2 * n for n in v) for k, v in ALL.items()}
    assert kept(spark, place.folder) == sorted([0.0, 1, 2, 3, 4] * 2)


def test_retried_batch_counts_once(spark, place):
    place()
    before = sorted(os.listdir(place.folder / "out" / "batch_id=3"))
    forget_commit(place.folder, 3)
    place()
    assert totals(spark, place.folder) == ALL and kept(spark, place.folder) == [0, 1, 2, 3, 4]
    assert sorted(os.listdir(place.folder / "out" / "batch_id=3")) == before  # readers may hold these


@pytest.mark.parametrize("step", ["before the entry", "before the move"])
def test_crash_within_a_batch(spark, place, monkeypatch, step):
    real = storage.move
    died = []

    def move(session, source, target):
        if target.endswith("batch_id=2") and not died:
            died.append(target)
            if step == "before the entry":
                storage.drop_folder(session, str(place.folder / "out-rules" / "batch_id=2"))
            raise RuntimeError("lost")
        real(session, source, target)

    monkeypatch.setattr(storage, "move", move)
    with pytest.raises(Exception, match="lost"):
        place()
    assert ledger.published_batches(spark, str(place.folder / "out")) == [0, 1]
    assert sum(totals(spark, place.folder)["small"]) == len(kept(spark, place.folder)) + totals(spark, place.folder)["small"][1]
    place()
    assert totals(spark, place.folder) == ALL and kept(spark, place.folder) == [0, 1, 2, 3, 4]


def test_table_with_partitions_and_no_rules(spark, place):
    spark.sql("CREATE DATABASE IF NOT EXISTS ledger_test")
    try:
        place("ledger_test.kept", partition_by=("device",))
        table = spark.table("ledger_test.kept")
        assert table.where("device = 1").count() == 5 and table.columns[-2:] == ["batch_id", "device"]
    finally:
        spark.sql("DROP DATABASE ledger_test CASCADE")


def test_another_checkpoint_is_refused(spark, place):
    place()
    rows = ingest_files(spark, str(place.folder / "in"), READING_SCHEMA)
    with pytest.raises(ValueError, match="another checkpoint"):
        ledger.stream_with_ledger(rows, (), str(place.folder / "out"), str(place.folder / "cp2"))
