import uuid

import pytest

from fleetgauge.operators.quality import Expectation
from fleetgauge.plans.bi import SavedQueries
from fleetgauge.plans.flow import Flow
from fleetgauge.plans.medallion import batch_layers, stream_layers
from fleetgauge.operators.thresholds import derive_thresholds
from fleetgauge.schemas import READING_SCHEMA
from fleetgauge.settings import Settings
from fleetgauge.sources.files import ingest_files
from fleetgauge.streaming.replay import replay_files

RULE = Expectation("small", "sensor1 < 5", "drop")
WARN = Expectation("tiny", "sensor1 < 3")


@pytest.fixture
def settings(tmp_path):
    def make(**changes):
        return Settings(f"fleet_{uuid.uuid4().hex}", str(tmp_path / "base"), **changes)

    return make


@pytest.fixture
def ten(readings):
    return readings(*[(1, f"00:{i:02d}:00", float(i)) for i in range(10)])


def test_order_and_lineage(spark, settings):
    flow = Flow(spark, settings())
    flow.table("c", lambda s, i: i["b"], reads=("b", "a"))
    flow.table("b", lambda s, i: i["a"], streams=("a",))
    flow.view("a", lambda s, i: s.range(1))
    assert flow.order() == ["a", "b", "c"]
    assert sorted(tuple(r) for r in flow.lineage().collect()) == [("b", "a"), ("c", "a"), ("c", "b")]
    above = sorted(tuple(r) for r in flow.ancestry().collect())
    assert above == [("b", "a", 1), ("c", "a", 1), ("c", "a", 2), ("c", "b", 1)]
    with pytest.raises(ValueError):
        flow.view("a", lambda s, i: s.range(1))
    flow.view("d", lambda s, i: i["x"], reads=("x",))
    with pytest.raises(LookupError, match="x"):
        flow.order()


def test_batch_flow_counts_and_drops(spark, settings, ten):
    flow = Flow(spark, settings())
    flow.view("raw", lambda s, i: ten)
    flow.table(
        "kept", lambda s, i: i["raw"], reads=("raw",), comment="It's kept", expectations=(RULE, WARN)
    )
    flow.sql_table("total", "SELECT count(*) AS n FROM kept", reads=("kept",))
    flow.run()
    assert spark.table(flow.settings.table("total")).first().n == 5
    assert flow.quality("kept") == {
        "small": {"passed": 5, "failed": 5, "nulls": 0},
        "tiny": {"passed": 3, "failed": 7, "nulls": 0},
    }
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {flow.settings.table('kept')}")
    assert details.where("col_name = 'Comment'").first().data_type == "It's kept"


def test_streaming_flow_picks_up_where_it_stopped(spark, settings, ten, tmp_path):
    source, place = str(tmp_path / "in"), settings(max_files_per_trigger=1)

    def build():
        flow = Flow(spark, place)
        flow.view("raw", lambda s, i: ingest_files(s, source, READING_SCHEMA, max_files=1))
        flow.table("bronze", lambda s, i: i["raw"], reads=("raw",))
        flow.sql_table(
            "kept", "SELECT * FROM bronze", streams=("bronze",), expectations=(RULE, WARN)
        )
        flow.run()
        return flow

    replay_files(ten, source, "datetime", 3)
    flow = build()
    assert spark.table(place.table("kept")).count() == 5
    assert flow.quality("kept")["small"] == {"passed": 5, "failed": 5, "nulls": 0}
    assert build().quality("kept")["small"] == {"passed": 5, "failed": 5, "nulls": 0}
    replay_files(ten, source, "datetime", 1)
    assert build().quality("kept")["small"] == {"passed": 10, "failed": 10, "nulls": 0}
    assert spark.table(place.table("bronze")).count() == 20
    assert spark.table(place.table("kept")).count() == 10


def test_rule_counts_outlast_the_progress_reports(spark, settings, ten, tmp_path):
    """More micro-batches than a query remembers reports of."""
    source = str(tmp_path / "in")
    replay_files(ten, source, "datetime", 8)
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        flow = Flow(spark, settings())
        flow.view("raw", lambda s, i: ingest_files(s, source, READING_SCHEMA, max_files=1))
        flow.table("kept", lambda s, i: i["raw"], reads=("raw",), expectations=(RULE,))
        flow.run()
        assert len(flow.queries["kept"].recentProgress) <= 2
        assert flow.quality("kept") == {"small": {"passed": 5, "failed": 5, "nulls": 0}}
        flow.stop()
        assert flow.quality("kept") == {"small": {"passed": 5, "failed": 5, "nulls": 0}}
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)


def test_running_flow_can_be_stopped(spark, settings, ten, tmp_path):
    source = str(tmp_path / "in")
    replay_files(ten, source, "datetime", 1)
    flow = Flow(spark, settings(trigger="1 second"))
    flow.view("raw", lambda s, i: ingest_files(s, source, READING_SCHEMA))
    flow.table("bronze", lambda s, i: i["raw"], reads=("raw",))
    flow.table("copy", lambda s, i: i["bronze"], streams=("bronze",))
    flow.run(wait=False)
    try:
        flow.queries["bronze"].processAllAvailable()
        flow.queries["copy"].processAllAvailable()
        assert all(q.isActive for q in flow.queries.values())
    finally:
        flow.stop()
    assert spark.table(flow.settings.table("copy")).count() == 10


def test_layers_side_by_side_equal_layers_in_turn(spark, settings, readings, devices, dates, tmp_path):
    source = str(tmp_path / "in")
    df = readings(*[(1 + i % 2, f"00:{i:02d}:00", float(i)) for i in range(20)])
    replay_files(df, source, "datetime", 4)
    limits = derive_thresholds(batch_layers(df, devices, dates).gold, factor=0.5)
    bronze = ingest_files(spark, source, READING_SCHEMA, max_files=1)
    running = settings(trigger="1 second")
    queries = stream_layers(spark, running, bronze, devices, dates, limits)
    try:
        for _ in range(2):  # a layer may get rows while an earlier one is awaited
            for name in ("bronze", "silver", "gold", "alerts"):
                queries[name].processAllAvailable()
    finally:
        for q in queries.values():
            q.stop()
    found = spark.read.parquet(running.data_path("alerts")).drop("window")
    expected = batch_layers(df, devices, dates, limits).alerts.drop("window")
    closed = expected.where("end <= TIMESTAMP '2024-01-01 00:18:00'")
    key = lambda r: str(r)
    assert sorted(found.collect(), key=key) == sorted(closed.collect(), key=key)
    assert found.count() > 5


def test_saved_queries(spark, settings, ten, devices, dates):
    place = settings()
    flow = Flow(spark, place)
    layers = batch_layers(ten, devices, dates)
    flow.table("device_info", lambda s, i: devices)
    flow.table("dim_date", lambda s, i: dates)
    flow.table("bronze", lambda s, i: ten)
    flow.table("silver", lambda s, i: layers.silver)
    flow.table("gold", lambda s, i: layers.gold)
    flow.table("thresholds", lambda s, i: derive_thresholds(i["gold"]), reads=("gold",))
    flow.run()
    saved = SavedQueries(spark, place)
    assert saved.sensor_reference().count() == 3
    assert saved.date_dimension().count() == 31
    assert saved.silver().count() == 10
    assert saved.gold().columns[:4] == ["start", "end", "window", "deviceName"]
    assert [r.sensor5_avg for r in saved.alerts(ordered=True).collect()] == [9.0]
    assert saved.device(1, "bronze").count() == 10 and saved.device(2).count() == 0
    assert saved.device_count().first().device_count == 1
    plan = saved.device(1)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(device,1)" in plan
    star = saved.star_schema()
    assert "window" not in star["agg_window"].columns
    assert star["fact_reading"].join(star["dim_device"], "device").count() == 10
