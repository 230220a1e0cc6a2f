"""A third of all rows on one device, against plain Python."""

import datetime as dt
from collections import defaultdict

import pytest

from fleetgauge.operators.silver import enrich
from fleetgauge.operators.thresholds import derive_thresholds
from fleetgauge.operators.windows import window_averages
from fleetgauge.plans.medallion import batch_layers
from fleetgauge.schemas import SENSORS

ROWS = 9000


@pytest.fixture(scope="module")
def hot(spark):
    sensors = [f"CAST((id * {i}) % 97 AS DOUBLE) AS {s}" for i, s in enumerate(SENSORS, 3)]
    return spark.range(0, ROWS, 1, 8).selectExpr(
        "CAST(IF(id % 3 = 0, 1, 2 + id % 40) AS INT) AS device",
        "TIMESTAMP '2024-01-01' + MAKE_DT_INTERVAL(0, 0, 0, id % 600) AS datetime",
        *sensors,
    )


@pytest.fixture(scope="module")
def fleet(spark):
    return spark.range(1, 43).selectExpr(
        "CAST(id AS INT) AS device", "concat('Device - ', id) AS deviceName", "'x' AS location"
    )


def brute_force():
    sums = defaultdict(lambda: [0.0, 0])
    for i in range(ROWS):
        device = 1 if i % 3 == 0 else 2 + i % 40
        start = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i % 600 // 30 * 30)
        cell = sums[start, f"Device - {device}"]
        cell[0] += (i * 7) % 97  # sensor5
        cell[1] += 1
    gold = {k: total / n for k, (total, n) in sums.items()}
    top = defaultdict(float)
    for (_, name), value in gold.items():
        top[name] = max(top[name], value)
    found = {k: v for k, v in gold.items() if v > top[k[1]] - (top[k[1]] - top[k[1]] * 0.97)}
    return gold, found


@pytest.mark.parametrize("limit", [2**26, 0])
def test_hot_device_by_broadcast_and_by_shuffle(spark, hot, fleet, dates, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20000")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    try:
        silver = enrich(hot, fleet, dates, limit=limit)
        gold, _ = brute_force()
        found = {
            (r.window.start, r.deviceName): r.sensor5_avg
            for r in window_averages(silver).collect()
        }
        assert found == pytest.approx(gold)
        silver.collect()
        plan = silver._jdf.queryExecution().executedPlan().toString()
        assert ("skew=true" in plan) == (limit == 0)
    finally:
        for key in (
            "spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
        ):
            spark.conf.unset(key)


def test_alerts_with_a_hot_device(hot, fleet, dates):
    _, expected = brute_force()
    layers = batch_layers(hot, fleet, dates)
    found = {(r.start, r.deviceName): r.sensor5_avg for r in layers.alerts.collect()}
    assert found == pytest.approx(expected)
    plan = layers.alerts._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan  # gold is not shuffled again


def test_averages_are_combined_before_the_shuffle(hot, fleet, dates):
    gold = window_averages(enrich(hot, fleet, dates))
    plan = gold._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan and plan.count("Exchange hashpartitioning") == 1
    statistics = derive_thresholds(gold)
    plan = statistics._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert "sensor4" not in plan  # only the measure is read
