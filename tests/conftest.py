import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("fleetgauge-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def readings(spark):
    """Build readings from (device, 'HH:MM:SS', value) with all sensors alike."""
    from fleetgauge.schemas import SENSORS

    def build(*rows, day="2024-01-01"):
        frame = spark.createDataFrame(
            [(d, f"{day} {t}", v) for d, t, v in rows], "device int, t string, v double"
        )
        return frame.selectExpr(
            "device", "CAST(t AS TIMESTAMP) AS datetime", *[f"v AS {s}" for s in SENSORS]
        )

    return build


@pytest.fixture
def devices(spark):
    return spark.createDataFrame(
        [(1, "Device - 1", "Miami, FL"), (2, "Device - 2", "Boston, MA"), (3, "Device - 3", None)],
        "device int, deviceName string, location string",
    )


@pytest.fixture
def dates(spark):
    import datetime as dt

    from fleetgauge.operators.dimensions import date_dimension

    return date_dimension(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
