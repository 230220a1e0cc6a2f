"""Readings of any year stay: the date dimension follows the data."""

from pyspark.sql import functions as F

from fleetgauge.plans import registered

SF = "/root/testdata/sf0.001"


def test_events_of_two_years_all_stay(spark, tmp_path):
    for name in ("customer", "nation"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    events = spark.read.parquet(f"{SF}/events.parquet")
    later = F.expr("ts + INTERVAL 400 DAYS")
    moved = events.withColumn("ts", F.when(F.xxhash64("ts", "user_id") % 2 == 0, later).otherwise(F.col("ts")))
    moved.write.parquet(str(tmp_path / "events.parquet"))
    query = registered.queries()["silver_enriched"]
    assert query(spark, str(tmp_path)).count() == query(spark, SF).count() == events.count()
