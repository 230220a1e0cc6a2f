"""Times the headline queries and the streaming layers; prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import SparkSession

from fleetgauge.operators.silver import enrich
from fleetgauge.plans import bindings as b
from fleetgauge.plans.registered import WEIGHTS, INTERCEPT, queries
from fleetgauge.models.scoring import linear_scorer
from fleetgauge.session import fresh_path, stateful_session
from fleetgauge.sinks.tables import stream_to_path
from fleetgauge.sources.files import ingest_files, stream_files
from fleetgauge.streaming.layers import start_gold
from fleetgauge.streaming.runner import drain, rows_read

HEADLINES = (
    "alerts_current",
    "alerts_wide",
    "gold_window_batch",
    "sensor_wide_windows",
    "silver_enriched",
    "silver_scored",
    "expectation_metrics",
    "threshold_statistics",
    "bi_star_schema",
    "model_fit_linear",
    "model_registered_function",
    "compact_partitioned",
    "envelope_roundtrip",
    "bronze_stream_ingest",
    "silver_stream",
    "gold_window_stream",
    "gold_additive_stream",
    "gold_closed_windows",
    "alerts_stream",
)


def timed(work: Callable) -> tuple[float, object]:
    begun = time.perf_counter()
    result = work()
    return time.perf_counter() - begun, result


def run_query(spark: SparkSession, sf_dir: str, name: str) -> float:
    def work():
        queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    return round(timed(work)[0], 3)


def run_layers(spark: SparkSession, sf_dir: str) -> dict[str, dict[str, float]]:
    """Rows per second and slowest micro-batch of each layer, over lineitem."""
    readings = b.item_readings(spark, sf_dir)
    source = b.replayed(readings, sf_dir, "lineitem", "json")
    devices, dates = b.item_devices(spark, sf_dir), b.item_dates(spark, sf_dir)
    session = stateful_session(spark)
    bronze, silver = fresh_path(spark, "bench-bronze"), fresh_path(spark, "bench-silver")
    figures = {}

    def layer(name: str, start: Callable) -> None:
        seconds, query = timed(lambda: drain(start()))
        slowest = max(p.batchDuration for p in query.recentProgress) / 1000
        figures[name] = {
            "rows_per_sec": round(rows_read(query) / seconds),
            "slowest_batch_sec": round(slowest, 3),
        }

    def to(path: str, df):
        return stream_to_path(df, path, fresh_path(spark, "bench-cp"), trigger="availableNow")

    raw = ingest_files(spark, source.path, source.schema, max_files=source.max_files)
    layer("bronze", lambda: to(bronze, raw))
    scored = enrich(
        stream_files(spark, bronze, source.schema, "parquet"),
        devices,
        dates,
        linear_scorer(WEIGHTS, INTERCEPT),
    )
    layer("silver", lambda: to(silver, scored))
    for mode in ("append", "complete", "additive"):
        rows = stream_files(session, silver, scored.schema, "parquet")
        out, cp = fresh_path(spark, "bench-gold"), fresh_path(spark, "bench-cp")
        layer(f"gold_{mode}", lambda: start_gold(rows, out, cp, mode, trigger="availableNow"))
    return figures


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("fleetgauge-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run_query(spark, sf_dir, "alerts_current")  # warm the JVM
    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        seconds[name] = run_query(spark, sf_dir, name)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(os.path.basename(sf_dir).removeprefix("sf") or 0),
        "cpus": int(cpus),
        "streaming": run_layers(spark, sf_dir),
    }
    spark.stop()
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
