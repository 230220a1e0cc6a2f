"""Search for a regression model that predicts one sensor from the others."""

from __future__ import annotations

import math
import time
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.schemas import SENSORS

PREDICTION = "sensor5Prediction"
FAMILIES = ("linear", "forest", "boosted")


@dataclass(frozen=True)
class Search:
    """Result of a search: the best model refitted on all rows, and all scores."""

    model: PipelineModel
    family: str
    metric: str
    score: float
    scores: dict[str, float] = field(default_factory=dict)
    trials: list[tuple] = field(default_factory=list)


TRIAL = "trial int, family string, parameters string, metric string, score double, seconds double"


def candidates(target: str, families: tuple[str, ...]) -> dict[str, tuple[Estimator, list[dict]]]:
    """Estimators with their parameter grids, by family name."""
    columns = {"featuresCol": "features", "labelCol": target, "predictionCol": PREDICTION}
    linear = LinearRegression(**columns)
    forest = RandomForestRegressor(seed=1, **columns)
    boosted = GBTRegressor(seed=1, maxIter=10, **columns)
    known = {
        "linear": (linear, ParamGridBuilder().addGrid(linear.regParam, [0.0, 0.1]).build()),
        "forest": (forest, ParamGridBuilder().addGrid(forest.maxDepth, [5, 8]).build()),
        "boosted": (boosted, ParamGridBuilder().addGrid(boosted.maxDepth, [3, 5]).build()),
    }
    return {name: known[name] for name in families}


def assembler(features: tuple[str, ...]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")


def fit_linear(
    df: DataFrame, target: str = "sensor5", features: tuple[str, ...] = SENSORS[:4]
) -> PipelineModel:
    """Least squares on all rows: one pass that adds up moments per task."""
    regression = LinearRegression(
        featuresCol="features", labelCol=target, predictionCol=PREDICTION, solver="normal"
    )
    rows = df.select(*features, target).where(F.col(target).isNotNull())
    return Pipeline(stages=[assembler(features), regression]).fit(rows)


def train_sensor_model(
    df: DataFrame,
    target: str = "sensor5",
    features: tuple[str, ...] | None = None,
    exclude: tuple[str, ...] = ("datetime", "device"),
    metric: str = "r2",
    families: tuple[str, ...] = FAMILIES,
    train_ratio: float = 0.8,
    seed: int = 1,
    parallelism: int = 4,
    timeout_minutes: float | None = None,
    search_rows: int = 2_000_000,
    trials_path: str | None = None,
) -> Search:
    """Fit each family over its grid and keep the best on held-out rows.

    Features are the given ones, or every column but the target and
    ``exclude``. All trials share one split of about ``search_rows`` rows at
    most, drawn evenly and cached while they are fitted; only the winner is
    fitted again, on all rows. ``trials_path`` is a folder for the table of
    trials, one without a score having been cut off. Past ``timeout_minutes`` no
    further trial starts; the first one always runs.
    """
    if features is None:
        features = tuple(c for c in df.columns if c != target and c not in exclude)
    rows = df.select(*features, target).where(F.col(target).isNotNull())
    evaluator = RegressionEvaluator(labelCol=target, predictionCol=PREDICTION, metricName=metric)
    better = max if evaluator.isLargerBetter() else min
    deadline = math.inf if timeout_minutes is None else time.monotonic() + 60 * timeout_minutes

    trials = [
        (family, Pipeline(stages=[assembler(features), estimator]), params)
        for family, (estimator, grid) in candidates(target, families).items()
        for params in grid
    ]
    share = min(1.0, search_rows / max(rows.count(), 1))
    searched = rows.sample(share, seed) if share < 1 else rows
    drawn = searched.withColumn("_drawn", F.rand(seed)).persist(StorageLevel.MEMORY_AND_DISK)
    train = drawn.where(F.col("_drawn") < train_ratio)
    held_out = drawn.where(F.col("_drawn") >= train_ratio)

    @inheritable_thread_target(df.sparkSession)
    def attempt(number: int) -> tuple[float | None, float]:
        begun = time.monotonic()
        if number > 0 and begun > deadline:
            return None, 0.0
        _, chain, params = trials[number]
        value = evaluator.evaluate(chain.fit(train, params).transform(held_out))
        return value, time.monotonic() - begun

    try:
        with ThreadPool(parallelism) as pool:
            results = pool.map(attempt, range(len(trials)), chunksize=1)
    finally:
        drawn.unpersist()

    values = [value for value, _ in results]
    table = [
        (
            number,
            family,
            ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda x: x[0].name)),
            metric,
            *results[number],
        )
        for number, (family, _, params) in enumerate(trials)
    ]
    if trials_path:
        df.sparkSession.createDataFrame(table, TRIAL).coalesce(1).write.mode("overwrite").parquet(trials_path)
    done = [number for number, value in enumerate(values) if value is not None]
    scores: dict[str, float] = {}
    for number in done:
        family = trials[number][0]
        scores[family] = better(scores.get(family, values[number]), values[number])
    family, chain, params = trials[better(done, key=lambda number: values[number])]
    return Search(chain.fit(rows, params), family, metric, scores[family], scores, table)
