"""Applying a model to a batch or a stream, from DataFrames and from SQL."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.models.training import PREDICTION
from fleetgauge.schemas import SENSORS


def linear_expression(
    coefficients: list[float], intercept: float, features: tuple[str, ...] = SENSORS[:4]
) -> Column:
    """A linear model as arithmetic that Catalyst compiles with the query."""
    total = F.lit(float(intercept))
    for weight, name in zip(coefficients, features, strict=True):
        total = total + F.lit(float(weight)) * F.col(name)
    return total


def linear_scorer(
    coefficients: list[float],
    intercept: float,
    features: tuple[str, ...] = SENSORS[:4],
    output: str = PREDICTION,
) -> Callable[[DataFrame], DataFrame]:
    expression = linear_expression(coefficients, intercept, features)
    return lambda df: df.withColumn(output, expression)


def _parts(model: PipelineModel) -> tuple[tuple[str, ...], object]:
    assembler, regression = model.stages
    if not isinstance(assembler, VectorAssembler):
        raise TypeError("expected an assembler followed by a regression model")
    return tuple(assembler.getInputCols()), regression


def score(df: DataFrame, model: PipelineModel, output: str = PREDICTION) -> DataFrame:
    """Add the prediction; null where a feature is null. Runs inside the JVM."""
    features, regression = _parts(model)
    if isinstance(regression, LinearRegressionModel):
        weights = regression.coefficients.toArray().tolist()
        return linear_scorer(weights, regression.intercept, features, output)(df)
    known = F.lit(True)
    for name in features:
        known = known & F.col(name).isNotNull()
    # NaN stands in for nulls while the model runs: skipping would drop rows.
    filled = {n: F.coalesce(F.col(n).cast("double"), F.lit(float("nan"))) for n in features}
    keep = [F.col(c) for c in df.columns]
    vector = [c.alias(f"__{n}") for n, c in filled.items()]
    assembler = VectorAssembler(
        inputCols=[f"__{n}" for n in features], outputCol="__features", handleInvalid="keep"
    )
    copy = regression.copy({regression.featuresCol: "__features", regression.predictionCol: "__p"})
    scored = copy.transform(assembler.transform(df.select(*keep, *vector)))
    return scored.select(*keep, F.when(known, F.col("__p")).alias(output))


def scorer(model: PipelineModel, output: str = PREDICTION) -> Callable[[DataFrame], DataFrame]:
    return lambda df: score(df, model, output)


def register_function(
    spark: SparkSession, model: PipelineModel, name: str = "sensorPredictor"
) -> None:
    """Make a model callable from SQL as ``name(feature, ...)``.

    A linear model becomes a SQL function, which is inlined into the plan of
    its caller. A tree ensemble becomes a vectorised function over Arrow
    batches.
    """
    features, regression = _parts(model)
    if isinstance(regression, LinearRegressionModel):
        terms = [
            f"{float(weight)!r}D * {feature}"
            for weight, feature in zip(regression.coefficients.toArray(), features)
        ]
        body = " + ".join([f"{float(regression.intercept)!r}D", *terms])
        arguments = ", ".join(f"{f} DOUBLE" for f in features)
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS DOUBLE "
            f"RETURN {body}"
        )
        return
    spark.udf.register(name, _ensemble_function(regression))


def _ensemble_function(ensemble):
    """A trained tree ensemble as a pandas UDF.

    The trees of a model are few and shallow, so their nodes travel with the
    function; the rows stay in their partitions.
    """
    trees = [_tree_arrays(tree._call_java("rootNode")) for tree in ensemble.trees]
    weights = list(ensemble.treeWeights)
    if ensemble.__class__.__name__.startswith("RandomForest"):
        weights = [1.0 / len(trees)] * len(trees)

    @F.pandas_udf("double")
    def predict(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.astype("float64").to_numpy() for c in columns])
        total = np.zeros(len(x))
        for weight, (feature, split, left, right, value) in zip(weights, trees):
            at = np.zeros(len(x), dtype=np.int64)
            inner = feature[at] >= 0
            while inner.any():
                here = at[inner]
                below = x[np.flatnonzero(inner), feature[here]] <= split[here]
                at[inner] = np.where(below, left[here], right[here])
                inner = feature[at] >= 0
            total += weight * value[at]
        total[np.isnan(x).any(axis=1)] = np.nan
        return pd.Series(total)  # NaN arrives in Spark as null

    return predict


def _tree_arrays(root) -> tuple[np.ndarray, ...]:
    """Nodes of a tree as arrays: feature (-1 in a leaf), split, children, value."""
    rows: list[list[float]] = []

    def add(node) -> int:
        number = len(rows)
        rows.append([-1, 0.0, 0, 0, node.prediction()])
        if node.subtreeDepth() > 0:
            split = node.split()
            rows[number][:2] = [split.featureIndex(), split.threshold()]
            rows[number][2] = add(node.leftChild())
            rows[number][3] = add(node.rightChild())
        return number

    add(root)
    feature, split, left, right, value = map(np.array, zip(*rows))
    return feature.astype(int), split.astype(float), left.astype(int), right.astype(int), value
