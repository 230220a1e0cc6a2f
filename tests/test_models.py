import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from fleetgauge.models.registry import ModelRegistry
from fleetgauge.models.scoring import linear_scorer, register_function, score, scorer
from fleetgauge.models.training import assembler, candidates, fit_linear, train_sensor_model
from fleetgauge.schemas import SENSORS
from fleetgauge.sinks.tables import stream_to_path
from fleetgauge.sources.files import stream_files
from fleetgauge.streaming.runner import drain

FOUR = SENSORS[:4]


@pytest.fixture(scope="module")
def signal(spark):
    """sensor5 = 2 s1 - s2 + 0.5 s3 + s4 plus a little noise."""
    parts = [f"(hash(id, {i}) % 1000) / 100D AS sensor{i}" for i in range(1, 5)]
    df = spark.range(0, 3000, 1, 4).selectExpr(
        "CAST(id AS INT) AS device", "TIMESTAMP '2024-01-01' AS datetime", "id", *parts
    )
    noise = F.expr("(hash(id, 9) % 100) / 5000D")
    truth = 2 * F.col("sensor1") - F.col("sensor2") + 0.5 * F.col("sensor3") + F.col("sensor4")
    return df.withColumn("sensor5", truth + noise).drop("id").cache()


@pytest.fixture(scope="module")
def ensembles(signal):
    fitted = {}
    for family in ("forest", "boosted"):
        estimator, grid = candidates("sensor5", (family,))[family]
        chain = Pipeline(stages=[assembler(FOUR), estimator])
        fitted[family] = chain.fit(signal, grid[0])
    return fitted


def test_search_finds_the_planted_signal(signal):
    found = train_sensor_model(signal)  # features by exclusion
    assert found.family == "linear"
    assert found.score > 0.99 and found.scores["linear"] == found.score
    assert set(found.scores) == {"linear", "forest", "boosted"}
    assert found.model.stages[0].getInputCols() == list(FOUR)
    weights = found.model.stages[-1].coefficients.toArray()
    assert weights == pytest.approx([2, -1, 0.5, 1], abs=0.01)


def test_trials_are_stored_and_the_search_is_bounded(spark, signal, tmp_path):
    found = train_sensor_model(
        signal, families=("linear",), search_rows=100, trials_path=str(tmp_path / "trials")
    )
    trials = spark.read.parquet(str(tmp_path / "trials")).orderBy("trial").collect()
    assert [(t.family, t.parameters, t.metric) for t in trials] == [
        ("linear", "regParam=0.0", "r2"),
        ("linear", "regParam=0.1", "r2"),
    ]
    assert max(t.score for t in trials) == found.score and found.trials == [tuple(t) for t in trials]
    assert found.score > 0.99


def test_search_by_an_error_metric_takes_the_smallest(signal):
    found = train_sensor_model(
        signal, features=FOUR, metric="rmse", families=("linear", "forest")
    )
    assert found.family == "linear"
    assert found.score == min(found.scores.values())


def test_search_stops_at_its_time_limit(signal):
    found = train_sensor_model(signal, features=FOUR, timeout_minutes=0, parallelism=1)
    assert found.scores == {"linear": found.score} and found.score > 0.99


def test_rows_without_target_are_left_out(signal):
    gaps = signal.withColumn("sensor5", F.when(F.col("device") % 2 == 0, F.col("sensor5")))
    weights = fit_linear(gaps).stages[-1].coefficients.toArray()
    assert weights == pytest.approx([2, -1, 0.5, 1], abs=0.01)


def test_scoring_keeps_rows_with_missing_features(spark, signal, ensembles):
    rows = signal.limit(3).withColumn("sensor2", F.when(F.col("device") != 0, F.col("sensor2")))
    for model in (fit_linear(signal), *ensembles.values()):
        scored = score(rows, model)
        assert scored.columns == [*rows.columns, "sensor5Prediction"]
        assert scored.count() == rows.count()
        for r in scored.collect():
            assert (r.sensor5Prediction is None) == (r.sensor2 is None)


def test_linear_score_equals_transform(signal):
    model = fit_linear(signal)
    ours = {r.device: r.sensor5Prediction for r in score(signal, model).collect()}
    theirs = {r.device: r.sensor5Prediction for r in model.transform(signal).collect()}
    assert ours == pytest.approx(theirs)


@pytest.mark.parametrize("family", ["linear", "forest", "boosted"])
def test_sql_function_equals_score(spark, signal, ensembles, family):
    model = fit_linear(signal) if family == "linear" else ensembles[family]
    register_function(spark, model, f"predict_{family}")
    score(signal, model).createOrReplaceTempView("scored")
    worst = spark.sql(
        f"""SELECT max(abs(sensor5Prediction -
                   predict_{family}(sensor1, sensor2, sensor3, sensor4))) FROM scored"""
    ).first()[0]
    assert worst < 1e-9
    nothing = spark.sql(f"SELECT predict_{family}(CAST(NULL AS DOUBLE), 1D, 1D, 1D)").first()[0]
    assert nothing is None


def test_linear_sql_function_is_compiled_with_its_query(spark, signal):
    register_function(spark, fit_linear(signal), "predict_inline")
    signal.createOrReplaceTempView("signal")
    df = spark.sql("SELECT predict_inline(sensor1, sensor2, sensor3, sensor4) AS p FROM signal")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "predict_inline" not in plan


def test_registry(spark, signal, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path))
    with pytest.raises(LookupError):
        registry.load("SensorModel")
    one = fit_linear(signal)
    two = fit_linear(signal.withColumn("sensor5", F.col("sensor5") + 100))
    assert registry.register("SensorModel", one, "first", "r2", 0.99) == 1
    assert registry.register("SensorModel", two) == 2
    registry.describe("SensorModel", 1, "Predicts sensor5 from the first four sensors.")
    registry.transition("SensorModel", 1, "Production")
    listed = {r.version: r for r in registry.listing("SensorModel").collect()}
    assert (listed[1].stage, listed[2].stage) == ("Production", "None")
    assert listed[1].description.startswith("Predicts") and listed[1].score == 0.99
    intercept = lambda m: m.stages[-1].intercept
    assert intercept(registry.load("SensorModel")) == pytest.approx(intercept(two))
    assert intercept(registry.load("SensorModel", 1)) == pytest.approx(intercept(one))
    assert intercept(registry.load("SensorModel", stage="Production")) == pytest.approx(
        intercept(one)
    )
    for wrong in ({"version": 7}, {"stage": "Staging"}):
        with pytest.raises(LookupError):
            registry.load("SensorModel", **wrong)
    with pytest.raises(ValueError):
        registry.transition("SensorModel", 1, "Live")


def test_stage_is_served_by_the_version_moved_there_last(spark, signal, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path))
    models = [fit_linear(signal.withColumn("sensor5", F.col("sensor5") + 10 * i)) for i in range(3)]
    for model in models:
        registry.register("m", model)
    served = lambda: registry.load("m", stage="Production").stages[-1].intercept
    for version in (1, 3, 2):  # 2 is a step back
        registry.transition("m", version, "Production")
        assert served() == pytest.approx(models[version - 1].stages[-1].intercept)
    stages = {r.version: r.stage for r in registry.listing("m").collect()}
    assert stages == {1: "Archived", 2: "Production", 3: "Archived"}
    registry.transition("m", 1, "Production", retire=False)  # as if the second step had failed
    registry.describe("m", 2, "later revision, same stage")
    assert served() == pytest.approx(models[0].stages[-1].intercept)
    registry.transition("m", 3, "Staging")
    assert served() == pytest.approx(models[0].stages[-1].intercept)


def test_facts_without_a_time_are_read(spark, signal, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path))
    registry.register("m", fit_linear(signal))
    old = "name string, version int, stage string, description string, metric string, score double"
    row = spark.createDataFrame([("m", 1, "Production", "", None, None)], old)
    row.coalesce(1).write.parquet(str(tmp_path / "m" / "version=1" / "facts=2"))
    assert registry.facts("m", 1)["moved"] is None
    assert registry.load("m", stage="Production") is not None


def test_half_saved_version_is_invisible(spark, signal, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path))
    (tmp_path / "m" / "version=1").mkdir(parents=True)  # somebody is saving
    assert registry.versions("m") == []
    assert registry.register("m", fit_linear(signal)) == 2
    assert registry.versions("m") == [2]


@pytest.mark.parametrize("family", ["forest", "boosted"])
def test_streams_score_as_batches_do(spark, signal, ensembles, family, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    signal.repartition(3).write.parquet(source)
    stream = stream_files(spark, source, signal.schema, "parquet", max_files=1)
    predict = scorer(ensembles[family])
    drain(stream_to_path(predict(stream), out, str(tmp_path / "cp"), trigger="availableNow"))
    streamed = {r.device: r.sensor5Prediction for r in spark.read.parquet(out).collect()}
    batch = {r.device: r.sensor5Prediction for r in predict(signal).collect()}
    assert streamed == pytest.approx(batch) and len(batch) == 3000


def test_fixed_weights(spark):
    df = spark.sql("SELECT 1D AS sensor1, 2D AS sensor2")
    assert linear_scorer([2.0, -1.0], 0.5, ("sensor1", "sensor2"))(df).first()[-1] == 0.5
    with pytest.raises(ValueError):
        linear_scorer([2.0], 0.5, ("sensor1", "sensor2"))
