import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge import catalog, storage
from fleetgauge.session import (
    MOST_PARTITIONS,
    fresh_path,
    shared_folder,
    stateful_session,
    stored,
    widen_shuffles,
)
from fleetgauge.sinks.tables import overwrite_path, overwrite_table, preview, stream_to_path
from fleetgauge.sources.files import infer_schema, load_reference_csv, read_json, stream_files
from fleetgauge.sources.tables import read_table, register_stream, view_of_table
from fleetgauge.streaming.runner import drain


@pytest.fixture
def database(spark, tmp_path):
    name = "fleet_tables"
    catalog.init_catalog(spark, name, str(tmp_path / "db"), reset=True)
    return name


def files(folder):
    return [p for p in folder.rglob("part-*") if p.is_file()]


def test_create_and_reset(spark, database, tmp_path):
    overwrite_table(spark.range(3), f"{database}.t", str(tmp_path / "t"))
    catalog.init_catalog(spark, database)
    assert spark.table(f"{database}.t").count() == 3
    catalog.init_catalog(spark, database, reset=True)
    assert not spark.catalog.tableExists(f"{database}.t")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    catalog.drop_table(spark, f"{database}.t")


def test_overwrite_replaces(spark, database, tmp_path):
    for n in (5, 3):
        assert overwrite_table(spark.range(n), f"{database}.t", str(tmp_path / "t")).count() == n
        assert overwrite_path(spark.range(n), str(tmp_path / "p")).count() == n


def test_external_table_over_files(spark, database, tmp_path):
    spark.range(10).selectExpr("id", "id % 2 AS odd").write.partitionBy("odd").parquet(
        str(tmp_path / "f")
    )
    table = catalog.external_table(spark, f"{database}.e", str(tmp_path / "f"), comment="two parts")
    assert table.where("odd = 1").count() == 5
    assert read_table(spark, f"{database}.e").count() == 10
    view_of_table(spark, f"{database}.e", "short_name")
    assert spark.sql("SELECT count(*) FROM short_name").first()[0] == 10
    assert register_stream(table, "again").count() == spark.table("again").count()


def test_ctas_runs_once(spark, database, tmp_path):
    for n in (4, 9):
        catalog.ctas_if_absent(
            spark, f"{database}.c", str(tmp_path / "c"), f"SELECT * FROM range({n})"
        )
    assert spark.table(f"{database}.c").count() == 4


def test_view_and_statistics(spark, database, tmp_path):
    overwrite_table(spark.range(7), f"{database}.s", str(tmp_path / "s"))
    assert catalog.create_view(spark, f"{database}.v", f"SELECT id FROM {database}.s").count() == 7
    catalog.analyze(spark, f"{database}.s")
    row = catalog.statistics(spark, f"{database}.s").first()
    assert (row.table_name, row.row_count) == ("s", 7) and row.size_bytes > 0


def test_compaction_packs_files_without_shuffle(spark, database, tmp_path):
    source = tmp_path / "many"
    spark.range(0, 1000, 1, 40).write.parquet(str(source))
    catalog.external_table(spark, f"{database}.many", str(source))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    packed = catalog.compact_table(spark, f"{database}.many", str(tmp_path))
    assert packed.agg(F.count("*"), F.sum("id")).first() == (1000, 499500)
    assert len(files(source)) == 40
    assert sum(len(files(p)) for p in tmp_path.glob("compact-*")) == 1
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_compaction_respects_the_file_size(spark, tmp_path):
    source, target = tmp_path / "many", tmp_path / "few"
    spark.range(0, 200000, 1, 20).selectExpr("uuid() AS u").write.parquet(str(source))
    size = storage.total_bytes(spark, str(source))
    catalog.compact_path(spark, str(source), str(target), file_bytes=size // 4)
    assert 4 <= len(files(target)) <= 6
    assert spark.read.parquet(str(target)).count() == 200000


def test_compaction_splits_a_hot_partition(spark, tmp_path):
    source, target = tmp_path / "many", tmp_path / "few"
    rows = spark.range(0, 200000, 1, 10).selectExpr(
        "uuid() AS u", "IF(id % 3 = 0, 0, id % 30) AS day"
    )
    rows.write.partitionBy("day").parquet(str(source))
    size = storage.total_bytes(spark, str(source))
    catalog.compact_path(spark, str(source), str(target), size // 10, partition_by="day")
    assert len(files(source)) > 150
    hot, all_files = files(target / "day=0"), files(target)
    assert 2 <= len(hot) and len(all_files) < 60
    key = ["day", "u"]
    assert spark.read.parquet(str(target)).select(key).exceptAll(
        spark.read.parquet(str(source)).select(key)
    ).isEmpty()
    assert spark.read.parquet(str(target)).count() == 200000


def test_bucketed_dimension_is_not_shuffled(spark, database, tmp_path):
    dim = spark.range(100).selectExpr("CAST(id AS INT) AS device", "concat('d', id) AS deviceName")
    table = catalog.save_dimension(dim, f"{database}.dim", str(tmp_path / "dim"), "device", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(1000).selectExpr("CAST(id % 100 AS INT) AS device", "id AS v")
        joined = facts.join(table, "device")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reference_csv(spark, tmp_path):
    path = tmp_path / "thresholds.csv"
    path.write_text("deviceName,Threshold\nDevice - 1 ,16.80  \nDevice - 2,9815.21\n")
    inferred = load_reference_csv(spark, str(path), key="deviceName")
    assert dict(inferred.dtypes) == {"deviceName": "string", "Threshold": "double"}
    assert sorted(map(tuple, inferred.collect())) == [("Device - 1", 16.8), ("Device - 2", 9815.21)]
    given = load_reference_csv(spark, str(path), "deviceName STRING, Threshold DOUBLE")
    assert sorted(given.collect()) == sorted(inferred.collect())
    path.write_text("deviceName,Threshold\nx,1\nx,2\n")
    with pytest.raises(ValueError, match="occurs 2 times"):
        load_reference_csv(spark, str(path), key="deviceName")


def test_schema_from_a_sample(spark, tmp_path):
    line = '{"device": 5, "datetime": "2024-01-01T00:00:00.5Z", "sensor1": 1.5}'
    (tmp_path / "one.json").write_text(line)
    schema = infer_schema(spark, str(tmp_path / "one.json"))
    assert {f.name: f.dataType.simpleString() for f in schema} == {
        "datetime": "timestamp", "device": "bigint", "sensor1": "double",
    }
    assert read_json(spark, str(tmp_path), schema).first().datetime.microsecond == 500000


class Unset:
    """A session without a shared folder."""

    def __init__(self, spark, master):
        self.sparkContext = type(
            "Context", (), {"master": master, "applicationId": spark.sparkContext.applicationId}
        )
        self.conf = self

    def get(self, key, default):
        return default


def test_shared_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark) == configured.rstrip("/")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    assert fresh_path(spark, "x").startswith(shared_folder(spark))
    assert stored(spark.range(3), "kept").count() == 3
    local = Unset(spark, "local[2]")
    assert shared_folder(local) == shared_folder(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Unset(spark, "yarn"))


def test_shuffles_are_widened_but_never_narrowed(spark, tmp_path):
    spark.range(100000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert widen_shuffles(df) == int(before)
        unsized = spark.createDataFrame([(1,)], "id bigint")
        assert widen_shuffles(unsized.join(df, "id").join(df, "id")) == int(before)
        wide = widen_shuffles(df, target=10_000)
        assert int(before) < wide < 200
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(wide)
        assert widen_shuffles(df) == wide
        assert widen_shuffles(df, target=1) == MOST_PARTITIONS
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_stateful_session_is_apart(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    sister = stateful_session(spark, partitions=3)
    assert sister.conf.get("spark.sql.shuffle.partitions") == "3"
    assert sister.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_preview(spark, capsys):
    assert preview(spark.range(2)) is None
    assert "id" in capsys.readouterr().out
    query = preview(spark.readStream.format("rate").load(), rows=1)
    try:
        assert query.isActive
    finally:
        query.stop()


def test_compaction_keeps_types_and_comment(spark, database, tmp_path):
    source = str(tmp_path / "text")
    spark.sql("SELECT 1L AS n, '007' AS code").write.partitionBy("code").parquet(source)
    name, schema = f"{database}.text", T.StructType().add("n", "long").add("code", "string")
    catalog.external_table(spark, name, source, comment="codes", schema=schema, partition_by="code")
    packed = catalog.compact_table(spark, name, str(tmp_path), partition_by="code")
    assert [tuple(r) for r in packed.collect()] == [(1, "007")]
    assert spark.catalog.getTable(name).description == "codes"


def test_a_streamed_table_is_not_compacted(spark, database, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(5).write.parquet(source)
    rows = stream_files(spark, source, fmt="parquet")
    drain(stream_to_path(rows, out, str(tmp_path / "cp"), trigger="availableNow"))
    catalog.external_table(spark, f"{database}.streamed", out)
    with pytest.raises(ValueError, match="stream"):
        catalog.compact_table(spark, f"{database}.streamed", str(tmp_path))
