import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import schemas, session
from strata.sinks import snapshot, tables
from strata.sources import files, jdbc, kafka

from support import rows


def test_csv_has_provenance(spark, path):
    spark.createDataFrame([("s1", "North, East", 40), ("s2", None, None)],
                          "school_id STRING, name STRING, student_capacity INT"
                          ).coalesce(1).write.option("header", True).csv(path("schools.csv"))
    for schema in (StructType.fromDDL("school_id STRING, name STRING, student_capacity INT"), None):
        got = files.read_csv(spark, path("schools.csv"), schema)
        assert dict(got.dtypes)["student_capacity"] == "int"
        assert rows(got.select("school_id", "name", "student_capacity")) == [
            ("s1", "North, East", 40), ("s2", None, None)]
        first = got.first()
        assert "schools.csv/part-" in first._source_file and first._ingested_at is not None


def test_fixture_by_suffix(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"x": 1}, {"x": 2}]')
    (tmp_path / "a.csv").write_text("x\n1\n2\n")
    for name in ("a.json", "a.csv"):
        assert rows(files.read_fixture(spark, str(tmp_path / name))) == [(1,), (2,)]
    with pytest.raises(ValueError, match="unsupported fixture"):
        files.read_fixture(spark, "a.xml")


def test_empty_has_the_full_schema(spark):
    got = files.empty(spark, schemas.PIPELINE_ERROR)
    assert got.count() == 0 and got.columns == schemas.PIPELINE_ERROR.names


def test_kafka_options():
    assert kafka.source_options("h:9092", "t") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "earliest",
        "failOnDataLoss": "false"}
    more = kafka.source_options("h:9092", "t", "latest", True, "g")
    assert (more["startingOffsets"], more["failOnDataLoss"], more["kafka.group.id"]) == (
        "latest", "true", "g")


def test_kafka_records_round_trip(spark):
    df = spark.createDataFrame([("c1", 1.5)], "client_id STRING, amount DOUBLE")
    sent = kafka.encode(df)
    assert rows(sent) == [("c1", '{"client_id":"c1","amount":1.5}')]
    records = sent.select(
        F.encode("key", "UTF-8").alias("key"), F.encode("value", "UTF-8").alias("value"),
        F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        F.lit(7).cast("bigint").alias("offset"), F.current_timestamp().alias("timestamp"))
    got = kafka.as_text(records)
    assert got.columns == schemas.RAW_MESSAGE.names
    assert got.first().kafka_value == '{"client_id":"c1","amount":1.5}'


def test_jdbc_options():
    url = jdbc.postgres_url("db.example", 5432, "main")
    assert jdbc.jdbc_options(url, "t") == {"url": "jdbc:postgresql://db.example:5432/main",
                                           "dbtable": "t"}
    split = jdbc.jdbc_options(url, "t", "id", (0, 100), 4)
    assert split["numPartitions"] == "4" and split["upperBound"] == "100"
    with pytest.raises(ValueError):
        jdbc.jdbc_options(url, "t", "id")


def test_scratch_follows_the_session(spark):
    root = session.scratch_root(spark)
    assert root.endswith("checkpoints")
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_scans_and_shuffles_grow_with_the_input(spark):
    keys = list(session.sizing(1))
    before = {k: spark.conf.get(k) for k in keys}

    def sized(n):
        session.configure(spark, n)
        return [session._bytes(spark.conf.get(k)) for k in keys]

    try:
        assert sized(1 << 20) == [session._bytes(before[k]) for k in keys]
        assert sized(1 << 40) == [4096, 128 << 20]
        assert sized(100 << 40) == [40_000, 1 << 30]
        assert sized(1 << 20) == [session._bytes(before[k]) for k in keys]  # nothing stays
        spark.conf.set(keys[0], "17")  # a choice of the user's
        assert sized(1 << 40)[0] == 4096 and sized(1)[0] == 17
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_shuffles_and_scans_are_sized_by_rows_in_memory(spark):
    keys = list(session.sizing(1))
    session.configure(spark)
    merged = spark.conf.get(session.MERGED)
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in zip(keys, ("12", "128m"), strict=True):
            spark.conf.set(k, v)
        for gb in (1, 6, 60):  # partitions grow with the input, so a task's share does not
            session.configure(spark, gb << 30, 16)
            assert spark.conf.get(keys[0]) == str(max(12, 64 * gb))
            assert session._bytes(spark.conf.get(keys[1])) == 32 << 20
            assert session._bytes(spark.conf.get(session.MERGED)) == 16 << 20
        session.configure(spark, 100 << 40, 16)
        assert session._bytes(spark.conf.get(keys[1])) == 1 << 30
        session.configure(spark, 1 << 20)
        assert [spark.conf.get(k) for k in keys] == ["12", "128m"]
        assert spark.conf.get(session.MERGED) == merged
        spark.conf.set(keys[1], "16KB")  # a smaller choice of the user's
        session.configure(spark, 1 << 20, 16)
        assert session._bytes(spark.conf.get(keys[1])) == 16 << 10
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("text, want", [("134217728b", 1 << 27), ("128MB", 1 << 27), ("16KB", 1 << 14),
                                        ("1g", 1 << 30), ("200", 200)])
def test_sizes_in_settings(text, want):
    assert session._bytes(text) == want


def test_input_bytes(spark, path):
    spark.range(1000).write.parquet(path("x"))
    assert session.input_bytes(spark, path("x")) > 1000


def test_evolving_append(spark, path):
    target = path("evolving")
    tables.append_evolving(spark.createDataFrame([(1,)], "a INT"), target)
    got = tables.append_evolving(spark.createDataFrame([(2, "x")], "a INT, b STRING"), target)
    assert rows(got.select("a", "b")) == [(1, None), (2, "x")]


def test_partitioned_write_prunes(spark, path):
    df = spark.range(100).select((F.col("id") % 4).alias("k"), "id")
    got = tables.overwrite_partitioned(df, path("p"), "k").filter("k = 3")
    assert got.count() == 25
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(k" in plan


def test_tables_and_ddl(spark):
    tables.create_schemas(spark, "layer_a")
    tables.use_schema(spark, "layer_a")
    try:
        name = tables.prefixed("dev", "people")
        for _ in range(2):
            tables.create_table(spark, name, "id INT, name STRING")
        tables.insert_into(spark.createDataFrame([("x", 1)], "name STRING, id BIGINT"), name)
        assert rows(files.read_table(spark, name)) == [(1, "x")]
        tables.set_properties(spark, name, comment="people of dev", quality="silver")
        facts = {r.col_name: r.data_type for r in tables.describe(spark, name).collect()}
        assert facts["Comment"] == "people of dev" and "quality=silver" in facts["Table Properties"]
        tables.overwrite_table(spark.createDataFrame([(2.5,)], "score DOUBLE"), name)
        assert rows(files.read_table(spark, name)) == [(2.5,)]
        tables.as_view(files.read_table(spark, name), "scores")
        assert spark.sql("SELECT score FROM scores").first()[0] == 2.5
        for client in ("c1", "c2"):
            tables.log_error(spark, "pipeline_errors", client, "t", "broke", datetime(2024, 1, 1))
        errors = spark.table("pipeline_errors")
        assert errors.count() == 2 and errors.columns == schemas.PIPELINE_ERROR.names
    finally:
        tables.use_schema(spark, "default")
        spark.sql("DROP SCHEMA layer_a CASCADE")


def test_layer_counts(spark):
    got = tables.layer_counts(bronze=spark.range(3), silver=spark.range(2), gold=spark.range(0))
    assert rows(got) == [("bronze", 3), ("gold", 0), ("silver", 2)]


def test_snapshot_replaces_whole_copies(spark, path):
    target = path("served")
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING")
    assert rows(snapshot.sync_snapshot(spark, one, target, ["k"])) == [(1, "a"), (2, "b")]
    two = spark.createDataFrame([(3, "c")], "k INT, v STRING")
    assert rows(snapshot.sync_snapshot(spark, two, target, ["k"])) == [(3, "c")]
    for bad in ([(4, "d"), (4, "e")], [(None, "f")]):
        with pytest.raises(ValueError, match="snapshot refused"):
            snapshot.sync_snapshot(spark, spark.createDataFrame(bad, "k INT, v STRING"),
                                   target, ["k"])
        assert rows(snapshot.serving(spark, target)) == [(3, "c")]


def test_snapshot_that_fails_late_leaves_the_old_copy(spark, path, monkeypatch):
    def fail(*_):
        raise OSError("lost")

    one = spark.createDataFrame([(1, "a")], "k INT, v STRING")
    snapshot.sync_snapshot(spark, one, path("served"), ["k"])
    with monkeypatch.context() as patched:
        patched.setattr(snapshot, "publish", fail)
        with pytest.raises(OSError):
            snapshot.sync_snapshot(spark, one.union(one.selectExpr("k + 1", "v")),
                                   path("served"), ["k"])
    assert rows(snapshot.serving(spark, path("served"))) == [(1, "a")]
    for n in range(4):
        snapshot.sync_snapshot(spark, one.selectExpr(f"k + {n} AS k", "v"), path("served"), ["k"])
    assert rows(snapshot.serving(spark, path("served"))) == [(4, "a")]
    assert len(os.listdir(path("served") + "/copies")) == 2


def test_buckets_of_keys(spark, path):
    df = spark.range(1000).selectExpr("id % 300 AS k", "id")
    stored = tables.overwrite_bucketed(df, path("buckets"), "k", 8)
    assert len([x for x in os.listdir(path("buckets")) if x.startswith("_bucket=")]) <= 8
    one = tables.bucket_of(stored, "k", 7, 8)
    assert rows(one, "id") == [(7, 7), (7, 307), (7, 607), (7, 907)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan and "PushedFilters: [IsNotNull(k)" in plan


def test_key_violations_count(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (None, "b"), (2, None), (2, "c")],
                               "k INT, l STRING")
    assert tuple(snapshot.key_violations(df, ["k", "l"]).first()) == (6, 2, 2)
