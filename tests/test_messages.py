from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import quality
from strata.plans import messages, monitoring
from strata.sources import kafka, synthetic

from support import rows

NOW = "2024-01-10 12:00:00"


def raw(spark, *values, topic="t"):
    data = [(None, v, topic, 0, i, datetime(2024, 1, 10)) for i, v in enumerate(values)]
    return spark.createDataFrame(data, schemas.RAW_MESSAGE)


def body(**fields):
    import json
    full = {"client_id": "c1", "client_name": "C", "timestamp": "2024-01-10T11:30:00Z",
            "event_type": "login", "amount": 5.0, "status": "active", "data": {"k": "v"}}
    return json.dumps({k: v for k, v in {**full, **fields}.items() if v is not None})


def test_edge_cases_fall_where_they_should(spark):
    made = kafka.encode(synthetic.edge_case_messages(spark, NOW))
    records = made.select(
        F.col("key").alias("kafka_key"), F.col("value").alias("kafka_value"),
        F.lit("t").alias("kafka_topic"), F.lit(0).alias("kafka_partition"),
        F.substring("key", 10, 1).cast("bigint").alias("kafka_offset"),
        F.current_timestamp().alias("kafka_timestamp"))
    bronze = messages.ingest(records)
    assert bronze.count() == 4
    accepted = messages.accepted(bronze)
    assert rows(accepted.select("client_id")) == [("client_001",), ("client_003",),
                                                  ("client_004",)]
    assert rows(messages.silver(accepted).select("client_id")) == [("client_001",)]
    failed = quality.rejected(accepted, messages.SILVER_RULES)
    assert rows(failed.select("client_id", F.concat_ws(",", "failed_rules"))) == [
        ("client_003", "valid_status"), ("client_004", "valid_amount")]
    assert rows(messages.of_client(bronze, "client_002").select("client_id")) == [("client_002",)]


def test_bronze_keeps_malformed_and_quarantine_lists_them(spark):
    source = raw(spark, body(), "{bad", "[]", "", None, body(timestamp="nope"))
    bronze = messages.ingest(source)
    assert bronze.columns == [
        *schemas.RAW_MESSAGE.names, "ingestion_timestamp", "client_id", "client_name",
        "event_timestamp", "event_type", "data", "amount", "status", "metadata"]
    assert bronze.count() == 6 and messages.accepted(bronze).count() == 1
    bad = messages.malformed(source, "dlq")
    assert {r.raw_value for r in bad.collect()} == {"{bad", "[]", "", body(timestamp="nope")}
    assert {(r.failure_reason, r.target_dlq_topic) for r in bad.collect()} == {
        ("JSON parsing failed", "dlq")}


def test_body_is_parsed_once(spark):
    plan = messages.ingest(raw(spark, body()))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_null_status_and_amount_are_dropped(spark):
    bronze = messages.ingest(raw(spark, body(status=None), body(amount=None), body()))
    assert messages.silver(bronze).count() == 1


def test_repeats_are_per_topic(spark):
    one = messages.ingest(raw(spark, body(), body()))
    other = messages.ingest(raw(spark, body(), topic="u"))
    got = messages.silver(one.unionByName(one).unionByName(other))
    assert rows(got.select("kafka_topic", "kafka_offset")) == [("t", 0), ("t", 1), ("u", 0)]
    first = got.filter("kafka_topic = 'u'").first()
    assert (first.year, first.month, first.day, first.amount_category) == (2024, 1, 10, "small")


def test_hourly(spark):
    source = raw(spark, body(amount=1.0), body(amount=3.0), body(event_type=None),
                 body(timestamp="2024-01-10T12:00:00Z"))
    got = messages.hourly(messages.silver(messages.ingest(source)))
    assert got.columns == [*messages.HOURLY_KEYS, *messages.HOURLY_VALUES,
                           "gold_processed_timestamp"]
    found = {(r.window_start.hour, r.event_type):
             (r.event_count, r.total_amount, r.avg_amount, r.min_amount, r.max_amount,
              r.unique_event_types) for r in got.collect()}
    assert found == {(11, "login"): (2, 4.0, 2.0, 1.0, 3.0, 1), (11, None): (1, 5.0, 5.0, 5.0, 5.0, 0),
                     (12, "login"): (1, 5.0, 5.0, 5.0, 5.0, 1)}


def test_events_and_their_hours(spark):
    import json
    values = [json.dumps({"id": i, "data": "d", "timestamp": f"2024-01-10T{h}:15:00Z"})
              for i, h in (("a", "08"), ("a", "08"), ("b", "08"), ("c", "09"))]
    source = raw(spark, *values, "{bad", '{"data":"no id"}')
    found = messages.events(source)
    assert found.count() == 4
    got = rows(messages.hourly_events(found).select(F.hour("hour"), "event_count",
                                                    "unique_events"))
    assert got == [(8, 3, 2), (9, 1, 1)]


# --- monitoring ------------------------------------------------------------------------------

@pytest.fixture
def errors(spark):
    return spark.createDataFrame(
        [("c1", "t1", "a", "2024-01-10 11:00:00"), ("c1", "t1", "a", "2024-01-10 11:30:00"),
         ("c1", "t1", "b", "2024-01-10 11:20:00"), ("c1", "t2", "a", "2024-01-10 11:59:59"),
         ("c2", "t1", "a", "2024-01-10 10:59:59"), ("c2", "t1", "z", "2024-01-08 00:00:00")],
        "client_id STRING, table_name STRING, error_message STRING, at STRING"
    ).select("client_id", "table_name", "error_message",
             F.col("at").cast("timestamp").alias("error_timestamp"))


def test_the_edge_of_the_window_counts(errors):
    got = monitoring.error_summary(errors, NOW).select("client_id", "table_name", "error_count")
    assert [tuple(r) for r in got.collect()] == [("c1", "t1", 3), ("c1", "t2", 1)]
    assert rows(monitoring.client_health(errors, NOW).drop("last_error_time")) == [("c1", 4)]
    assert monitoring.error_summary(errors, NOW, "1 DAY").count() == 3


def test_messages_expand_to_the_lists(errors):
    counted = monitoring.error_messages(errors, NOW, "3 DAYS")
    lists = counted.groupBy("client_id", "table_name").agg(F.sort_array(F.flatten(
        F.collect_list(F.expr("array_repeat(error_message, int(message_count))")))).alias("m"))
    want = errors.groupBy("client_id", "table_name").agg(
        F.sort_array(F.collect_list("error_message")).alias("m"))
    assert rows(lists) == rows(want)


def test_error_trend(errors):
    got = monitoring.error_trend(errors, NOW).collect()
    assert [(r.error_hour.hour, r.client_id, r.error_count) for r in got] == [
        (11, "c1", 4), (10, "c2", 1)]


@pytest.fixture
def bronze(spark):
    data = [("c1", "C1", "login" if i % 2 else "update", float(i), "failed" if i < 12 else "active",
             0, i, f"2024-01-10 11:{i:02d}:00") for i in range(20)]
    data += [("c2", "C2", "login", 1.005, "failed", 1, 5, "2024-01-10 11:00:00"),
             ("c2", "C2", "login", 2.0, "failed", 1, 9, "2024-01-09 11:00:00")]
    return spark.createDataFrame(
        data, "client_id STRING, client_name STRING, event_type STRING, amount DOUBLE, "
              "status STRING, kafka_partition INT, kafka_offset BIGINT, at STRING"
    ).withColumn("ingestion_timestamp", F.col("at").cast("timestamp")
                 ).withColumn("event_timestamp", F.col("ingestion_timestamp"))


def test_volume_distribution_and_share(bronze):
    got = monitoring.volume(bronze, NOW).select("client_id", "message_count")
    assert [tuple(r) for r in got.collect()] == [("c1", 20), ("c2", 1)]
    assert rows(monitoring.rows_by_client(bronze)) == [("c1", 20), ("c2", 2)]
    spread = monitoring.event_distribution(bronze, NOW)
    assert rows(spread)[2] == ("c2", "login", 1, 1.01, 1.01)
    share = monitoring.status_share(bronze, NOW).select("client_id", "status", "percentage")
    assert rows(share) == [("c1", "active", 40.0), ("c1", "failed", 60.0), ("c2", "failed", 100.0)]


def test_alert_needs_more_than_the_threshold(bronze):
    assert rows(monitoring.failing_clients(bronze, NOW).select("client_id", "failed_count")) == [
        ("c1", 12)]
    assert monitoring.failing_clients(bronze, NOW, threshold=12).count() == 0


def test_offsets_and_latest(bronze):
    got = monitoring.offset_progress(bronze).drop("last_ingestion_time")
    assert rows(got) == [(0, 0, 19, 20, 0), (1, 5, 9, 2, 3)]
    last = [r.amount for r in monitoring.latest_messages(bronze, 3).collect()]
    assert last == [19.0, 18.0, 17.0]


def test_drop_rate(spark):
    n = spark.range
    got = monitoring.layer_drop_rate(n(8), n(6), n(2)).first()
    assert tuple(got) == (8, 6, 2, 25.0)
    assert monitoring.layer_drop_rate(n(0), n(0), n(0)).first().drop_rate_pct == 0.0


def test_lookback_reaches_the_scan(spark, path):
    spark.range(10).select(F.timestamp_seconds("id").alias("ingestion_timestamp")
                           ).write.parquet(path("m"))
    df = monitoring.recent(spark.read.parquet(path("m")), "ingestion_timestamp", NOW, "1 HOUR")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ingestion_timestamp,2024-01-10 11:00:00.0)" in plan
