"""Client messages from raw text to hourly metrics. Every function takes batch or stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import schemas
from strata.functions import json_text, labels
from strata.operators import dedup, quality
from strata.operators.quality import Rule

# The rules that decide which messages reach which layer.
BRONZE_RULES = [
    quality.not_null("client_id"),
    Rule("not_null_timestamp", "event_timestamp IS NOT NULL"),
]
SILVER_RULES = [
    Rule("valid_status", "status IN ('active', 'pending', 'completed', 'failed')"),
    Rule("valid_amount", "amount >= 0"),
    Rule("has_event_type", "event_type IS NOT NULL", action="warn"),
]

MESSAGE_ID = ["kafka_topic", "kafka_partition", "kafka_offset"]
HOURLY_KEYS = ["client_id", "client_name", "window_start", "window_end", "event_type", "status"]
HOURLY_PARTS = ["event_count", "amount_sum", "amount_count", "min_amount", "max_amount"]
HOURLY_VALUES = ["event_count", "total_amount", "avg_amount", "min_amount", "max_amount",
                 "unique_event_types"]


def parsed(raw: DataFrame) -> DataFrame:
    """Raw records with the JSON body as a struct in _body. The struct is built once."""
    return raw.withColumn("_body", json_text.parse(F.col("kafka_value"), schemas.MESSAGE))


def ingest(raw: DataFrame) -> DataFrame:
    """Bronze: broker columns, arrival time and the fields of the body. Malformed bodies stay,
    with NULL fields; malformed() lists them."""
    renamed = {"timestamp": "event_timestamp"}
    fields = [F.col(f"_body.{f}").alias(renamed.get(f, f)) for f in schemas.MESSAGE.names]
    return (
        parsed(raw)
        .withColumn("ingestion_timestamp", F.current_timestamp())
        .select(*schemas.RAW_MESSAGE.names, "ingestion_timestamp", *fields)
    )


def malformed(raw: DataFrame, target_topic: str) -> DataFrame:
    """Quarantine of records whose body is not a message."""
    bad = parsed(raw).filter(json_text.malformed(F.col("kafka_value"), F.col("_body")))
    return bad.select(
        F.col("kafka_key").alias("event_key"),
        F.col("kafka_value").alias("raw_value"),
        F.lit("JSON parsing failed").alias("failure_reason"),
        F.current_timestamp().alias("failed_at"),
        F.lit(target_topic).alias("target_dlq_topic"),
    )


def accepted(bronze: DataFrame) -> DataFrame:
    """Validated bronze of all clients; client_id is the layout key on write."""
    return quality.enforce(bronze, BRONZE_RULES).withColumn(
        "bronze_processed_timestamp", F.current_timestamp())


def of_client(df: DataFrame, client_id: str) -> DataFrame:
    """One client's rows. Over a table laid out by client_id only its folder is read."""
    return df.filter(F.col("client_id") == client_id)


def _with_extras(rows: DataFrame) -> DataFrame:
    return rows.select(
        "client_id", "client_name", "event_timestamp", "event_type", "amount", "status",
        "data", "metadata", *MESSAGE_ID,
        F.current_timestamp().alias("silver_processed_timestamp"),
        *[c.alias(n) for n, c in labels.date_parts(F.col("event_timestamp")).items()],
        labels.amount_category(F.col("amount")).alias("amount_category"),
    )


def enriched(bronze: DataFrame) -> DataFrame:
    """Rows that pass the silver rules, with date parts and an amount band."""
    return _with_extras(quality.enforce(bronze, SILVER_RULES))


def silver(bronze: DataFrame) -> DataFrame:
    """Enriched rows, each message once. Offsets repeat between topics, so the topic is part
    of a message's identity. Of repeats the first to arrive stays; equal times are settled by a
    hash of the row, so the winner does not depend on the layout."""
    passed = quality.enforce(bronze, SILVER_RULES)
    arrival = "kafka_timestamp" if "kafka_timestamp" in bronze.columns else "ingestion_timestamp"
    plain = [f.name for f in bronze.schema.fields if f.dataType.typeName() != "map"
             and f.name not in ("ingestion_timestamp", "bronze_processed_timestamp")]
    return _with_extras(dedup.first_per_key(
        passed, MESSAGE_ID, [F.col(arrival), F.xxhash64(*plain)]))


def _hour() -> Column:
    return F.window("event_timestamp", "1 hour")


def hourly_parts(rows: DataFrame) -> DataFrame:
    """Per client, hour, event type and status what hourly metrics are made of. Parts of the
    same group add up, and amounts are added as decimals, so neither the order of rows nor
    their division into batches changes a total."""
    groups = rows.groupBy("client_id", "client_name", _hour().alias("window"),
                          "event_type", "status")
    parts = groups.agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum(F.col("amount").cast("decimal(28,10)")).alias("amount_sum"),
        F.count("amount").alias("amount_count"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
    )
    return parts.select("client_id", "client_name", F.col("window.start").alias("window_start"),
                        F.col("window.end").alias("window_end"), "event_type", "status",
                        *HOURLY_PARTS)


def added_parts(parts: DataFrame) -> DataFrame:
    """Parts of the same group as one."""
    return parts.groupBy(*HOURLY_KEYS).agg(
        F.sum("event_count").alias("event_count"),
        F.sum("amount_sum").cast("decimal(38,10)").alias("amount_sum"),
        F.sum("amount_count").alias("amount_count"), F.min("min_amount").alias("min_amount"),
        F.max("max_amount").alias("max_amount"))


def hourly_metrics(parts: DataFrame) -> DataFrame:
    """The metrics of groups. unique_event_types is the number of types within one type's
    group, so 1, or 0 for NULL."""
    total = F.col("amount_sum").cast("double")
    return parts.select(
        *HOURLY_KEYS, "event_count", total.alias("total_amount"),
        F.try_divide(total, F.col("amount_count")).alias("avg_amount"), "min_amount",
        "max_amount", F.col("event_type").isNotNull().cast("int").alias("unique_event_types"))


def hourly(rows: DataFrame, watermark: str | None = None) -> DataFrame:
    """Gold: metrics per client, hour, event type and status."""
    if watermark:
        rows = rows.withWatermark("event_timestamp", watermark)
    return hourly_metrics(hourly_parts(rows)).withColumn(
        "gold_processed_timestamp", F.current_timestamp())


def clients(bronze: DataFrame) -> DataFrame:
    """Registry of clients with the time each was first seen. On a stream the first name
    seen stays, and state grows with the number of clients only; a batch takes the smallest."""
    if bronze.isStreaming:
        seen = bronze.select("client_id", "client_name").dropDuplicates(["client_id"])
    else:
        seen = bronze.groupBy("client_id").agg(F.min("client_name").alias("client_name"))
    return seen.withColumn("first_seen", F.current_timestamp())


EVENT_RULES = [Rule("has_id", "event_id IS NOT NULL")]


def events(raw: DataFrame) -> DataFrame:
    """Parsed events with an id; malformed bodies have none and drop out."""
    body = raw.withColumn("_body", json_text.parse(F.col("kafka_value"), schemas.EVENT_BODY))
    rows = body.select(
        F.col("kafka_key").alias("event_key"),
        F.col("_body.id").alias("event_id"),
        F.col("_body.data").alias("event_data"),
        F.col("_body.timestamp").alias("event_timestamp"),
        F.current_timestamp().alias("ingestion_timestamp"),
    )
    return quality.enforce(rows, EVENT_RULES)


def hourly_events(rows: DataFrame) -> DataFrame:
    """Count, distinct ids, first and last event per hour."""
    return rows.groupBy(F.date_trunc("hour", "event_timestamp").alias("hour")).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("event_id").alias("unique_events"),
        F.min("event_timestamp").alias("first_event"),
        F.max("event_timestamp").alias("last_event"),
    )
