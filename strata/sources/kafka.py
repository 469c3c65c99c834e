"""Kafka as source and sink. The connector is a package of the cluster; the row shape below
is all that the jobs depend on, so any source that gives it will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import json_text


def source_options(servers: str, topic: str, starting: str = "earliest",
                   fail_on_data_loss: bool = False, group_id: str | None = None) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if group_id:
        options["kafka.group.id"] = group_id
    return options


def stream_topic(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    reader = spark.readStream.format("kafka").options(**source_options(servers, topic, **options))
    return as_text(reader.load())


def as_text(records: DataFrame) -> DataFrame:
    """Broker records with key and value as text and columns named by origin."""
    return records.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("kafka_value"),
        *[F.col(c).alias(f"kafka_{c}") for c in ("topic", "partition", "offset", "timestamp")],
    )


def encode(df: DataFrame, key: str = "client_id") -> DataFrame:
    """Rows as (key, value) records: the key column and the whole row as JSON."""
    return df.select(F.col(key).alias("key"), json_text.encode(F.struct("*")).alias("value"))


def write_topic(df: DataFrame, servers: str, topic: str, key: str = "client_id") -> None:
    (encode(df, key).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())
