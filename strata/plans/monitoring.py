"""Monitoring and alert queries over the message layers and the error table.

as_of is the moment a query looks back from; None means now."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.sinks.tables import layer_counts

Moment = datetime | str | None


def now(as_of: Moment) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def recent(df: DataFrame, column: str, as_of: Moment, lookback: str) -> DataFrame:
    """Rows not older than lookback. The bound folds to a literal, so it reaches the scan."""
    return df.filter(F.col(column) >= now(as_of) - F.expr(f"INTERVAL {lookback}"))


def _rows() -> Column:
    return F.count(F.lit(1))


def error_messages(errors: DataFrame, as_of: Moment = None, lookback: str = "1 HOUR") -> DataFrame:
    """The recent messages of each client and table, each with how often and when last.

    One row per distinct message instead of one list per group: a client whose errors make
    up much of the table would otherwise have to fit into a single row."""
    return (
        recent(errors, "error_timestamp", as_of, lookback)
        .groupBy("client_id", "table_name", "error_message")
        .agg(_rows().alias("message_count"), F.max("error_timestamp").alias("last_error"))
    )


def with_newest(groups: DataFrame, errors: DataFrame, keys: list[str], n: int) -> DataFrame:
    """groups with the messages of their newest n errors as the list recent_messages, newest
    first, equal times in order of the text. Map tasks send n rows per group at most, so a list
    never holds more than n messages however many there are. Keys are compared null-safe."""
    first = Window.partitionBy(*keys).orderBy(F.desc("error_timestamp"), "error_message")
    top = errors.select(*keys, "error_message", F.row_number().over(first).alias("rank")).where(
        F.col("rank") <= n)
    lists = top.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.sort_array(F.collect_list(
        F.struct("rank", "error_message"))).alias("_found"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return groups.join(lists, same, "left").select(*groups.columns, F.coalesce(
        F.col("_found.error_message"), F.array().cast("array<string>")).alias("recent_messages"))


def error_summary(errors: DataFrame, as_of: Moment = None, lookback: str = "1 HOUR",
                  newest: int | None = None) -> DataFrame:
    """Recent errors per client and table, the most frequent first; with the messages of the
    newest ones if `newest` says how many."""
    keys, rows = ["client_id", "table_name"], recent(errors, "error_timestamp", as_of, lookback)
    groups = rows.groupBy(*keys).agg(_rows().alias("error_count"),
                                     F.max("error_timestamp").alias("last_error"))
    if newest is not None:
        groups = with_newest(groups, rows, keys, newest)
    return groups.orderBy(F.desc("error_count"), *keys)


def volume(bronze: DataFrame, as_of: Moment = None, lookback: str = "1 HOUR") -> DataFrame:
    """Messages per client with first and last arrival."""
    return (
        recent(bronze, "ingestion_timestamp", as_of, lookback)
        .groupBy("client_id", "client_name")
        .agg(_rows().alias("message_count"),
             F.min("ingestion_timestamp").alias("first_message"),
             F.max("ingestion_timestamp").alias("last_message"))
        .orderBy(F.desc("message_count"), "client_id")
    )


def rows_by_client(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("client_id").agg(_rows().alias("message_count"))


def layer_drop_rate(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """One row: rows per layer and the share lost from bronze to silver in percent, 0 for an
    empty bronze."""
    counts = layer_counts(bronze=bronze, silver=silver, gold=gold).agg(*[
        F.max(F.when(F.col("layer") == name, F.col("record_count"))).alias(f"{name}_count")
        for name in ("bronze", "silver", "gold")
    ])
    before, after = F.col("bronze_count"), F.col("silver_count")
    share = F.try_divide((before - after).cast("double"), before) * 100
    return counts.withColumn("drop_rate_pct", F.coalesce(share, F.lit(0.0)))


def event_distribution(bronze: DataFrame, as_of: Moment = None,
                       lookback: str = "1 HOUR") -> DataFrame:
    return (
        recent(bronze, "ingestion_timestamp", as_of, lookback)
        .groupBy("client_id", "event_type")
        .agg(_rows().alias("event_count"),
             F.round(F.avg("amount"), 2).alias("avg_amount"),
             F.round(F.sum("amount"), 2).alias("total_amount"))
        .orderBy("client_id", F.desc("event_count"), "event_type")
    )


def latest_windows(gold: DataFrame, n: int = 20) -> DataFrame:
    """The newest n hourly rows; ties on the hour are settled by the other keys."""
    return (
        gold.select("client_id", "window_start", "window_end", "event_type", "status",
                    "event_count", F.round("total_amount", 2).alias("total_amount"),
                    F.round("avg_amount", 2).alias("avg_amount"), "min_amount", "max_amount")
        .orderBy(F.desc("window_start"), "client_id", "event_type", "status")
        .limit(n)
    )


def offset_progress(bronze: DataFrame) -> DataFrame:
    """Per partition: offset range, messages, offsets missing from the range, last arrival."""
    return (
        bronze.groupBy("kafka_partition")
        .agg(F.min("kafka_offset").alias("min_offset"),
             F.max("kafka_offset").alias("max_offset"),
             _rows().alias("messages_processed"),
             F.max("ingestion_timestamp").alias("last_ingestion_time"))
        .withColumn("missing_offsets",
                    F.expr("max_offset - min_offset + 1 - messages_processed"))
        .orderBy("kafka_partition")
    )


def status_share(bronze: DataFrame, as_of: Moment = None, lookback: str = "1 HOUR") -> DataFrame:
    """Rows per client and status, and their share of the client in percent. The window runs
    over counted groups, a few per client, not over messages."""
    client = Window.partitionBy("client_id")
    counted = (recent(bronze, "ingestion_timestamp", as_of, lookback)
               .groupBy("client_id", "status").agg(_rows().alias("status_count")))
    share = F.col("status_count") * F.lit(100.0) / F.sum("status_count").over(client)
    return (counted.withColumn("percentage", F.round(share, 2))
            .orderBy("client_id", F.desc("status_count"), "status"))


def error_trend(errors: DataFrame, as_of: Moment = None, lookback: str = "24 HOURS") -> DataFrame:
    return (
        recent(errors, "error_timestamp", as_of, lookback)
        .groupBy(F.date_trunc("hour", "error_timestamp").alias("error_hour"), "client_id")
        .agg(_rows().alias("error_count"))
        .orderBy(F.desc("error_hour"), F.desc("error_count"), "client_id")
    )


def latest_messages(bronze: DataFrame, n: int = 20) -> DataFrame:
    """The n messages that arrived last; equal times are settled by partition and offset."""
    return (
        bronze.orderBy(F.desc("ingestion_timestamp"), "kafka_partition", F.desc("kafka_offset"))
        .limit(n)
        .select("client_id", "client_name", "event_timestamp", "event_type", "amount",
                "status", "ingestion_timestamp")
    )


def failing_clients(bronze: DataFrame, as_of: Moment = None, lookback: str = "1 HOUR",
                    threshold: int = 10) -> DataFrame:
    """Alert: clients with more than threshold failed messages."""
    failed = bronze.filter(F.col("status") == "failed")
    return (
        recent(failed, "ingestion_timestamp", as_of, lookback)
        .groupBy("client_id")
        .agg(_rows().alias("failed_count"), F.max("event_timestamp").alias("last_failure"))
        .filter(F.col("failed_count") > threshold)
        .orderBy(F.desc("failed_count"), "client_id")
    )


def client_health(errors: DataFrame, as_of: Moment = None, lookback: str = "1 HOUR",
                  newest: int | None = None) -> DataFrame:
    """Recent errors per client; with the messages of the newest ones if `newest` says how many.
    error_messages() lists all messages."""
    rows = recent(errors, "error_timestamp", as_of, lookback)
    groups = rows.groupBy("client_id").agg(_rows().alias("error_count_last_hour"),
                                           F.max("error_timestamp").alias("last_error_time"))
    return groups if newest is None else with_newest(groups, rows, ["client_id"], newest)


def events_of_pipeline(events: DataFrame, pipeline_id) -> DataFrame:
    """One pipeline's events, newest first. Over the table laid out by pipeline_id only that
    pipeline's folder is read."""
    return events.filter(F.col("pipeline_id") == pipeline_id).orderBy(F.desc("event_timestamp"))
