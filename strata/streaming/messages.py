"""The message layers as streams. Each function starts one query; a layer's output directory
is the next layer's source, so layers restart independently of each other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.plans import messages
from strata.sinks.lake import Lake
from strata.sources import files
from strata.streaming import runner

# How long an hour stays open for late events before hourly_closed() writes it.
CLOSING = "1 hour"


def bronze(raw: DataFrame, path: str, checkpoint: str, continuous: bool = False) -> StreamingQuery:
    """Parsed messages of all clients."""
    return runner.to_files(messages.ingest(raw), path, checkpoint, continuous)


def quarantine(raw: DataFrame, path: str, checkpoint: str, target_topic: str,
               continuous: bool = False) -> StreamingQuery:
    """Records whose body did not parse."""
    return runner.to_files(messages.malformed(raw, target_topic), path, checkpoint, continuous)


def client_layers(bronze_rows: DataFrame, path: str, checkpoint: str,
                  continuous: bool = False) -> StreamingQuery:
    """Validated bronze, one folder per client and in it one per batch. The rebalance hint
    sizes the writers by volume: small clients share one, a dominant client has as many as its
    rows need. A repeated batch replaces what it wrote."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).hint("rebalance", "client_id")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("client_id", "batch_id").parquet(path))

    return runner.each_batch(messages.accepted(bronze_rows), write, checkpoint,
                             continuous=continuous)


def silver(bronze_rows: DataFrame, path: str, checkpoint: str,
           continuous: bool = False) -> StreamingQuery:
    """Valid, enriched messages, each once, however late they come and in whatever batches: a
    repeat is told by the message's identity in the index of the rows stored, not by a
    watermark."""
    write = runner.new_rows(path, messages.MESSAGE_ID, messages.silver)
    return runner.each_batch(bronze_rows, write, checkpoint, continuous=continuous)


def late_arrivals(spark: SparkSession, path: str) -> DataFrame:
    """Per batch of the stored silver rows: how many, and how many of them report an event
    older than the newest of the batches before."""
    stored = spark.read.parquet(path)
    newest = stored.groupBy("batch_id").agg(F.max("event_timestamp").alias("newest"))
    before = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1)
    seen = newest.select("batch_id", F.max("newest").over(before).alias("seen"))
    return stored.join(seen, "batch_id").groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("event_timestamp") < F.col("seen")).alias("late_rows"))


def hourly(silver_rows: DataFrame, path: str, checkpoint: str,
           continuous: bool = False) -> StreamingQuery:
    """Hourly metrics kept current: a batch adds its rows to what the table has of the days it
    touches and stores these days anew. No state is kept, and no row is late. Read the table
    with hourly_table()."""
    write = runner.merged_groups(path, "window_start", messages.hourly_parts,
                                 messages.added_parts)
    return runner.each_batch(silver_rows, write, checkpoint, continuous=continuous)


def hourly_table(spark: SparkSession, path: str) -> DataFrame:
    return messages.hourly_metrics(runner.newest(spark, path).select(
        *messages.HOURLY_KEYS, *messages.HOURLY_PARTS))


def compact_hourly(spark: SparkSession, path: str) -> None:
    """Leave one version of each day; the table stays the same."""
    runner.compact(spark, path)


def hourly_closed(silver_rows: DataFrame, path: str, checkpoint: str, watermark: str = CLOSING,
                  continuous: bool = False) -> StreamingQuery:
    """Hourly metrics written once, when the watermark has closed the hour."""
    return runner.to_files(messages.hourly(silver_rows, watermark), path, checkpoint, continuous)


def clients(bronze_rows: DataFrame, path: str, checkpoint: str,
            continuous: bool = False) -> StreamingQuery:
    """Each client once, when first seen."""
    return runner.to_files(messages.clients(bronze_rows), path, checkpoint, continuous)


def late_rows(query: StreamingQuery) -> int:
    """Rows left out as too late in the batches the query still reports on."""
    return sum(int(op.get("numRowsDroppedByWatermark", 0))
               for p in query.recentProgress for op in p["stateOperators"])


def run_available(lake: Lake, raw: DataFrame, target_topic: str) -> DataFrame:
    """Work off what has arrived, layer by layer, and return the hourly table. Run it again
    to take in what came since; each layer goes on from its own checkpoint."""
    def step(start: Callable[..., StreamingQuery], source: DataFrame, layer: str, name: str,
             *args: str) -> None:
        start(source, lake.path(layer, name), lake.checkpoint(layer, name),
              *args).awaitTermination()

    def arriving(layer: str, name: str, like: DataFrame) -> DataFrame:
        return files.stream_files(lake.spark, lake.path(layer, name), like.schema)

    step(bronze, raw, "bronze", "messages")
    step(quarantine, raw, "bronze", "quarantine", target_topic)
    arrived = arriving("bronze", "messages", messages.ingest(raw))
    step(clients, arrived, "bronze", "clients")
    step(client_layers, arrived, "silver", "by_client")
    step(silver, messages.accepted(arrived), "silver", "messages")
    clean = arriving("silver", "messages", messages.enriched(messages.accepted(arrived)))
    step(hourly, clean, "gold", "hourly")
    return hourly_table(lake.spark, lake.path("gold", "hourly"))
