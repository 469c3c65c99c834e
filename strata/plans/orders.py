"""Orders: cleaned rows, revenue summary, and figures about each run."""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import dedup
from strata.sinks import tables
from strata.sinks.lake import Lake


def silver(bronze: DataFrame) -> DataFrame:
    """Each order once, without cancelled ones; an order without status drops out too."""
    single = dedup.first_per_key(bronze.drop("_ingested_at"), ["order_id"])
    return (
        single.filter(F.col("status") != "cancelled")
        .withColumns({
            "order_amount_usd": F.round("order_amount", 2),
            "order_date": F.to_date("order_ts"),
            "_processed_at": F.current_timestamp(),
        })
    )


def revenue(clean: DataFrame) -> DataFrame:
    """Orders, revenue and mean order value per category, state and day.

    Amounts are whole cents by now and are added as such: sums of doubles would change in
    the last digits with the order in which tasks finish."""
    cents = F.round(F.col("order_amount_usd") * 100).cast("bigint")
    return (
        clean.groupBy("category", "state", "order_date")
        .agg(F.count("order_id").alias("num_orders"), F.count("order_amount_usd").alias("_priced"),
             F.sum(cents).alias("_cents"))
        .select("category", "state", "order_date", "num_orders",
                (F.col("_cents") / 100).alias("total_revenue"),
                F.try_divide(F.col("_cents") / 100, F.col("_priced")).alias("avg_order_value"),
                F.current_timestamp().alias("_aggregated_at"))
    )


def run_metrics(spark: SparkSession, run_id: str, job_id: str, started: datetime,
                rows: dict[str, int], seconds: float, status: str = "success") -> DataFrame:
    """The one row that describes a run."""
    return spark.createDataFrame(
        [(run_id, job_id, started, rows["bronze"], rows["silver"], rows["gold"],
          float(seconds), status)],
        schemas.RUN_METRICS,
    )


def compare_runs(metrics: DataFrame) -> DataFrame:
    """Every run with its change in rows and duration against the job's previous run."""
    runs = Window.partitionBy("job_id").orderBy("run_ts", "run_id")

    def change(name: str):
        return F.col(name) - F.lag(name).over(runs)

    return metrics.select(
        "job_id", "run_id", "run_ts", "bronze_rows", "silver_rows", "gold_rows",
        "total_duration_sec",
        change("bronze_rows").alias("delta_bronze"),
        change("total_duration_sec").alias("delta_duration_sec"),
    )


def last_two(metrics: DataFrame) -> DataFrame:
    """The current and the previous run of each job."""
    newest = Window.partitionBy("job_id").orderBy(F.desc("run_ts"), F.desc("run_id"))
    return metrics.withColumn("_rank", F.row_number().over(newest)).filter("_rank <= 2").drop(
        "_rank")


def run(lake: Lake, bronze: DataFrame, run_id: str, job_id: str) -> DataFrame:
    """Write the three layers and append the run's metrics; returns the metrics of all runs.

    Each layer is read back from storage by the next one, and its rows are counted while it
    is written, so nothing is computed twice."""
    started, clock = datetime.now(), time.monotonic()
    rows: dict[str, int] = {}
    raw, rows["bronze"] = lake.store_counted(
        bronze.withColumn("_ingested_at", F.current_timestamp()), "bronze", "orders")
    clean, rows["silver"] = lake.store_counted(silver(raw), "silver", "orders_clean")
    _, rows["gold"] = lake.store_counted(revenue(clean), "gold", "revenue_summary")
    row = run_metrics(lake.spark, run_id, job_id, started, rows, time.monotonic() - clock)
    return tables.append_evolving(row, lake.path("gold", "pipeline_run_metrics"))
