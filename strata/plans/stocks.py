"""Daily stock figures from nested payload documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import quality
from strata.operators.quality import Rule
from strata.sinks.lake import Lake
from strata.sources import files

RULES = [Rule("date_is_not_null", "stock_date IS NOT NULL"),
         Rule("close_is_not_null", "close IS NOT NULL")]

# Names of the figures inside a payload.
FIGURES = {"open": "1. open", "high": "2. high", "low": "3. low", "close": "4. close",
           "volume": "5. volume"}
SYMBOL = "2. Symbol"


def read_payloads(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Fetched documents; as fetched, each fills a file."""
    return files.read_json(spark, path, schemas.STOCK_PAYLOAD, one_per_line)


def bronze(payloads: DataFrame) -> DataFrame:
    """One row per symbol and day; a payload without a series gives none."""
    days = payloads.select(
        F.element_at("Meta Data", SYMBOL).alias("symbol"),
        F.explode("Time Series (Daily)").alias("date", "figures"),
    )

    def figure(name: str, kind: str):
        return F.element_at("figures", FIGURES[name]).try_cast(kind).alias(name)

    return days.select(
        "date", *[figure(n, "double") for n in ("open", "high", "low", "close")],
        figure("volume", "bigint"), "symbol", F.current_timestamp().alias("ingest_time"),
    )


def silver(rows: DataFrame) -> DataFrame:
    named = rows.select(F.col("date").alias("stock_date"), "symbol", "open", "high", "low",
                        "close", "volume")
    return quality.enforce(named, RULES)


def gold(rows: DataFrame) -> DataFrame:
    return rows.select("stock_date", "symbol", "open", "high", "low", "close", "volume")


def run(lake: Lake, payloads: DataFrame) -> DataFrame:
    raw = lake.store(bronze(payloads), "bronze", "daily_stock_metrics")
    clean = lake.store(silver(raw), "silver", "daily_stock_metrics")
    return lake.store(gold(clean), "gold", "daily_aggregates")
