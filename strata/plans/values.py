"""Parameterised value pipeline: tagged rows, banded values, statistics per band."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import labels
from strata.operators import quality
from strata.operators.quality import Rule
from strata.sinks.lake import Lake

RULES = [Rule("valid_id", "id IS NOT NULL"), Rule("valid_value", "value >= 0")]


def bronze(ids: DataFrame, config: str, value: Column, **tags: str) -> DataFrame:
    """Rows for the given ids with a value, the configuration name and further constant
    tags such as kafka_host or consumer_group."""
    return ids.select("id").withColumns({
        "name": labels.numbered_name("user_", F.col("id")),
        "value": value,
        "timestamp": F.current_timestamp(),
        "config": F.lit(config),
        **{name: F.lit(text) for name, text in tags.items()},
    })


def silver(rows: DataFrame, **tags: str) -> DataFrame:
    """Valid rows with a rounded value and its band."""
    return quality.enforce(rows, RULES).withColumns({
        "value_rounded": F.round("value", 2),
        "value_category": labels.value_category(F.col("value")),
        "processed_timestamp": F.current_timestamp(),
        **{name: F.lit(text) for name, text in tags.items()},
    })


def stats(rows: DataFrame, *by: str, environment: str | None = None) -> DataFrame:
    """Count, mean, extremes and sample deviation per band and further keys."""
    v = "value_rounded"
    out = rows.groupBy("value_category", "config", *by).agg(
        F.count(F.lit(1)).alias("record_count"), F.avg(v).alias("avg_value"),
        F.min(v).alias("min_value"), F.max(v).alias("max_value"),
        F.stddev(v).alias("stddev_value"),
    ).withColumn("aggregation_timestamp", F.current_timestamp())
    return out if environment is None else out.withColumn("environment", F.lit(environment))


def run(lake: Lake, ids: DataFrame, config: str, value: Column, **tags: str) -> DataFrame:
    """Store the three layers under names that carry the configuration."""
    raw = lake.store(bronze(ids, config, value, **tags), "bronze", f"{config}_raw_data")
    clean = lake.store(silver(raw), "silver", f"{config}_processed_data")
    summary = stats(clean, *tags, environment=config)
    return lake.store(summary, "gold", f"{config}_aggregated_data")
