"""Copy a table as a whole to a serving location, guarded by its key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import exists, remove

# Keys of the served gold tables.
SERVED_KEYS = {
    "assessment_summary_by_classroom": ["classroom_id", "subject", "assessment_period"],
    "educator_performance_metrics": ["educator_id"],
    "school_performance_overview": ["school_id"],
}


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows, rows with a NULL in the key, and surplus rows of repeated keys."""
    absent = F.lit(False)
    for key in keys:
        absent = absent | F.col(key).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(absent, F.col("n"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum(F.when(~absent, F.col("n") - 1)), F.lit(0)).alias("duplicate_keys"),
    )


def serving(spark: SparkSession, target: str) -> DataFrame:
    """The copy that was published last."""
    version = spark.read.parquet(f"{target}/published").agg(F.max("version")).first()[0]
    return spark.read.parquet(_folder(target, version))


def _folder(target: str, version: int) -> str:
    return f"{target.rstrip('/')}/copies/{version:06d}"


def sync_snapshot(spark: SparkSession, source: DataFrame, target: str, keys: list[str]) -> DataFrame:
    """Replace the serving copy at target and return it. The new copy is written once, into a
    folder of its own, and checked; a key violation raises. It is published by one row appended
    to a small table, which is what readers look at: until then, and whatever fails before, they
    have the old copy. Copies older than the one before are removed afterwards."""
    root = target.rstrip("/")
    published = exists(spark, f"{root}/published")
    last = (spark.read.parquet(f"{root}/published").agg(F.max("version")).first()[0]
            if published else 0)
    version = last + 1
    source.write.mode("overwrite").parquet(_folder(root, version))
    staged = spark.read.schema(source.schema).parquet(_folder(root, version))
    found = key_violations(staged, keys).first()
    if found["null_keys"] or found["duplicate_keys"]:
        remove(spark, _folder(root, version))
        raise ValueError(
            f"snapshot refused: {found['null_keys']} rows without a full key, "
            f"{found['duplicate_keys']} surplus rows of repeated keys"
        )
    publish(spark, root, version)
    if version > 2:
        remove(spark, _folder(root, version - 2))
    return staged


def publish(spark: SparkSession, root: str, version: int) -> None:
    """Point readers to a copy."""
    spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("at")
                          ).write.mode("append").parquet(f"{root}/published")
