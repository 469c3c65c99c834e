"""Table and directory writes, and the DDL around them."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas
from strata.operators.conform import conform


def overwrite_table(df: DataFrame, name: str) -> None:
    """Replace a table, schema included."""
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)


def overwrite_path(df: DataFrame, path: str) -> DataFrame:
    """Replace a parquet directory and return what a reader of it sees."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def overwrite_partitioned(df: DataFrame, path: str, key: str) -> DataFrame:
    """Replace a directory laid out by key. The rebalance hint sizes the write tasks by
    volume: small keys share a task and a file each, a hot key is split over several."""
    df.hint("rebalance", key).write.mode("overwrite").partitionBy(key).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def overwrite_bucketed(df: DataFrame, path: str, key: str, buckets: int = 64) -> DataFrame:
    """Replace a directory laid out in a fixed number of buckets of the key's hash. The number
    of folders does not grow with the keys. Rows of a file are sorted by key, so within a bucket
    row groups without a key are skipped; a hot key's rows are split over several files."""
    rows = df.withColumn("_bucket", _bucket(F.col(key), buckets))
    (rows.hint("rebalance", "_bucket", key).sortWithinPartitions("_bucket", key)
     .write.mode("overwrite").partitionBy("_bucket").parquet(path))
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def bucket_of(stored: DataFrame, key: str, value: object, buckets: int = 64) -> DataFrame:
    """The rows of one key of a table laid out by overwrite_bucketed(); only its bucket is
    read."""
    typed = F.lit(value).cast(stored.schema[key].dataType)
    return stored.filter((F.col("_bucket") == _bucket(typed, buckets)) & (F.col(key) == typed)
                         ).drop("_bucket")


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def append_evolving(df: DataFrame, path: str) -> DataFrame:
    """Append to a directory whose rows may gain columns; readers see the union of columns,
    NULL where a row was written without one."""
    df.write.mode("append").parquet(path)
    return read_evolving(df.sparkSession, path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def log_error(spark: SparkSession, table: str, client_id: str, table_name: str,
              message: str, at: datetime) -> None:
    """Append one row to the central error table, making the table if needed."""
    row = spark.createDataFrame([(client_id, table_name, message, at)], schemas.PIPELINE_ERROR)
    row.write.mode("append").saveAsTable(table)


def as_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def create_schemas(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.sql("CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:name)", args={"name": name})


def use_schema(spark: SparkSession, name: str) -> None:
    spark.sql("USE SCHEMA IDENTIFIER(:name)", args={"name": name})


def create_table(spark: SparkSession, name: str, columns: str,
                 location: str | None = None) -> None:
    """Make an empty parquet table unless it exists; columns is a DDL column list. With a
    location the catalogue only points at the data."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({columns}) USING parquet{place}",
              args={"name": name})


def prefixed(prefix: str, name: str) -> str:
    """The name of one environment's copy of a table."""
    return f"{prefix}_{name}"


def insert_into(df: DataFrame, name: str) -> None:
    """Append rows to an existing table, matched to its columns by name."""
    conform(df, df.sparkSession.table(name).schema).write.insertInto(name)


def set_properties(spark: SparkSession, name: str, comment: str | None = None,
                   **properties: str) -> None:
    """Comment and properties such as quality='silver'; results do not depend on them."""
    if comment is not None:
        properties["comment"] = comment
    pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(f"ALTER TABLE IDENTIFIER(:name) SET TBLPROPERTIES ({pairs})", args={"name": name})


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql("DESCRIBE EXTENDED IDENTIFIER(:name)", args={"name": name})


MARKER = re.compile(r"(?<![:\w]):([A-Za-z_]\w*)")
STATEMENT = re.compile(r"(?:--[^\n]*|'(?:[^'\\]|\\.)*'|`[^`]*`|[^;])+")


def run_script(spark: SparkSession, text: str, **values: object) -> DataFrame | None:
    """Run the statements of a DDL script, ended by semicolons, one after the other; returns what
    the last one gives. Named markers (:env) take their values from the arguments, names of
    objects through IDENTIFIER(concat(:env, '_table')); a marker without a value is an error
    before anything has run. Semicolons in quotes and comments end no statement."""
    statements = [s for s in STATEMENT.findall(text) if re.sub(r"--[^\n]*", "", s).strip()]
    wanted = [set(MARKER.findall(re.sub(r"--[^\n]*|'(?:[^'\\]|\\.)*'", "", s)))
              for s in statements]
    missing = set().union(*wanted) - set(values)
    if missing:
        raise ValueError(f"no value for {sorted(missing)}")
    out = None
    for statement, names in zip(statements, wanted, strict=True):
        out = spark.sql(statement, args={n: values[n] for n in names})
    return out


def layer_counts(**layers: DataFrame) -> DataFrame:
    """One row per layer with its row count."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("record_count"))
        .select(F.lit(name).alias("layer"), "record_count")
        for name, df in layers.items()
    ]
    out = counted[0]
    for part in counted[1:]:
        out = out.unionByName(part)
    return out
