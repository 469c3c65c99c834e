"""Batch and streaming reads of files and tables."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def with_provenance(df: DataFrame) -> DataFrame:
    """Add when and from which file a row was read. Apply directly to a file scan."""
    return df.withColumns({"_ingested_at": F.current_timestamp(),
                           "_source_file": F.col("_metadata.file_path")})


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with a header line plus provenance columns. Without a schema the types are
    inferred, which costs one more pass over the files."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return with_provenance(reader.csv(path))


def read_fixture(spark: SparkSession, path: str) -> DataFrame:
    """A small JSON or CSV file, chosen by its suffix."""
    suffix = PurePosixPath(path).suffix
    if suffix == ".json":
        return spark.read.option("multiLine", True).json(path)
    if suffix == ".csv":
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    raise ValueError(f"unsupported fixture format: {suffix or path}")


def read_json(spark: SparkSession, path: str, schema: StructType,
              one_per_line: bool = True) -> DataFrame:
    """JSON documents of a declared shape. One document per line lets Spark split a file."""
    return spark.read.schema(schema).option("multiLine", not one_per_line).json(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def stream_files(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                 **options: str) -> DataFrame:
    """A stream over the files that match path, e.g. with maxFilesPerTrigger."""
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)


def stream_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.readStream.table(name)


def rate_stream(spark: SparkSession, rows_per_second: int = 10) -> DataFrame:
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def counted_ticks(spark: SparkSession, rows: int, partitions: int = 4) -> DataFrame:
    """A stream of the values 0, 1, ... with `rows` of them in each batch, so that what is made
    of it depends on the values only. A triggered run ends after one batch."""
    return (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows)
            .option("numPartitions", partitions).load())


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, but every column: the stand-in for a dataset that could not be built."""
    return spark.createDataFrame([], schema)


def local_rows(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A handful of literal rows such as one run's metrics; never a way to load data."""
    return spark.createDataFrame(rows, schema)
