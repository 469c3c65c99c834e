"""Database tables over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def postgres_url(host: str, port: int | str, database: str) -> str:
    return f"jdbc:postgresql://{host}:{port}/{database}"


def jdbc_options(url: str, table: str, split_column: str | None = None,
                 bounds: tuple[int, int] | None = None, splits: int = 0) -> dict[str, str]:
    """Options of one table. With a numeric split column and its bounds the read is spread
    over several connections; without, it is one task and only fit for small tables."""
    options = {"url": url, "dbtable": table}
    if split_column:
        if not bounds or splits < 2:
            raise ValueError("a split column needs bounds and at least two splits")
        options.update(partitionColumn=split_column, lowerBound=str(bounds[0]),
                       upperBound=str(bounds[1]), numPartitions=str(splits))
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **split) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **split)).load()
