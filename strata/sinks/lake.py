"""Layered storage: bronze, silver and gold directories below one root."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.sinks import tables


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def checkpoint(self, layer: str, name: str) -> str:
        """Where the stream that writes this dataset keeps its progress."""
        return self.path("_checkpoints", f"{layer}_{name}")

    def store(self, df: DataFrame, layer: str, name: str) -> DataFrame:
        """Replace a dataset and return it as stored, so that what follows does not compute
        it again."""
        return tables.overwrite_path(df, self.path(layer, name))

    def store_counted(self, df: DataFrame, layer: str, name: str) -> tuple[DataFrame, int]:
        """store() and the number of rows, counted while they are written."""
        watch = Observation(f"{layer}.{name}")
        stored = self.store(df.observe(watch, F.count(F.lit(1)).alias("rows")), layer, name)
        return stored, watch.get["rows"]

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))
