"""The given tables, read with declared schemas. Declaring the times as TIMESTAMP keeps them
plain columns, so time filters still reach the parquet scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.session import configure, input_bytes

SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, "
              "props STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


# What a row of these tables takes in a task's sort, in units of its bytes in the parquet file.
EXPANDED = 16


class Tables:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.read: dict[str, int] = {}

    def _sized(self, name: str) -> None:
        """Size the session's scans and shuffles for the tables read so far."""
        if name not in self.read:
            self.read[name] = input_bytes(self.spark, self.path(name))
            configure(self.spark, sum(self.read.values()), EXPANDED)

    def schema(self, name: str) -> StructType:
        return StructType.fromDDL(SCHEMAS[name])

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        self._sized(name)
        return self.spark.read.schema(self.schema(name)).parquet(self.path(name))

    def stream(self, name: str, **options: str) -> DataFrame:
        """The table as a stream; the wildcard lets a single file stand for a folder."""
        self._sized(name)
        return (self.spark.readStream.schema(self.schema(name)).options(**options)
                .parquet(f"{self.root}/{name}*.parquet"))
