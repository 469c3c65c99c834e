"""One row per key, with a winner that does not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType


def _orderable(df: DataFrame, skip: list[str]) -> list[Column]:
    return [F.col(f.name) for f in df.schema.fields
            if f.name not in skip and not isinstance(f.dataType, MapType)]


def first_per_key(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Keep the first row of each key in the given order (default: by all other columns).

    Spark cuts each map task's rows to one per key before the shuffle (window group limit),
    so a hot key costs one row per task and not its whole group."""
    spec = Window.partitionBy(*keys).orderBy(*(order or _orderable(df, keys)))
    return df.withColumn("_rank", F.row_number().over(spec)).filter("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, keys: list[str], at: str,
                   ties: list[Column] | None = None) -> DataFrame:
    """Keep the newest row of each key; equal times are settled by ties, then by all columns."""
    rest = _orderable(df, [*keys, at])
    return first_per_key(df, keys, [F.col(at).desc(), *(ties or []), *rest])
