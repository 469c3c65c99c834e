"""Bring a DataFrame to a declared schema, or report how it departs from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the declared columns in declared order and types; absent ones become NULL."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType))
        .alias(f.name)
        for f in schema.fields
    ])


def typed(df: DataFrame, **types: str) -> DataFrame:
    """Cast text columns; text that does not parse becomes NULL."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def schema_report(df: DataFrame, schema: StructType, required: list[str] | None = None) -> DataFrame:
    """One row per declared or present column: its types, whether it is ok, missing, extra or
    of another type, and how many rows hold NULL there. A required column that is absent or
    has NULLs is not ok. The NULL counts come from one pass over the data."""
    required = required or []
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in schema.fields}
    names = [*want, *[n for n in have if n not in want]]
    totals = df.agg(F.count(F.lit(1)).alias("rows"),
                    *[F.count_if(F.col(n).isNull()).alias(f"null_{n}") for n in have])

    def entry(name: str):
        nulls = F.col(f"null_{name}") if name in have else F.col("rows")
        if name not in have:
            state = F.lit("missing")
        elif name not in want:
            state = F.lit("extra")
        elif have[name] != want[name]:
            state = F.lit("type")
        elif name in required:
            state = F.when(nulls > 0, "null").otherwise("ok")
        else:
            state = F.lit("ok")
        return F.struct(
            F.lit(name).alias("column"),
            F.lit(want.get(name)).cast("string").alias("expected_type"),
            F.lit(have.get(name)).cast("string").alias("found_type"),
            state.alias("state"),
            nulls.alias("null_rows"),
        )

    return totals.select(F.inline(F.array(*[entry(n) for n in names])))


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Fail at once if a required column is absent."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"required columns are missing: {', '.join(absent)}")
    return df
