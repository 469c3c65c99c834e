"""Column masks and row filters by group membership.

Open-source Spark has no is_member(), so the caller states the groups of the reader.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def mask_text(content: Column, restricted: bool) -> Column:
    """'***' for a restricted reader, the content otherwise."""
    return F.when(F.lit(restricted), F.lit("***")).otherwise(content)


def processed_only(processed: Column, restricted: bool) -> Column:
    """A restricted reader sees only rows marked 'Y'; others see all."""
    return F.when(F.lit(restricted), processed == "Y").otherwise(F.lit(True))


@dataclass(frozen=True)
class Policy:
    """Which columns are masked and which rows hidden from members of restricted_group."""

    restricted_group: str
    masks: Mapping[str, Callable[[Column, bool], Column]] = field(default_factory=dict)
    row_filter: tuple[str, Callable[[Column, bool], Column]] | None = None


def secure(df: DataFrame, policy: Policy, groups: Collection[str]) -> DataFrame:
    """The view of df that a reader in these groups may see."""
    restricted = policy.restricted_group in groups
    if policy.row_filter:
        column, visible = policy.row_filter
        df = df.filter(visible(F.col(column), restricted))
    return df.withColumns({c: mask(F.col(c), restricted) for c, mask in policy.masks.items()})


def register_sql_functions(spark: SparkSession, restricted: bool) -> None:
    """The same two functions for SQL users, bound to the reader's standing."""
    flag = "true" if restricted else "false"
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION mask_content(content STRING) RETURNS STRING "
        f"RETURN CASE WHEN {flag} THEN '***' ELSE content END"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION unprocessed_filter(processed STRING) "
        f"RETURNS BOOLEAN RETURN CASE WHEN {flag} THEN processed = 'Y' ELSE true END"
    )


def secured_view(spark: SparkSession, table: str, view: str, masks: Mapping[str, str],
                 row_filter: tuple[str, str], columns: list[str]) -> None:
    """Bind a policy to a stored table: a view in the catalogue that its readers use by name.
    Masked columns and rows pass through functions of the catalogue, so whoever asks the view
    gets the policy, in whatever session. masks has a function per column; row_filter is a
    function and the column it looks at. Spark puts the functions' bodies into the plan, so the
    filter reaches the scan."""
    shown = ", ".join(f"{masks[c]}({c}) AS {c}" if c in masks else c for c in columns)
    visible, by = row_filter
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {shown} FROM {table} "
              f"WHERE {visible}({by})")


def stored_functions(spark: SparkSession, prefix: str, restricted: bool) -> tuple[str, str]:
    """The mask and the row filter as lasting functions of the current schema, one pair for each
    kind of reader: their names."""
    kind = "restricted" if restricted else "open"
    mask, visible = f"{prefix}_mask_content_{kind}", f"{prefix}_processed_only_{kind}"
    flag = "true" if restricted else "false"
    spark.sql(f"CREATE OR REPLACE FUNCTION {mask}(content STRING) RETURNS STRING "
              f"RETURN CASE WHEN {flag} THEN '***' ELSE content END")
    spark.sql(f"CREATE OR REPLACE FUNCTION {visible}(processed STRING) RETURNS BOOLEAN "
              f"RETURN CASE WHEN {flag} THEN processed = 'Y' ELSE true END")
    return mask, visible
