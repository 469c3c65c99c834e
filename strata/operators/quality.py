"""Data quality rules: enforce, count, and set failing rows aside.

A rule holds for a row only if its condition is true; a NULL condition counts as a failure.
Rules with action "drop" remove failing rows, rules with action "warn" only count them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str
    action: str = "drop"

    def __post_init__(self) -> None:
        if self.action not in ("drop", "warn"):
            raise ValueError(f"unknown action {self.action!r} in rule {self.name!r}")

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


def not_null(*columns: str, name: str | None = None) -> Rule:
    return Rule(name or "valid_" + "_".join(columns),
                " AND ".join(f"{c} IS NOT NULL" for c in columns))


def _dropping(rules: list[Rule]) -> list[Rule]:
    return [r for r in rules if r.action == "drop"]


def passes(rules: list[Rule]) -> Column:
    """True where no dropping rule fails."""
    return reduce(lambda a, b: a & b, (r.holds() for r in _dropping(rules)), F.lit(True))


def failed_rules(rules: list[Rule]) -> Column:
    """Names of the failing dropping rules, in the order the rules are given."""
    names = [F.when(~r.holds(), F.lit(r.name)) for r in _dropping(rules)]
    return F.array_compact(F.array(*names))


def enforce(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows that satisfy every dropping rule. The conditions stay plain predicates, so they
    reach the scan."""
    for rule in _dropping(rules):
        df = df.filter(rule.condition)
    return df


def rejected(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The complement of enforce(), with the failing rule names in failed_rules."""
    return df.filter(~passes(rules)).withColumn("failed_rules", failed_rules(rules))


def observed(df: DataFrame, rules: list[Rule], name: str) -> tuple[DataFrame, Observation]:
    """enforce() plus the failure count per rule, gathered in the same pass as whatever
    action later runs on the result. Read the counts from observation.get after it."""
    watch = Observation(name)
    counts = [F.count_if(~r.holds()).alias(r.name) for r in rules]
    return enforce(df.observe(watch, F.count(F.lit(1)).alias("rows"), *counts), rules), watch


def rule_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule: action, rows checked and rows failing. One aggregate pass; warn
    and drop rules alike."""
    totals = df.agg(
        F.count(F.lit(1)).alias("checked"),
        *[F.count_if(~r.holds()).alias(f"n{i}") for i, r in enumerate(rules)],
    )
    rows = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
                 F.col("checked"), F.col(f"n{i}").alias("failed"))
        for i, r in enumerate(rules)
    ])
    return totals.select(F.inline(rows))


def dead_letters(df: DataFrame, rules: list[Rule], topic: str, reason: str) -> DataFrame:
    """Rejected rows made ready for a retry queue."""
    return (
        df.filter(~passes(rules))
        .withColumn("failure_reason", F.lit(reason))
        .withColumn("dlq_topic", F.lit(topic))
        .withColumn("retry_count", F.lit(0))
    )
