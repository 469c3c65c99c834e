"""Refresh log analysis: which technique each refresh used and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import schemas
from strata.sinks.lake import Lake
from strata.sources import files

# The log's vocabulary.
COMPLETE = "MAINTENANCE_TYPE_COMPLETE_RECOMPUTE"
NO_RULES = "EXPECTATIONS_NOT_SUPPORTED"
NO_ISSUE = "UNKNOWN_ISSUE"
NOT_COMPLETE = "incremental recompute"
EXECUTED_AS = "executed as ([A-Z_]+)"

RAW_COLUMNS = ["id", "sequence", "origin", "timestamp", "message", "level", "event_type",
               "maturity_level", "pipeline_id", "pipeline_name", "error"]


def read_log(spark: SparkSession, path: str, pipeline_id: str | None = None,
             pipeline_name: str | None = None) -> DataFrame:
    """Fetched log entries, one JSON document per line. Entries fetched for one pipeline may
    be tagged with its id and name."""
    log = files.read_json(spark, path, schemas.EVENT_LOG)
    tags = {"pipeline_id": pipeline_id, "pipeline_name": pipeline_name}
    return log.withColumns({k: F.lit(v) for k, v in tags.items() if v is not None})


def raw_copy(log: DataFrame) -> DataFrame:
    """The log without its bulky details."""
    return log.select(*RAW_COLUMNS)


def detailed(log: DataFrame, event_type: str) -> DataFrame:
    """The events of one type with details as a struct. Text is parsed, and of it only the
    part that this type fills; a struct is taken as it is."""
    events = log.filter(F.col("event_type") == event_type)
    if log.schema["details"].dataType.typeName() != "string":
        return events
    part = StructType([schemas.REFRESH_DETAILS[event_type]])
    return events.withColumn("details", F.from_json("details", part))


def chosen_entry(entries: Column) -> Column:
    """The first chosen entry, else NULL."""
    return F.get(F.filter(entries, lambda t: t.getField("is_chosen")), F.lit(0))


def _issue(entry: Column) -> Column:
    return F.get(entry.getField("incrementalization_issues"), F.lit(0)).getField("issue_type")


def recompute_reason(entries: Column, chosen_type: Column) -> Column:
    """Why a complete recompute was chosen: the first issue that any entry names. Unsupported
    rules named by the second or third entry win over any other issue."""
    issues = F.transform(entries, _issue)
    unsupported = F.array_contains(F.slice(issues, 2, 2), NO_RULES)
    first = F.get(F.filter(issues, lambda i: i.isNotNull()), F.lit(0))
    reason = F.when(unsupported, NO_RULES).otherwise(F.coalesce(first, F.lit(NO_ISSUE)))
    return F.when(chosen_type == COMPLETE, reason).otherwise(NOT_COMPLETE)


def refreshes(log: DataFrame) -> DataFrame:
    """One row per planning event with the technique chosen, its cost and the reason."""
    planned = detailed(log, "planning_information")
    entries = F.col("details.planning_information.technique_information")
    sources = F.col("details.planning_information.source_table_information")
    return (
        planned
        .select(
            "origin", "timestamp", "message", entries.alias("entries"),
            F.get(sources, F.lit(0)).getField("num_rows").alias("num_rows"),
            chosen_entry(entries).alias("chosen"),
        )
        .select(
            "origin.update_id", "origin.org_id", "origin.pipeline_id", "timestamp",
            "origin.pipeline_name",
            F.regexp_extract("message", EXECUTED_AS, 1).alias("refresh_type"),
            F.col("chosen.maintenance_type").alias("chosen_maintenance_type"),
            F.col("chosen.cost").alias("cost"),
            recompute_reason(F.col("entries"), F.col("chosen.maintenance_type"))
            .alias("recompute_reason"),
            "num_rows",
        )
    )


def flows(log: DataFrame) -> DataFrame:
    """One row per flow definition."""
    defined = detailed(log, "flow_definition")
    return defined.select(
        "origin.update_id", "origin.org_id", "origin.pipeline_id",
        F.col("details.flow_definition.output_dataset").alias("output_dataset"),
        F.col("details.flow_definition.explain_text").alias("query"),
        F.col("details.flow_definition.flow_type").alias("table_type"),
    )


def with_flows(log: DataFrame, keys: tuple[str, ...] = ("update_id",)) -> DataFrame:
    """Refreshes with the flows that share the given keys; a refresh without flows stays.

    The result has every refresh with every flow of its key, so choose keys that few flows
    share: the update, or the update and the pipeline. For whole organisations use
    by_organisation()."""
    described = flows(log).select(*keys, "output_dataset", "query", "table_type")
    return refreshes(log).join(described, list(keys), "left").select(
        "update_id", "org_id", "pipeline_id", "timestamp", "pipeline_name", "refresh_type",
        "chosen_maintenance_type", "recompute_reason", "cost", "num_rows", "output_dataset",
        "query", "table_type",
    )


def by_update(log: DataFrame) -> DataFrame:
    """Refreshes with what is known about the flows of their update, one row per refresh: the
    number of flows and of datasets. flows() holds the flows under the same update_id."""
    per_update = flows(log).groupBy("update_id").agg(
        F.count(F.lit(1)).alias("matching_flows"),
        F.count_distinct("output_dataset").alias("matching_datasets"))
    return refreshes(log).join(per_update, "update_id", "left").na.fill(
        0, ["matching_flows", "matching_datasets"])


def by_organisation(log: DataFrame) -> DataFrame:
    """Refreshes with what is known about the flows of their organisation.

    Matching every refresh with every flow of an organisation would square its rows. Each
    refresh keeps one row instead, with the number of flows it matches; flows() holds the
    flows themselves under the same org_id."""
    per_org = flows(log).groupBy("org_id").agg(
        F.count(F.lit(1)).alias("matching_flows"),
        F.count_distinct("output_dataset").alias("matching_datasets"))
    return refreshes(log).join(per_org, "org_id", "left").na.fill(
        0, ["matching_flows", "matching_datasets"]).select(
        "org_id", "timestamp", "pipeline_id", "pipeline_name", "refresh_type",
        "chosen_maintenance_type", "recompute_reason", "cost", "matching_flows",
        "matching_datasets",
    )


def run(lake: Lake, log: DataFrame, keys: tuple[str, ...] | None = None) -> DataFrame:
    """Store the raw log and the combined table of refreshes and flows: one row per refresh, or
    with keys one per refresh and flow that share them."""
    lake.store(raw_copy(log), "bronze", "raw_event_log")
    combined = by_update(log) if keys is None else with_flows(log, keys)
    return lake.store(combined, "gold", "combined_event_log")
