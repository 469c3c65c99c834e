"""Publish state of dashboards from audit events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import labels
from strata.operators import dedup
from strata.plans.monitoring import Moment, recent
from strata.sinks.lake import Lake

# Where a dashboard's page lies, and the audited actions that decide the state.
PAGE = "/sql/dashboardsv3/"
ACTIONS = ("publishDashboard", "unpublishDashboard")


def publish_states(audit: DataFrame, host: str, as_of: Moment = None,
                   lookback: str = "180 DAYS") -> DataFrame:
    """The last publish or unpublish of each dashboard within the lookback."""
    actions = (
        recent(audit, "event_time", as_of, lookback)
        .filter((F.col("service_name") == "dashboards") & F.col("action_name").isin(*ACTIONS))
        .select(
            F.col("request_params.dashboard_id").alias("dashboard_id"),
            "action_name",
            F.col("user_identity.email").alias("actor_email"),
            "identity_metadata.run_by",
            "identity_metadata.run_as",
            "event_time",
        )
    )
    last = dedup.latest_per_key(actions, ["dashboard_id"], "event_time")
    return last.select(
        "dashboard_id",
        labels.publish_state(F.col("action_name")).alias("publish_state"),
        "actor_email", "run_by", "run_as", "event_time",
        F.concat(F.lit(host + PAGE), F.col("dashboard_id").cast("string"))
        .alias("dashboard_url"),
    )


def named(states: DataFrame, names: DataFrame) -> DataFrame:
    """States with the display name of dashboards that are still active."""
    return states.join(names.select("dashboard_id", "display_name"), "dashboard_id", "left")


def run(lake: Lake, audit: DataFrame, names: DataFrame, host: str, as_of: Moment = None) -> DataFrame:
    return lake.store(named(publish_states(audit, host, as_of), names), "gold", "dashboards")
