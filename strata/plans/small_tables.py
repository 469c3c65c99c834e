"""Name counts, masked e-mails and the fare filter."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import schemas
from strata.functions.masking import Policy, mask_text, processed_only, secure
from strata.operators import quality
from strata.operators.conform import conform
from strata.operators.quality import Rule

NAME_RULES = [Rule("valid_customer_name", "name <> 'Alice'")]

EMAIL_POLICY = Policy("no_content_group", {"content": mask_text}, ("processed", processed_only))


def name_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("name").agg(F.count("id").alias("name_count"))


def filtered_names(counts: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Counts that satisfy the rules."""
    return quality.enforce(counts, NAME_RULES if rules is None else rules)


def name_counts_at_load(rows: DataFrame, view: str = "random_names") -> DataFrame:
    """Counts with the load time, grouped by every plain column of the select list."""
    rows.createOrReplaceTempView(view)
    return rows.sparkSession.sql(
        f"SELECT name, current_timestamp() AS load_time, count(id) AS name_count "
        f"FROM {view} GROUP BY ALL")


def grouped_emails(emails: DataFrame) -> DataFrame:
    """Requested amounts added up over rows that agree in everything else."""
    keys = [c for c in schemas.MASKED_EMAIL.names if c != "requested_amount"]
    total = emails.groupBy(*keys).agg(F.sum("requested_amount").alias("requested_amount"))
    return conform(total, schemas.MASKED_EMAIL)


def masked_emails(emails: DataFrame, groups: Collection[str]) -> DataFrame:
    """The e-mail table as a reader in these groups sees it."""
    return secure(conform(emails, schemas.MASKED_EMAIL), EMAIL_POLICY, groups)


def cheap_trips(trips: DataFrame, limit: float = 30) -> DataFrame:
    return trips.filter(F.col("fare_amount") < limit)
