"""E-mail attachments with their sensitive-information hits, and one summary row per e-mail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import schemas
from strata.functions import labels
from strata.operators import quality
from strata.operators.conform import conform
from strata.operators.quality import Rule
from strata.sinks.lake import Lake

ATTACHMENT_RULES = [Rule("valid_email_and_org",
                         "email_unique_id IS NOT NULL AND rls_org_key IS NOT NULL")]
EMAIL_RULES = [Rule("valid_email_and_org",
                    "unique_email_id IS NOT NULL AND rls_org_key IS NOT NULL")]

# Columns that describe an e-mail and are the same on all its recipient rows.
DESCRIPTIVE = [
    "email_id", "cloud_storage_organization_id", "user_email", "created_date_time",
    "last_modified_date_time", "received_date_time", "sent_date_time", "has_attachments",
    "internet_message_id", "subject", "importance", "parent_folder_id", "conversation_id",
    "is_read", "is_draft", "web_link", "inference_classification", "flag_status",
    "email_sensitivity_label_id", "email_sensitivity_label_name", "email_category",
    "email_odata_type", "sender_name", "sender_address", "from_name", "from_address",
    "sender_address_domain", "sender_address_domain_is_external",
    "sender_address_domain_is_consumer", "from_address_domain",
    "from_address_domain_is_external", "from_address_domain_is_consumer",
]


def of_org(df: DataFrame, org: str | None) -> DataFrame:
    return df if org is None else df.filter(F.col("rls_org_key") == org)


def attachment_hits(attachments: DataFrame, hits: DataFrame, org: str | None = None) -> DataFrame:
    """Each attachment once per hit on its drive item, or once without. No layout or
    broadcast is forced: the join strategy follows the real sizes, and adaptive execution
    splits a drive item (or the missing one) that many attachments share."""
    found = hits.select(
        "drive_item_unique_id", "sit_id", "sit_name", "hit_id", "hit_rank",
        F.col("summary").alias("sit_summary"), "classification_type", "classification_last_scan")
    kept = of_org(quality.enforce(attachments, ATTACHMENT_RULES), org)
    rows = kept.join(found, "drive_item_unique_id", "left").withColumns({
        "share_type": labels.share_type(F.col("attachment_type"), F.col("reference_type")),
        "size_display": labels.size_display(F.col("size")),
    })
    return conform(rows, schemas.ATTACHMENT_HITS)


def attachment_totals(rows: DataFrame) -> DataFrame:
    """Attachments and bytes per e-mail. An attachment appears once per hit, so its size is
    taken once before adding up."""
    single = rows.groupBy("email_unique_id", "rls_org_key", "attachment_unique_id").agg(
        F.max("size").alias("size"))
    return single.groupBy("email_unique_id", "rls_org_key").agg(
        F.count("attachment_unique_id").alias("attachment_count"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("attachment_size"),
    )


def _as_text(df: DataFrame, *keys: str) -> DataFrame:
    """Ids of either type as text: a join on one type needs no cast and so no new layout."""
    return df.withColumns({k: F.col(k).cast("string") for k in keys})


def _any(condition: Column) -> Column:
    return F.bool_or(F.coalesce(condition, F.lit(False)))


def email_summary(recipients: DataFrame, attachments: DataFrame,
                  org: str | None = None) -> DataFrame:
    """One row per e-mail from its recipient rows and its attachments.

    Recipients are grouped before the attachment totals join: both sides are then keyed by
    e-mail and organisation, so the join moves no data again and meets each e-mail once.
    Of a descriptive column the smallest non-NULL value is taken, the same on every run."""
    kind = F.col("recipient_type")
    receives = kind.isin("to", "cc", "bcc")
    external = receives & F.col("recipient_address_domain_is_external")
    consumer = receives & F.col("recipient_address_domain_is_consumer")
    recipients = _as_text(recipients, "unique_email_id", "rls_org_key")
    attachments = _as_text(attachments, "email_unique_id", "rls_org_key")
    kept = of_org(quality.enforce(recipients, EMAIL_RULES), org)
    present = [c for c in DESCRIPTIVE if c in recipients.columns]
    emails = kept.groupBy("unique_email_id", "rls_org_key").agg(
        *[F.min(c).alias(c) for c in present],
        F.count_if(receives).alias("recipient_count"),
        *[F.count_if(kind == k).alias(f"{k}_count") for k in ("to", "cc", "bcc", "reply_to")],
        F.count_if(external).alias("external_recipient_count"),
        _any(external).alias("has_external_recipient"),
        _any(consumer).alias("has_consumer_recipient"),
    )
    totals = attachment_totals(attachments).withColumnRenamed("email_unique_id", "unique_email_id")
    joined = emails.join(totals, ["unique_email_id", "rls_org_key"], "left").na.fill(
        0, ["attachment_count", "attachment_size"])
    moments = ["created", "last_modified", "received", "sent"]
    shown = joined.withColumns({
        **{f"{m}_date": F.to_date(f"{m}_date_time") for m in moments
           if f"{m}_date_time" in present},
        **({"email_category_label": labels.email_category_label(F.col("email_category"))}
           if "email_category" in present else {}),
        "attachment_size_display": labels.size_display(F.col("attachment_size")),
    })
    return conform(shown, schemas.EMAIL_SUMMARY)


def run(lake: Lake, recipients: DataFrame, attachments: DataFrame, hits: DataFrame,
        org: str | None = None) -> DataFrame:
    """Store the attachment view and the summary built from it; of one organisation if given."""
    prefix = f"{org}_" if org else ""
    found = lake.store(attachment_hits(attachments, hits, org), "silver",
                       f"{prefix}attachment_hits")
    return lake.store(email_summary(recipients, found, org), "gold", f"{prefix}emails")
