"""Column functions that turn raw values into labels and display text.

Fixed values: the limits and label texts below are part of the results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bands(value: Column, limits: list[tuple[float, str]], rest: str) -> Column:
    """The label of the first limit that value lies below, else rest. NULL gets rest."""
    (first, label), *others = limits
    chain = F.when(value < first, label)
    for limit, label in others:
        chain = chain.when(value < limit, label)
    return chain.otherwise(rest)


def amount_category(amount: Column) -> Column:
    return bands(amount, [(100, "small"), (1000, "medium")], "large")


def value_category(value: Column) -> Column:
    return bands(value, [(33, "low"), (66, "medium")], "high")


def season(day: Column) -> Column:
    """School season of a date: January to March, April to July, the rest."""
    return bands(F.month(day), [(4, "winter"), (8, "spring")], "fall")


def publish_state(action: Column) -> Column:
    return F.when(action == "publishDashboard", "published").otherwise("unpublished")


def email_category_label(category: Column) -> Column:
    return (
        F.when(category == "standard", "Standard Email")
        .when(category == "event", "Event (Cal Invites)")
        .otherwise(category)
    )


def share_type(attachment_type: Column, reference_type: Column) -> Column:
    """How an attachment is shared; NULL for kinds that are not known."""
    linked = attachment_type == "reference"
    return (
        F.when(attachment_type.isin("file", "item"), "Attachment")
        .when(linked & (reference_type == "file"), "M365 File Link")
        .when(linked & (reference_type == "folder"), "M365 Folder Link")
    )


def size_display(size: Column) -> Column:
    """A byte count as text: '-' for none, else the largest fitting binary unit."""
    text = F.when(size.isNull() | (size == 0), "-")
    for unit, power in (("GB", 30), ("MB", 20), ("KB", 10)):
        scaled = F.round(size / float(1 << power), 2)
        text = text.when(size >= (1 << power), F.concat(scaled, F.lit(f" {unit}")))
    return text.otherwise(F.concat(size, F.lit(" B")))


def numbered_name(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def standard_code(subject: Column, major: Column, minor: Column) -> Column:
    """First three letters of the subject in capitals, then two numbers, e.g. MAT.2.7."""
    return F.concat_ws(".", F.upper(F.substring(subject, 1, 3)), major, minor)


def email_address(first: Column, last: Column, number: Column, domain: Column) -> Column:
    return F.concat(F.lower(first), F.lit("."), F.lower(last), number.cast("string"),
                    F.lit("@"), domain)


def date_parts(moment: Column) -> dict[str, Column]:
    return {"year": F.year(moment), "month": F.month(moment), "day": F.dayofmonth(moment)}
