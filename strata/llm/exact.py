"""Exact duplicates by progressive refinement: length, then a prefix, then the whole text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (discard_all, join_hot, left_in_place, lower_ascii, noted, stage,
                               stage_in_place)

PREFIX = 64


def _ingest(docs: DataFrame, id: str, text: str) -> DataFrame:
    """The rows whole, in a struct so that no name clashes, beside a part and tag of their own
    and the two cheap keys. In the stored table the first two steps read no text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return stage_in_place(docs.select(
        F.col(id).alias("doc_id"), F.octet_length(whole).cast("long").alias("size"),
        F.xxhash64(lower_ascii(F.substring(whole, 1, PREFIX))).alias("prefix"),
        F.struct(*[docs[c] for c in docs.columns]).alias("row")), "exact-rows")


def _text(stored: DataFrame, text: str):
    return lower_ascii(F.coalesce(F.col("row").getField(text), F.lit("")))


def _decisions(stored: DataFrame, text: str) -> DataFrame:
    """(part, tag, keep_id, group_size, kept) of every row whose text occurs more than once.
    Texts are hashed where they lie; what travels are keys."""
    narrow, total = stored.select("part", "tag", "size", "prefix"), stored.count()
    groups = narrow.groupBy("size", "prefix").agg(F.count("*").alias("n"))
    lengths = groups.groupBy("size").agg(F.sum("n").alias("m")).where("m > 1")
    alike = groups.join(lengths, "size", "left_semi").where("n > 1")
    wanted = join_hot(narrow, alike, ["size", "prefix"], total).select("part", "tag")
    full = left_in_place(stored, wanted, "left_semi", [
        "part", "tag", "doc_id", "size", F.sha2(_text(stored, text), 256).alias("hash")],
        "exact-full")
    groups = full.groupBy("size", "hash").agg(
        F.max(F.struct("doc_id", "tag")).alias("last"), F.count("*").alias("n")).where("n > 1")
    return join_hot(full, groups, ["size", "hash"], total).select(
        "part", "tag", F.col("last.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("tag") == F.col("last.tag")).alias("kept"))


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. Null counts as empty. Of equal texts
    the row with the largest id stays; null ids rank lowest; of rows that repeat both id and
    text one stays, and the others name its id. Other columns are not looked at. An empty table
    gives an empty result.

    A row of a length, or of a length and prefix, that no other row has is decided without
    reading its text; text_sha256 is a digest for the reader of the result and not part of the
    decision. Groups are counted on the map side, so a group of any size is a row per task, and
    a group of over a thousandth of all rows is decided by a broadcast. Texts are not shuffled."""
    with noted() as folders:
        stored = _ingest(docs, id, text)
        decided = stage(_decisions(stored, text), "exact-decisions")
    found = left_in_place(stored, decided, "left", [
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
        .alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce("kept", F.lit(True)).alias("kept"),
        F.sha2(_text(stored, text), 256).alias("text_sha256")], "exact-groups")
    discard_all(docs.sparkSession, folders)
    return found


def exact_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns; see exact_groups for the rule."""
    with noted() as folders:
        stored = _ingest(docs, id, text)
        gone = stage(_decisions(stored, text).where(~F.col("kept")).select("part", "tag"),
                     "exact-gone")
    rows = left_in_place(stored, gone, "left_anti", ["row"], "exact-kept")
    discard_all(docs.sparkSession, folders)
    return rows.select("row.*")
