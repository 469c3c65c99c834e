"""Helpers the operators share: staged tables in the shared folder, rows that decisions reach
without a shuffle, joins with hot keys, and ASCII case folding."""

from __future__ import annotations

import string
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import _bytes, remove, scratch_path

ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2000,
         "spark.sql.execution.arrow.maxBytesPerBatch": 16 << 20}
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase)))


def in_batches(df: DataFrame) -> DataFrame:
    """df, in a session that hands Python no more than some 16 MB at a time (or one row)."""
    for key, most in ARROW.items():
        if not 0 < _bytes(df.sparkSession.conf.get(key)) <= most:
            df.sparkSession.conf.set(key, str(most))
    return df


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that end in this block remove their shuffle files at once. A staged table holds
    what they computed, so nothing reads those files again."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


_noted: list[list[str]] = []
IN_PLACE = "spark.sql.requireAllClusterKeysForCoPartition"
HOT = 1000  # a key with more than this part of all rows is hot; there are fewer than so many


@contextmanager
def noted() -> Iterator[list[str]]:
    """The folders of the tables staged within this block, as a list to be removed later."""
    _noted.append([])
    try:
        yield _noted[-1]
    finally:
        _noted.pop()


def _new_folder(spark: SparkSession, label: str) -> str:
    path = scratch_path(spark, label)
    for folders in _noted:
        folders.append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, and a lost
    executor costs no more than the tasks that read it."""
    spark = df.sparkSession
    path = _new_folder(spark, label)
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_in_place(df: DataFrame, label: str) -> DataFrame:
    """Stage df with two more columns: part, the task that wrote a row, and tag, which no other
    row has. The table is bucketed by part, and as a task's rows are of one part each writes one
    file. left_in_place() joins by it without moving these rows."""
    spark = df.sparkSession
    name, path = f"strata_{uuid.uuid4().hex}", _new_folder(spark, label)
    rows = df.withColumns({"part": F.spark_partition_id(),
                           "tag": F.monotonically_increasing_id()})
    buckets = min(4 * max(1, rows.rdd.getNumPartitions()), 40_000)
    with shuffles_removed(spark):
        (rows.write.option("compression", "zstd").option("path", path)
         .bucketBy(buckets, "part").saveAsTable(name))
    return spark.table(name)


def left_in_place(rows: DataFrame, decisions: DataFrame, how: str, chosen: list, label: str,
                  then: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows of stage_in_place() joined (left, left_semi, left_anti or inner) to decisions by part
    and tag, and of that the chosen columns, or what `then` makes of them, staged. The decisions
    travel to the buckets, the rows stay where they are."""
    spark = rows.sparkSession
    before = spark.conf.get(IN_PLACE)
    spark.conf.set(IN_PLACE, "false")
    try:
        found = rows.join(decisions.hint("shuffle_hash"), ["part", "tag"], how).select(*chosen)
        return stage(then(found) if then else found, label)
    finally:
        spark.conf.set(IN_PLACE, before)


def join_hot(rows: DataFrame, groups: DataFrame, on: list[str], total: int) -> DataFrame:
    """rows joined to groups: at most one row per key, none of it null, with the number of its
    rows in a column n. Of `total` rows fewer than a thousand keys can have over a thousandth
    each; these are broadcast, so that no task gets all rows of one, the others are shuffled."""
    hot = groups.where(F.col("n") * HOT > total).collect()
    if not hot:
        return rows.join(groups, on)
    known = F.broadcast(rows.sparkSession.createDataFrame(hot, groups.schema))
    rest = rows.join(known.select(*on), on, "left_anti")
    cold = groups.where(F.col("n") * HOT <= total)
    return rows.join(known, on).unionByName(rest.join(cold, on))


def discard(df: DataFrame) -> None:
    """Remove a staged table that no result reads any more."""
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        remove(df.sparkSession, folder)


def discard_all(spark: SparkSession, folders: list[str]) -> None:
    """Remove the staged tables in these folders; the list is empty then."""
    while folders:
        remove(spark, folders.pop())
