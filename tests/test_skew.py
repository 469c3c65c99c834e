"""One key holds a third of the rows; results stay whole and no task gets the whole key."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strata.operators import dedup
from strata.plans import education, emails
from strata.sinks import tables

from support import rows

N = 30_000


@pytest.fixture
def small_limits(spark):
    """Thresholds so low that test data counts as skewed, and no broadcast."""
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def hot(column, keys):
    """Key 0 for a third of the rows, the others spread."""
    return F.when(column % 3 == 0, 0).otherwise(F.pmod(F.xxhash64(column), F.lit(keys)))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_drive_item_is_split(spark, small_limits, path):
    (spark.range(N).repartition(8).select(
        F.col("id").cast("string").alias("attachment_unique_id"),
        (F.col("id") % 100).cast("string").alias("email_unique_id"),
        hot(F.col("id"), 500).cast("string").alias("drive_item_unique_id"),
        F.lit("file").alias("attachment_type"), F.lit(None).cast("string").alias("reference_type"),
        F.col("id").alias("size"), F.lit("o").alias("rls_org_key")).write.parquet(path("a")))
    (spark.range(500).select(
        F.col("id").cast("string").alias("drive_item_unique_id"), F.lit("s").alias("sit_id"),
        F.lit("n").alias("sit_name"), F.lit("h").alias("hit_id"), F.lit(1).alias("hit_rank"),
        F.lit("x").alias("summary"), F.lit("c").alias("classification_type"),
        F.current_timestamp().alias("classification_last_scan")).write.parquet(path("h")))
    got = emails.attachment_hits(spark.read.parquet(path("a")), spark.read.parquet(path("h")))
    assert "skew=true" in final_plan(got)
    assert got.count() == N
    assert got.agg(F.count("hit_id"), F.sum("size")).first()[:] == (N, N * (N - 1) // 2)


def test_busy_student_is_split_or_summed_first(spark, small_limits, path):
    (spark.range(N).repartition(8).select(
        F.col("id").alias("assessment_id"), hot(F.col("id"), 1000).alias("student_id"),
        F.lit("math").alias("subject"), F.lit("fall").alias("assessment_period"),
        (F.col("id") % 9 + 1).cast("double").alias("score")).write.parquet(path("tests")))
    spark.range(1000).select(F.col("id").alias("student_id"), (F.col("id") % 20).alias("classroom_id"),
                             (F.col("id") % 5).alias("school_id")).write.parquet(path("pupils"))
    rooms = spark.range(20).select(F.col("id").alias("classroom_id"), F.lit("r").alias("name"),
                                   F.lit("K").alias("grade_level"), (F.col("id") % 5).alias("school_id"),
                                   F.col("id").alias("educator_id"))
    schools = spark.range(5).select(
        F.col("id").alias("school_id"),
        *[F.lit("x").alias(c) for c in ("name", "district", "state", "school_type")])
    people = spark.range(20).select(F.col("id").alias("educator_id"), (F.col("id") % 5).alias("school_id"),
                                    *[F.lit("x").alias(c) for c in ("first_name", "last_name", "role")])
    tests, pupils = spark.read.parquet(path("tests")), spark.read.parquet(path("pupils"))
    summary = education.assessment_summary(schools, rooms, pupils, tests)
    assert "skew=true" in final_plan(summary)
    want = tests.join(pupils, "student_id").groupBy("classroom_id").agg(
        F.count_distinct("student_id"), F.round(F.avg("score"), 2))
    assert rows(summary.select("classroom_id", "student_count", "avg_score")) == rows(want)
    # Summed per student first: the hot student is one row when it reaches the join.
    metrics = education.educator_metrics(schools, people, rooms, pupils, tests)
    assert metrics.agg(F.sum("assessment_count")).first()[0] == N
    overview = education.school_overview(schools, people, rooms, pupils, tests)
    assert overview.agg(F.sum("total_assessments")).first()[0] == N


def test_hot_duplicates(spark):
    df = spark.range(N).repartition(8).select(hot(F.col("id"), 1000).alias("k"), F.col("id").alias("v"))
    got = dedup.first_per_key(df, ["k"])
    assert rows(got) == rows(df.groupBy("k").agg(F.min("v")))


def test_hot_folder_gets_several_files(spark, small_limits, path):
    df = spark.range(N).repartition(8).select(
        hot(F.col("id"), 5).alias("k"), F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("t"))
    tables.overwrite_partitioned(df, path("p"), "k")
    counts = {k: len(list((Path(path("p")) / f"k={k}").glob("*.parquet"))) for k in range(5)}
    assert counts[0] > 1 and sum(counts.values()) < 5 * 16
    assert spark.read.parquet(path("p")).count() == N
