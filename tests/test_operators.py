import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators import conform, dedup, quality
from strata.operators.quality import Rule

from support import rows

RULES = [Rule("known", "s IN ('a', 'b')"), Rule("positive", "v >= 0"),
         Rule("tagged", "t IS NOT NULL", action="warn")]


@pytest.fixture
def data(spark):
    return spark.createDataFrame(
        [(1, "a", 1.0, "x"), (2, "c", 1.0, "x"), (3, "a", -1.0, None), (4, None, None, None),
         (5, "b", 0.0, None)], "id INT, s STRING, v DOUBLE, t STRING")


def test_null_is_a_violation_and_the_split_is_exact(data):
    kept, bad = quality.enforce(data, RULES), quality.rejected(data, RULES)
    assert [r[0] for r in rows(kept)] == [1, 5]
    assert {r.id: r.failed_rules for r in bad.collect()} == {
        2: ["known"], 3: ["positive"], 4: ["known", "positive"]}


def test_warnings_only_count(data):
    got = {r.rule: (r.action, r.checked, r.failed)
           for r in quality.rule_counts(data, RULES).collect()}
    assert got == {"known": ("drop", 5, 2), "positive": ("drop", 5, 2), "tagged": ("warn", 5, 3)}


def test_rule_counts_of_no_rows(data):
    assert {r.failed for r in quality.rule_counts(data.limit(0), RULES).collect()} == {0}


def test_counts_come_with_the_write(data):
    kept, watch = quality.observed(data, RULES, "layer")
    assert kept.count() == 2
    assert watch.get == {"rows": 5, "known": 2, "positive": 2, "tagged": 3}


def test_dead_letters(data):
    bad = quality.dead_letters(data, RULES, "dlq", "Invalid schema")
    assert {(r.id, r.failure_reason, r.dlq_topic, r.retry_count) for r in bad.collect()} == {
        (i, "Invalid schema", "dlq", 0) for i in (2, 3, 4)}


def test_unknown_action_is_refused():
    with pytest.raises(ValueError, match="unknown action"):
        Rule("r", "true", action="fail")


@pytest.mark.parametrize("parts", [1, 7])
def test_winner_does_not_depend_on_partitions(spark, parts):
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("k"),
        F.xxhash64("id").alias("v"), F.col("id").cast("string").alias("w"),
    ).repartition(parts)
    got = {r.k: (r.v, r.w) for r in dedup.first_per_key(df, ["k"]).collect()}
    want = {}
    for k, v, w in df.collect():
        want[k] = min(want.get(k, (v, w)), (v, w))
    assert got == want


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup.first_per_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_latest_per_key_settles_ties(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01", 2), ("a", "2024-01-02", 9), ("a", "2024-01-02", 3),
         ("b", "2024-01-01", 1)], "k STRING, at STRING, v INT")
    assert rows(dedup.latest_per_key(df, ["k"], "at")) == [
        ("a", "2024-01-02", 3), ("b", "2024-01-01", 1)]
    assert rows(dedup.latest_per_key(df, ["k"], "at", [F.desc("v")]))[0] == ("a", "2024-01-02", 9)


def test_maps_do_not_take_part_in_the_order(spark):
    df = spark.sql("SELECT 1 AS k, map('a', 'b') AS m, x FROM VALUES (2), (1) AS t(x)")
    assert dedup.first_per_key(df, ["k"]).first().x == 1


def test_conform_orders_casts_and_fills(spark):
    want = StructType.fromDDL("b BIGINT, missing STRING, a STRING")
    got = conform.conform(spark.createDataFrame([(1, 2, 3)], "a INT, b INT, extra INT"), want)
    assert got.schema.simpleString() == want.simpleString()
    assert rows(got) == [(2, None, "1")]


def test_bad_text_becomes_null(spark):
    df = spark.createDataFrame([("1.5", "2024-02-30"), ("x", "2024-02-28")], "n STRING, d STRING")
    got = conform.typed(df, n="double", d="date").collect()
    assert [r.n for r in got] == [1.5, None]
    assert [r.d is None for r in got] == [True, False]


def test_schema_report(spark):
    df = spark.createDataFrame([(1, "x", None), (None, "y", None)], "a INT, b STRING, c INT")
    want = StructType.fromDDL("a INT, b INT, d STRING")
    got = {r.column: (r.state, r.null_rows)
           for r in conform.schema_report(df, want, required=["a"]).collect()}
    assert got == {"a": ("null", 1), "b": ("type", 0), "d": ("missing", 2), "c": ("extra", 2)}


def test_required_columns(spark):
    df = spark.range(1)
    assert conform.require_columns(df, ["id"]) is df
    with pytest.raises(ValueError, match="missing: x, y"):
        conform.require_columns(df, ["id", "x", "y"])
