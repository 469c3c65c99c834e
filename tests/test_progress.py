"""Reports of running streams, restarts, recorded failures, newest messages, stored policies and
DDL scripts."""

from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from strata import schemas
from strata.functions.masking import secured_view, stored_functions
from strata.operators.quality import Rule
from strata.plans import monitoring
from strata.plans.recorded import Recorded
from strata.sinks import tables
from strata.sinks.lake import Lake
from strata.sources import files
from strata.streaming import progress, runner

from support import rows

RULES = [Rule("small", "id < 25"), Rule("even", "id % 2 = 0", "warn")]


@pytest.fixture
def numbers(spark, path):
    """A stream of 0..39 in four batches of ten."""
    spark.range(40).repartitionByRange(4, "id").write.parquet(path("numbers"))
    return lambda: spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(
        path("numbers"))


def test_rules_are_counted_per_batch(spark, path, numbers):
    kept = progress.counted(numbers(), RULES, "numbers")
    with progress.RuleCounts(spark, "numbers", path("counts")) as counts:
        query = runner.to_files(kept, path("out"), path("log"))
        query.awaitTermination()
        counts.wait(query)
    found = progress.rule_counts(spark, path("counts"), RULES)
    by_rule = {r.rule: (r.n, r.checked, r.failed) for r in found.groupBy("rule").agg(
        F.count("*").alias("n"), F.sum("checked").alias("checked"),
        F.sum("failed").alias("failed")).collect()}
    assert by_rule == {"small": (4, 40, 15), "even": (4, 40, 20)}
    assert spark.read.parquet(path("out")).count() == 25  # the warning drops nothing
    assert {r.action for r in found.where("rule = 'even'").collect()} == {"warn"}


def test_a_repeated_batch_counts_once(spark, path, numbers):
    """The query fails after a batch has been reported; the batch is run and reported again."""
    lost = [True]

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path('out')}/batch_id={batch_id}")
        if batch_id == 2 and lost:
            lost.pop()
            raise OSError("lost")

    def start():
        return runner.each_batch(progress.counted(numbers(), RULES, "again"), write, path("log"))

    with progress.RuleCounts(spark, "again", path("counts")) as counts:
        query = progress.restarted(start)
        counts.wait(query)
    found = progress.rule_counts(spark, path("counts"), RULES).where("rule = 'small'")
    assert found.count() == 4 and found.agg(F.sum("checked"), F.sum("failed")).first() == (40, 15)
    assert rows(spark.read.parquet(path("out")).select("id"), "id") == [(n,) for n in range(25)]


def test_no_counts_before_the_first_batch(spark, path):
    assert progress.rule_counts(spark, path("none"), RULES).collect() == []


def test_a_query_that_keeps_failing_is_given_up(spark, path, numbers):
    tried = []

    def write(batch, batch_id):
        tried.append(batch_id)
        raise OSError("lost")

    with pytest.raises(StreamingQueryException):
        progress.restarted(lambda: runner.each_batch(numbers(), write, path("log")), tries=2)
    assert tried == [0, 0]
    with pytest.raises(ValueError):
        progress.restarted(lambda: None, tries=0)


def test_a_running_query_stops_when_it_has_nothing_to_do(spark, path, numbers):
    def start():
        return runner.each_batch(numbers(), runner.batch_folders(path("out")), path("log"),
                                 continuous=True, interval="100 milliseconds")

    before = spark.conf.get(progress.IDLE, None)
    query = progress.until_idle(spark, start)
    assert not query.isActive and spark.conf.get(progress.IDLE, None) == before
    stored = spark.read.parquet(path("out"))
    assert stored.count() == 40 and stored.select("batch_id").distinct().count() == 4


def test_a_running_query_that_fails_is_not_taken_for_idle(spark, path, numbers):
    def write(batch, batch_id):
        raise OSError("lost")

    with pytest.raises(StreamingQueryException):
        progress.until_idle(spark, lambda: runner.each_batch(
            numbers(), write, path("log"), continuous=True, interval="100 milliseconds"))


def test_ticks_are_the_same_in_every_run(spark, path):
    for n in (1, 2):
        runner.each_batch(files.counted_ticks(spark, 7), runner.batch_folders(path("out")),
                          path("log")).awaitTermination()
        found = spark.read.parquet(path("out"))
        assert sorted(r.value for r in found.collect()) == list(range(7 * n))


def test_newest_messages_of_a_hot_client(spark):
    at = "timestamp '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id)"
    hot = spark.range(5000).selectExpr("'hot' client_id", "'t' table_name",
                                       "concat('m', id) error_message", f"{at} error_timestamp")
    few = spark.createDataFrame(
        [(None, "t", "b", datetime(2024, 1, 1)), (None, "t", "a", datetime(2024, 1, 1)),
         (None, "t", "a", datetime(2024, 1, 1)), ("one", None, None, datetime(2024, 1, 1))],
        "client_id string, table_name string, error_message string, error_timestamp timestamp")
    errors = hot.unionByName(few).repartition(6)
    found = monitoring.error_summary(errors, "2024-01-01 01:00:00", "2 HOURS", newest=3)
    assert {(r.client_id, r.table_name): (r.error_count, r.recent_messages)
            for r in found.collect()} == {
        ("hot", "t"): (5000, ["m4999", "m4998", "m4997"]), (None, "t"): (3, ["a", "a", "b"]),
        ("one", None): (1, [None])}
    health = monitoring.client_health(errors, "2024-01-01 01:00:00", "2 HOURS", newest=1)
    assert {r.client_id: (r.error_count_last_hour, r.recent_messages) for r in health.collect()} == {
        "hot": (5000, ["m4999"]), None: (3, ["a"]), "one": (1, [None])}
    # Map tasks send three rows of the hot client at most, not its five thousand.
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()
    assert monitoring.client_health(errors.limit(0), newest=2).collect() == []


def test_a_broken_layer_is_recorded(spark, path):
    lake = Lake(spark, path("lake"))
    good = spark.range(3)

    def broken():
        raise KeyError("no such column")

    run = Recorded(lake, "r1", "j")
    assert run.layer("bronze", "a", good.schema, lambda: good).count() == 3
    assert run.layer("silver", "b", good.schema, broken).dtypes == good.dtypes
    late = run.layer("silver", "c", good.schema,
                     lambda: good.where(F.raise_error(F.lit("in a task")).isNull()))
    assert late.count() == 0 and run.failed == ["b", "c"]
    assert tuple(run.finish().select("run_id", "status", "a_rows", "b_rows", "c_rows").first()) == (
        "r1", "failed", 3, 0, 0)
    found = {r.table_name: r.error_message for r in run.errors().collect()}
    assert set(found) == {"b", "c"} and "no such column" in found["b"] and "in a task" in found["c"]
    assert run.errors().schema == schemas.PIPELINE_ERROR

    again = Recorded(lake, "r2", "j")
    again.layer("bronze", "a", good.schema, lambda: good)
    assert rows(again.finish().select("run_id", "status")) == [("r1", "failed"), ("r2", "success")]
    assert again.errors().count() == 2  # none of its own
    assert Recorded(Lake(spark, path("other")), "r", "j").errors().count() == 0


def test_a_stored_policy_is_met_by_name(spark, path):
    data = [(1, "secret", "Y"), (2, "hidden", "N"), (3, None, None)]
    spark.createDataFrame(data, "id int, content string, processed string").write.mode(
        "overwrite").option("path", path("mail")).saveAsTable("policy_mail")
    seen = {}
    for restricted in (True, False):
        mask, visible = stored_functions(spark, "policy", restricted)
        view = f"policy_mail_{restricted}"
        secured_view(spark, "policy_mail", view, {"content": mask}, (visible, "processed"),
                     ["id", "content", "processed"])
        seen[restricted] = rows(spark.newSession().table(view))  # in another session, too
    assert seen == {True: [(1, "***", "Y")], False: sorted(data, key=repr)}
    plan = spark.table("policy_mail_True")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(processed,Y)" in plan  # pushed to the scan


def test_scripts(spark, path):
    text = """
    -- a comment; with a semicolon
    CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:schema);
    CREATE TABLE IF NOT EXISTS IDENTIFIER(concat(:schema, '.', :env, '_t')) (id INT, name STRING)
        USING parquet;
    INSERT INTO IDENTIFIER(concat(:schema, '.', :env, '_t')) VALUES (1, 'a;b'), (2, ':env');
    SELECT id, name, :env AS env FROM IDENTIFIER(concat(:schema, '.', :env, '_t'));
    """
    found = tables.run_script(spark, text, schema="script_schema", env="dev")
    assert rows(found) == [(1, "a;b", "dev"), (2, ":env", "dev")]
    assert spark.catalog.tableExists("script_schema.dev_t")
    with pytest.raises(ValueError, match="env"):
        tables.run_script(spark, "DROP TABLE script_schema.dev_t; SELECT :env")
    assert spark.catalog.tableExists("script_schema.dev_t")  # nothing has run
    assert tables.run_script(spark, " ; -- nothing\n;") is None
