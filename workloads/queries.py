"""The registered queries: each applies the library to projections of the given tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import schemas
from strata.functions import json_text, labels
from strata.functions.masking import register_sql_functions, secured_view, stored_functions
from strata.operators import conform, quality
from strata.operators.quality import Rule
from strata.plans import (dashboards, education, emails, messages, monitoring, orders,
                          refresh_log, small_tables, stocks, values)
from strata.plans.recorded import Recorded
from strata.session import PARTITION_BYTES, configure, scratch_path
from strata.sinks import snapshot, tables as sinks
from strata.sinks.lake import Lake
from strata.sources import files, kafka, synthetic
from strata.streaming import messages as streams
from strata.streaming import progress, runner
from workloads import mapping
from workloads.tables import EXPANDED, Tables

# The moment the monitoring queries look back from: just after the last event.
AS_OF = "2024-01-31 00:00:00"
HISTORY = "30 DAYS"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Tables(configure(spark), sf_dir))

    QUERIES[build.__name__] = run
    return build


def _flat_maps(df: DataFrame) -> DataFrame:
    """Map columns as plain text columns, one per key used."""
    return df.withColumns({"data_k": F.element_at("data", "k"),
                           "metadata_source": F.element_at("metadata", "source")}
                          ).drop("data", "metadata")


def _settled(df: DataFrame, *more: str) -> DataFrame:
    """Without the columns that hold the time of the run."""
    return df.drop("_ingested_at", "_processed_at", "_aggregated_at", "failed_at",
                   "ingest_time", "load_time", "first_seen", *more)


# --- messages ------------------------------------------------------------------------------

@query
def messages_parse(t: Tables) -> DataFrame:
    bronze = messages.ingest(mapping.raw_messages(t.events))
    return _flat_maps(bronze.drop("kafka_value", "ingestion_timestamp"))


@query
def messages_malformed(t: Tables) -> DataFrame:
    raw = mapping.raw_messages(t.events, break_some=True)
    return _settled(messages.malformed(raw, "dead-letters"))


@query
def messages_quarantine(t: Tables) -> DataFrame:
    rules = messages.BRONZE_RULES + messages.SILVER_RULES
    bad = quality.rejected(mapping.bronze_messages(t.events), rules)
    return bad.select("kafka_offset", "client_id",
                      F.concat_ws("|", "failed_rules").alias("failed_rules"))


@query
def messages_dead_letter(t: Tables) -> DataFrame:
    bad = quality.dead_letters(mapping.bronze_messages(t.events), messages.BRONZE_RULES,
                               "dead-letters", "Invalid schema")
    return bad.select("kafka_offset", "client_id", "failure_reason", "dlq_topic", "retry_count")


@query
def rule_counts(t: Tables) -> DataFrame:
    return quality.rule_counts(mapping.bronze_messages(t.events),
                               messages.BRONZE_RULES + messages.SILVER_RULES)


@query
def client_bronze(t: Tables) -> DataFrame:
    rows = messages.accepted(messages.ingest(mapping.raw_messages(t.events)))
    return rows.select("client_id", "kafka_offset", "event_timestamp", "event_type", "amount",
                       "status")


@query
def client_silver(t: Tables) -> DataFrame:
    bronze = quality.enforce(mapping.bronze_messages(t.events), messages.BRONZE_RULES)
    return _flat_maps(messages.silver(bronze).drop("silver_processed_timestamp"))


def _hourly(t: Tables) -> DataFrame:
    bronze = quality.enforce(mapping.bronze_messages(t.events), messages.BRONZE_RULES)
    return messages.hourly(messages.silver(bronze)).drop("gold_processed_timestamp")


def _rounded(hourly: DataFrame) -> DataFrame:
    """Sums of doubles depend in the last digits on the order of addition."""
    return hourly.withColumns({"total_amount": F.round("total_amount", 2),
                               "avg_amount": F.round("avg_amount", 6)})


@query
def client_gold_hourly(t: Tables) -> DataFrame:
    return _rounded(_hourly(t))


@query
def client_registry(t: Tables) -> DataFrame:
    return _settled(messages.clients(mapping.bronze_messages(t.events)))


@query
def one_client(t: Tables) -> DataFrame:
    """Validated bronze laid out by client; reading one client opens one folder."""
    rows = messages.accepted(mapping.bronze_messages(t.events)).select(
        "client_id", "kafka_offset", "event_timestamp", "amount", "status")
    stored = sinks.overwrite_partitioned(rows, scratch_path(t.spark, "clients"), "client_id")
    return messages.of_client(stored, "client_001")


@query
def json_paths(t: Tables) -> DataFrame:
    """Values at JSON paths of a text column, present and absent."""
    return t.events.select("event_id", json_text.path_text(F.col("props"), "$.k").alias("k"),
                           json_text.path_text(F.col("props"), "$.a[0].b").alias("absent"))


@query
def hourly_event_metrics(t: Tables) -> DataFrame:
    body = json_text.encode(F.struct(F.col("event_id").cast("string").alias("id"),
                                     F.col("props").alias("data"), F.col("ts").alias("timestamp")))
    raw = t.events.select(F.lit(None).cast("string").alias("kafka_key"), body.alias("kafka_value"))
    return messages.hourly_events(messages.events(raw))


# --- message streams -----------------------------------------------------------------------

def _raw_stream(t: Tables, **options) -> DataFrame:
    return mapping.raw_messages(t.stream("events"), **options)


@query
def client_bronze_stream(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "bronze")
    streams.bronze(_raw_stream(t), f"{root}/rows", f"{root}/log").awaitTermination()
    rows = t.spark.read.parquet(f"{root}/rows")
    return _flat_maps(rows.drop("kafka_value", "ingestion_timestamp"))


@query
def client_layers_stream(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "clients")
    bronze = messages.ingest(_raw_stream(t))
    streams.client_layers(bronze, f"{root}/rows", f"{root}/log").awaitTermination()
    return t.spark.read.parquet(f"{root}/rows").select(
        "client_id", "kafka_offset", "event_timestamp", "event_type", "amount", "status")


@query
def client_silver_stream(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "silver")
    bronze = messages.accepted(messages.ingest(_raw_stream(t)))
    streams.silver(bronze, f"{root}/rows", f"{root}/log").awaitTermination()
    rows = t.spark.read.parquet(f"{root}/rows")
    return _flat_maps(rows.drop("silver_processed_timestamp", "batch_id"))


MESSAGE_BYTES = 1024  # a message in a task's memory: its body and the fields parsed from it


def _backlog(t: Tables) -> tuple[str, int]:
    """The event messages as files of a topic in three folders, from new to old: the last three
    tenths of the offsets, then more, then everything, so that later deliveries repeat earlier
    ones and bring far older messages. Each folder has the same number of files, which grows with
    the messages, so that a file and what a task reads does not; the session's shuffles are sized
    for the messages too. Returns the path and the number of files in a folder."""
    path = scratch_path(t.spark, "topic")
    raw = mapping.raw_messages(t.events)
    latest, size = t.events.agg((F.max("event_id") * 0.7).cast("long"),
                                F.count(F.lit(1)) * MESSAGE_BYTES).first()
    configure(t.spark, size // EXPANDED, EXPANDED)
    files = max(4, math.ceil(size / PARTITION_BYTES))
    for n, part in enumerate((F.col("kafka_offset") > latest, F.col("kafka_offset") > latest // 2,
                              F.lit(True))):
        raw.where(part).repartition(files).write.parquet(f"{path}/delivery={n}")
    return path, files


def _backlog_stream(t: Tables, path: str, files: int) -> DataFrame:
    return t.spark.readStream.schema(schemas.RAW_MESSAGE).option(
        "maxFilesPerTrigger", files).parquet(f"{path}/*")


@query
def client_silver_backlog(t: Tables) -> DataFrame:
    """A backlog read in three batches, from new to old, with every late message delivered up
    to three times: each message is stored once, and none is lost."""
    root = scratch_path(t.spark, "silver")
    bronze = messages.accepted(messages.ingest(_backlog_stream(t, *_backlog(t))))
    streams.silver(bronze, f"{root}/rows", f"{root}/log").awaitTermination()
    rows = t.spark.read.parquet(f"{root}/rows")
    return _flat_maps(rows.drop("silver_processed_timestamp", "batch_id"))


@query
def client_gold_hourly_compacted(t: Tables) -> DataFrame:
    """Hourly metrics of the same backlog, gathered after its last batch."""
    root = scratch_path(t.spark, "hourly")
    path, files = _backlog(t)
    bronze = messages.accepted(messages.ingest(_backlog_stream(t, path, files)))
    streams.silver(bronze, f"{root}/silver", f"{root}/log1").awaitTermination()
    silver = t.spark.read.parquet(f"{root}/silver")
    rows = t.spark.readStream.schema(silver.schema).option(
        "maxFilesPerTrigger", 2 * files).parquet(f"{root}/silver")
    streams.hourly(rows, f"{root}/rows", f"{root}/log2").awaitTermination()
    streams.compact_hourly(t.spark, f"{root}/rows")
    return _rounded(streams.hourly_table(t.spark, f"{root}/rows"))


@query
def client_gold_hourly_stream(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "hourly")
    rows = messages.enriched(messages.accepted(messages.ingest(_raw_stream(t))))
    streams.hourly(rows, f"{root}/rows", f"{root}/log").awaitTermination()
    return _rounded(streams.hourly_table(t.spark, f"{root}/rows"))


@query
def client_gold_closed_stream(t: Tables) -> DataFrame:
    """Append mode: only hours that the watermark has closed are written."""
    root = scratch_path(t.spark, "closed")
    rows = messages.enriched(messages.accepted(messages.ingest(_raw_stream(t))))
    streams.hourly_closed(rows, f"{root}/rows", f"{root}/log").awaitTermination()
    closed = t.spark.read.parquet(f"{root}/rows").drop("gold_processed_timestamp")
    return _rounded(closed)


@query
def message_layers_stream(t: Tables) -> DataFrame:
    """All layers one after the other, each reading the one before from storage."""
    lake = Lake(t.spark, scratch_path(t.spark, "layers"))
    return _rounded(streams.run_available(lake, _raw_stream(t), "dead-letters"))


@query
def client_registry_stream(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "registry")
    bronze = messages.ingest(_raw_stream(t))
    streams.clients(bronze, f"{root}/rows", f"{root}/log").awaitTermination()
    return _settled(t.spark.read.parquet(f"{root}/rows"))


@query
def messages_malformed_stream(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "malformed")
    raw = _raw_stream(t, break_some=True)
    streams.quarantine(raw, f"{root}/rows", f"{root}/log", "dead-letters").awaitTermination()
    return _settled(t.spark.read.parquet(f"{root}/rows"))


@query
def stream_foreach_batch(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "batches")
    rows = mapping.bronze_messages(t.stream("events")).select(
        "client_id", "kafka_partition", "kafka_offset", "event_type", "status")
    write = runner.batch_folders(f"{root}/rows", kafka.encode)
    runner.each_batch(rows, write, f"{root}/log").awaitTermination()
    return t.spark.read.parquet(f"{root}/rows").select("key", "value")


@query
def stream_restart(t: Tables) -> DataFrame:
    """Started twice from one checkpoint: the second run must add nothing."""
    root = scratch_path(t.spark, "restart")
    for _ in range(2):
        rows = mapping.bronze_messages(t.stream("events")).select("client_id", "kafka_offset")
        runner.to_files(rows, f"{root}/rows", f"{root}/log").awaitTermination()
    return t.spark.read.parquet(f"{root}/rows")


@query
def stream_rule_counts(t: Tables) -> DataFrame:
    """Rule failures counted while a stream runs in four batches, added up over the batches."""
    root, rules = scratch_path(t.spark, "counts"), messages.BRONZE_RULES + messages.SILVER_RULES
    t.events.repartitionByRange(4, "event_id").write.parquet(f"{root}/events")
    events = t.spark.readStream.schema(t.schema("events")).option("maxFilesPerTrigger", 1).parquet(
        f"{root}/events")
    rows = progress.counted(mapping.bronze_messages(events), rules, "bronze")
    with progress.RuleCounts(t.spark, "bronze", f"{root}/rules") as counts:
        query = runner.to_files(rows.select("client_id", "kafka_offset"), f"{root}/rows",
                                f"{root}/log")
        query.awaitTermination()
        counts.wait(query)
    return progress.rule_counts(t.spark, f"{root}/rules", rules).groupBy("rule", "action").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("checked").alias("checked"),
        F.sum("failed").alias("failed"))


@query
def stream_restart_midway(t: Tables) -> DataFrame:
    """A batch fails once after it has written its folder and before it is committed; the query
    goes on from its checkpoint, and every message is there once."""
    root, lost = scratch_path(t.spark, "midway"), [True]
    t.events.repartitionByRange(4, "event_id").write.parquet(f"{root}/events")
    store = runner.batch_folders(f"{root}/rows")

    def write(batch: DataFrame, batch_id: int) -> None:
        store(batch, batch_id)
        if batch_id == 1 and lost.pop():
            lost.append(False)
            raise OSError("the driver was lost")

    def start():
        events = t.spark.readStream.schema(t.schema("events")).option(
            "maxFilesPerTrigger", 1).parquet(f"{root}/events")
        rows = mapping.bronze_messages(events).select("client_id", "kafka_offset")
        return runner.each_batch(rows, write, f"{root}/log")

    progress.restarted(start)
    return t.spark.read.parquet(f"{root}/rows").drop("batch_id")


@query
def stream_continuous(t: Tables) -> DataFrame:
    """A stream that would keep running, stopped when its backlog is worked off."""
    root = scratch_path(t.spark, "continuous")
    t.events.repartitionByRange(3, "event_id").write.parquet(f"{root}/events")

    def start():
        events = t.spark.readStream.schema(t.schema("events")).option(
            "maxFilesPerTrigger", 1).parquet(f"{root}/events")
        rows = mapping.bronze_messages(events).select("client_id", "kafka_offset")
        return runner.each_batch(rows, runner.batch_folders(f"{root}/rows"), f"{root}/log",
                                 continuous=True, interval="100 milliseconds")

    progress.until_idle(t.spark, start)
    return t.spark.read.parquet(f"{root}/rows").drop("batch_id")


@query
def stream_from_ticks(t: Tables) -> DataFrame:
    """The generator: ticks of the rate source, as many as there are offsets, look up the message
    of their number and send it."""
    root = scratch_path(t.spark, "ticks")
    stored = mapping.bronze_messages(t.events).select(
        "client_id", "kafka_partition", "kafka_offset", "event_type", "status")
    offsets = stored.agg(F.max("kafka_offset")).first()[0] or 0

    def encode(batch: DataFrame) -> DataFrame:
        found = stored.join(batch, F.col("value") == F.col("kafka_offset"), "left_semi")
        return kafka.encode(found)

    runner.each_batch(files.counted_ticks(t.spark, offsets + 1),
                      runner.batch_folders(f"{root}/rows", encode), f"{root}/log").awaitTermination()
    return t.spark.read.parquet(f"{root}/rows").select("key", "value")


# --- monitoring ----------------------------------------------------------------------------

@query
def errors_recent(t: Tables) -> DataFrame:
    return monitoring.error_summary(mapping.errors(t.events), AS_OF, "7 DAYS")


def _listed(groups: DataFrame) -> DataFrame:
    return groups.withColumn("recent_messages", F.concat_ws(" | ", "recent_messages"))


@query
def errors_newest(t: Tables) -> DataFrame:
    return _listed(monitoring.error_summary(mapping.errors(t.events), AS_OF, "7 DAYS", newest=5))


@query
def health_newest(t: Tables) -> DataFrame:
    return _listed(monitoring.client_health(mapping.errors(t.events), AS_OF, "7 DAYS", newest=5))


@query
def errors_recent_messages(t: Tables) -> DataFrame:
    return monitoring.error_messages(mapping.errors(t.events), AS_OF, "7 DAYS")


@query
def errors_daily(t: Tables) -> DataFrame:
    return monitoring.error_summary(mapping.errors(t.events), AS_OF, "1 DAY")


@query
def volume_by_client(t: Tables) -> DataFrame:
    return monitoring.volume(mapping.bronze_messages(t.events), AS_OF, HISTORY)


@query
def rows_by_client(t: Tables) -> DataFrame:
    return monitoring.rows_by_client(mapping.bronze_messages(t.events))


@query
def layer_drop_rate(t: Tables) -> DataFrame:
    """Silver is stored as the layer it is, so that counting it and building gold from it do
    not each remove the duplicates again."""
    bronze = mapping.bronze_messages(t.events)
    kept = messages.silver(quality.enforce(bronze, messages.BRONZE_RULES))
    stored = sinks.overwrite_path(kept, scratch_path(t.spark, "silver"))
    return monitoring.layer_drop_rate(bronze, stored, messages.hourly(stored))


@query
def event_type_distribution(t: Tables) -> DataFrame:
    return monitoring.event_distribution(mapping.bronze_messages(t.events), AS_OF, HISTORY)


@query
def gold_latest20(t: Tables) -> DataFrame:
    return monitoring.latest_windows(_hourly(t))


@query
def messages_latest20(t: Tables) -> DataFrame:
    return monitoring.latest_messages(mapping.bronze_messages(t.events))


@query
def offset_progress(t: Tables) -> DataFrame:
    return monitoring.offset_progress(mapping.bronze_messages(t.events))


@query
def status_share(t: Tables) -> DataFrame:
    return monitoring.status_share(mapping.bronze_messages(t.events), AS_OF, HISTORY)


@query
def error_trend(t: Tables) -> DataFrame:
    return monitoring.error_trend(mapping.errors(t.events), AS_OF)


@query
def failed_alert(t: Tables) -> DataFrame:
    return monitoring.failing_clients(mapping.bronze_messages(t.events), AS_OF, HISTORY)


@query
def pipeline_health(t: Tables) -> DataFrame:
    return monitoring.client_health(mapping.errors(t.events), AS_OF, "7 DAYS")


@query
def events_of_one(t: Tables) -> DataFrame:
    """The whole table is laid out in buckets of pipelines; reading one pipeline opens one."""
    path = scratch_path(t.spark, "pipeline-events")
    stored = sinks.overwrite_bucketed(mapping.pipeline_events(t.events), path, "pipeline_id")
    rows = monitoring.events_of_pipeline(sinks.bucket_of(stored, "pipeline_id", 7), 7)
    return rows.select("pipeline_id", "pipeline_name", "id", "event_timestamp", "event_message",
                       F.element_at("planning_details", "props").alias("props"))


# --- audit and refresh log -------------------------------------------------------------------

@query
def dashboard_latest(t: Tables) -> DataFrame:
    states = dashboards.publish_states(mapping.audit(t.events), "https://host.example",
                                       as_of="2024-07-14 00:00:00")
    return dashboards.named(states, mapping.dashboard_names(t))


@query
def refresh_technique(t: Tables) -> DataFrame:
    return refresh_log.refreshes(mapping.refresh_log(t.events))


@query
def refresh_raw_log(t: Tables) -> DataFrame:
    log = conform.conform(mapping.refresh_log(t.events), schemas.EVENT_LOG)
    return refresh_log.raw_copy(log).select("timestamp", "message", "event_type",
                                            F.col("origin.update_id").alias("update_id"), "error")


@query
def refresh_log_files(t: Tables) -> DataFrame:
    """The log written as JSON documents, read back and analysed."""
    path = scratch_path(t.spark, "event-log")
    mapping.refresh_log(t.events).write.options(**json_text.TIMES).json(path)
    return refresh_log.refreshes(refresh_log.read_log(t.spark, path))


@query
def refresh_flows(t: Tables) -> DataFrame:
    return refresh_log.flows(mapping.refresh_log(t.events))


@query
def refresh_with_flows(t: Tables) -> DataFrame:
    return refresh_log.with_flows(mapping.refresh_log(t.events))


@query
def refresh_layers(t: Tables) -> DataFrame:
    """The stored combined log, joined by update and pipeline."""
    lake = Lake(t.spark, scratch_path(t.spark, "refresh"))
    log = conform.conform(mapping.refresh_log(t.events), schemas.EVENT_LOG)
    return refresh_log.run(lake, log, ("update_id", "pipeline_id"))


@query
def refresh_by_update(t: Tables) -> DataFrame:
    return refresh_log.by_update(mapping.refresh_log(t.events))


@query
def refresh_by_org(t: Tables) -> DataFrame:
    return refresh_log.by_organisation(mapping.refresh_log(t.events))


# --- e-mails ---------------------------------------------------------------------------------

ATTACHMENT_COLUMNS = [
    "attachment_unique_id", "email_unique_id", "drive_item_unique_id", "attachment_type",
    "reference_type", "share_type", "size", "size_display", "last_modified_date_time",
    "rls_org_key", "sit_id", "sit_name", "hit_id", "hit_rank", "sit_summary",
    "classification_type"]
EMAIL_COLUMNS = [
    "unique_email_id", "rls_org_key", "user_email", "created_date_time", "created_date",
    "subject", "importance", "email_category", "email_category_label", "recipient_count",
    "to_count", "cc_count", "bcc_count", "reply_to_count", "external_recipient_count",
    "has_external_recipient", "has_consumer_recipient", "attachment_count", "attachment_size",
    "attachment_size_display"]


@query
def attachment_hits(t: Tables) -> DataFrame:
    return emails.attachment_hits(mapping.attachments(t), mapping.hits(t)).select(
        *ATTACHMENT_COLUMNS)


@query
def email_summary(t: Tables) -> DataFrame:
    found = emails.attachment_hits(mapping.attachments(t), mapping.hits(t))
    return emails.email_summary(mapping.recipients(t), found).select(*EMAIL_COLUMNS)


@query
def email_layers(t: Tables) -> DataFrame:
    """The stored views of one organisation."""
    lake = Lake(t.spark, scratch_path(t.spark, "emails"))
    return emails.run(lake, mapping.recipients(t), mapping.attachments(t), mapping.hits(t),
                      org="org_b").select(*EMAIL_COLUMNS)


# --- education -------------------------------------------------------------------------------

def _assessments(t: Tables) -> DataFrame:
    return education.silver("assessments", mapping.assessments(t))


@query
def edu_silver(t: Tables) -> DataFrame:
    return _settled(_assessments(t))


@query
def edu_assessment_summary(t: Tables) -> DataFrame:
    return education.assessment_summary(mapping.schools(t), mapping.classrooms(t),
                                        mapping.students(t), _assessments(t))


@query
def edu_educator_metrics(t: Tables) -> DataFrame:
    return education.educator_metrics(mapping.schools(t), mapping.educators(t),
                                      mapping.classrooms(t), mapping.students(t),
                                      _assessments(t))


@query
def edu_school_overview(t: Tables) -> DataFrame:
    return education.school_overview(mapping.schools(t), mapping.educators(t),
                                     mapping.classrooms(t), mapping.students(t),
                                     _assessments(t))


@query
def edu_from_csv(t: Tables) -> DataFrame:
    """The whole job: entities as CSV files, bronze, silver, school overview."""
    root = scratch_path(t.spark, "education")
    sources = {"schools": mapping.schools, "educators": mapping.educators,
               "classrooms": mapping.classrooms, "students": mapping.students,
               "assessments": mapping.assessments}
    for name, build in sources.items():
        rows = conform.conform(build(t), education.ENTITIES[name].schema)
        rows.write.option("header", True).csv(f"{root}/{name}.csv")
    synthetic.learning_objectives(_ids(t.nation, "n_nationkey")).write.option(
        "header", True).csv(f"{root}/learning_objectives.csv")
    return education.run(Lake(t.spark, f"{root}/lake"), root)["school_performance_overview"]


@query
def season(t: Tables) -> DataFrame:
    return t.orders.groupBy(labels.season(F.col("o_orderdate")).alias("season")).agg(
        F.count(F.lit(1)).alias("n"))


@query
def csv_ingest(t: Tables) -> DataFrame:
    """Customers written as CSV with a header and read back with declared types."""
    path = scratch_path(t.spark, "csv")
    t.customer.write.option("header", True).csv(path)
    rows = files.read_csv(t.spark, path, t.schema("customer"))
    return rows.select("*", F.col("_source_file").isNotNull().alias("has_source")).drop(
        "_source_file", "_ingested_at")


@query
def snapshot_sync(t: Tables) -> DataFrame:
    gold = edu_assessment_summary(t)
    keys = snapshot.SERVED_KEYS["assessment_summary_by_classroom"]
    target = scratch_path(t.spark, "served")
    for _ in range(2):
        snapshot.sync_snapshot(t.spark, gold, target, keys)
    return snapshot.serving(t.spark, target)


# --- orders and runs ---------------------------------------------------------------------------

@query
def orders_silver(t: Tables) -> DataFrame:
    return _settled(orders.silver(mapping.orders(t)))


@query
def orders_revenue(t: Tables) -> DataFrame:
    return _settled(orders.revenue(orders.silver(mapping.orders(t))))


@query
def run_metrics(t: Tables) -> DataFrame:
    """The job run over the order table: rows per layer as counted while writing."""
    lake = Lake(t.spark, scratch_path(t.spark, "orders"))
    metrics = orders.run(lake, mapping.orders(t), "run1", "job1")
    return metrics.select("run_id", "job_id", "bronze_rows", "silver_rows", "gold_rows", "status")


@query
def run_compare(t: Tables) -> DataFrame:
    return orders.compare_runs(mapping.yearly_runs(t))


@query
def run_last_two(t: Tables) -> DataFrame:
    return orders.last_two(mapping.yearly_runs(t))


@query
def run_recorded(t: Tables) -> DataFrame:
    """A job whose second layer breaks on the first order it looks at: its error row, the run's
    row, and the layers that were built all the same."""
    spark, lake = t.spark, Lake(t.spark, scratch_path(t.spark, "recorded"))
    run = Recorded(lake, "run1", "job1")
    bronze = mapping.orders(t)
    raw = run.layer("bronze", "orders", bronze.schema, lambda: bronze)
    clean = run.layer("silver", "orders_clean", raw.schema, lambda: raw.where(
        F.assert_true(F.col("order_id").isNull(), "broken layer").isNull()))
    gold = orders.revenue(orders.silver(clean))
    run.layer("gold", "revenue_summary", gold.schema, lambda: gold)
    runs = run.finish().select(
        F.col("run_id").alias("name"), F.col("status").alias("detail"),
        F.concat_ws(",", "orders_rows", "orders_clean_rows", "revenue_summary_rows").alias("rows"))
    errors = run.errors().select(
        F.col("table_name").alias("name"),
        F.when(F.col("error_message").contains("broken layer"), "broken layer").alias("detail"),
        F.lit(None).cast("string").alias("rows"))
    return runs.unionByName(errors)


@query
def evolving_append(t: Tables) -> DataFrame:
    """The order table appended twice, the second time with one more column."""
    path = scratch_path(t.spark, "evolving")
    rows = t.orders.select("o_orderkey", "o_totalprice")
    sinks.append_evolving(rows, path)
    return sinks.append_evolving(rows.withColumn("batch", F.lit("second")), path)


# --- values, stocks, names, masking, trips -------------------------------------------------------

def _values(t: Tables) -> DataFrame:
    ids = t.part.select(F.col("p_partkey").alias("id"))
    rows = values.bronze(ids, "dev", mapping.part_value(), kafka_host="broker.example")
    return values.silver(rows, checkpoint_path="/checkpoints/dev")


@query
def value_silver(t: Tables) -> DataFrame:
    return _values(t).drop("timestamp", "processed_timestamp")


@query
def value_stats(t: Tables) -> DataFrame:
    stats = values.stats(_values(t), "kafka_host", environment="dev")
    return stats.drop("aggregation_timestamp").withColumns(
        {c: F.round(c, 6) for c in ("avg_value", "stddev_value")})


def _stock_payloads(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "payloads")
    mapping.stock_payloads(t).write.json(path)
    return stocks.read_payloads(t.spark, path, one_per_line=True)


@query
def stock_silver(t: Tables) -> DataFrame:
    return stocks.silver(stocks.bronze(_stock_payloads(t)))


@query
def stock_gold(t: Tables) -> DataFrame:
    return stocks.run(Lake(t.spark, scratch_path(t.spark, "stocks")), _stock_payloads(t))


@query
def masked_restricted(t: Tables) -> DataFrame:
    return small_tables.masked_emails(mapping.turn_emails(t), ["no_content_group"])


@query
def masked_by_sql(t: Tables) -> DataFrame:
    """The same policy through SQL functions, for a reader of the restricted group."""
    register_sql_functions(t.spark, restricted=True)
    mapping.turn_emails(t).createOrReplaceTempView("emails_to_mask")
    return t.spark.sql("""SELECT email_id, customer_id, subject,
        mask_content(content) AS content, sentiment, received_date, requested_amount, processed
        FROM emails_to_mask WHERE unprocessed_filter(processed)""")


@query
def masked_view(t: Tables) -> DataFrame:
    """The policy bound to a stored table: its readers ask a view of the catalogue by name."""
    path = scratch_path(t.spark, "emails")
    name = f"emails_{path.rsplit('-', 1)[1]}"
    stored = sinks.overwrite_path(mapping.turn_emails(t), path)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored.schema.fields)
    sinks.create_table(t.spark, name, columns, location=path)
    mask, visible = stored_functions(t.spark, "strata", restricted=True)
    secured_view(t.spark, name, f"{name}_masked", {"content": mask}, (visible, "processed"),
                 stored.columns)
    return files.read_table(t.spark, f"{name}_masked")


DDL = """
-- one environment's copy of the names; the schema may exist
CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:schema);
CREATE TABLE IF NOT EXISTS IDENTIFIER(concat(:schema, '.', :env, '_names_', :run))
    (id BIGINT COMMENT 'customer; key', name STRING) USING parquet;
COMMENT ON TABLE IDENTIFIER(concat(:schema, '.', :env, '_names_', :run)) IS 'names; by customer';
INSERT INTO IDENTIFIER(concat(:schema, '.', :env, '_names_', :run)) SELECT id, name
    FROM IDENTIFIER(:source);
DESCRIBE TABLE EXTENDED IDENTIFIER(concat(:schema, '.', :env, '_names_', :run));
"""


@query
def ddl_script(t: Tables) -> DataFrame:
    """A parameterised script makes, comments, fills and describes a table, which is then read."""
    run = scratch_path(t.spark, "ddl").rsplit("-", 1)[1]
    sinks.as_view(mapping.names(t), f"names_{run}")
    described = sinks.run_script(t.spark, DDL, schema="strata_ddl", env="dev", run=run,
                                 source=f"names_{run}")
    said = {r["col_name"]: r for r in described.collect()}
    rows = files.read_table(t.spark, f"strata_ddl.{sinks.prefixed('dev', 'names_' + run)}")
    return rows.groupBy("name").agg(F.count("id").alias("n")).withColumns({
        "id_comment": F.lit(said["id"]["comment"]), "id_type": F.lit(said["id"]["data_type"]),
        "table_comment": F.lit(said["Comment"]["data_type"])})


@query
def masked_open(t: Tables) -> DataFrame:
    return small_tables.masked_emails(mapping.turn_emails(t), ["analysts"])


@query
def masked_grouped(t: Tables) -> DataFrame:
    return small_tables.masked_emails(small_tables.grouped_emails(mapping.turn_emails(t)),
                                      ["no_content_group"])


@query
def name_counts(t: Tables) -> DataFrame:
    return small_tables.name_counts(mapping.names(t))


def _through_table(t: Tables, df: DataFrame, label: str) -> DataFrame:
    """df inserted into a catalogue table of its own and read from there. The table's entry
    goes again; its files stay in the scratch folder."""
    path = scratch_path(t.spark, label)
    name = sinks.prefixed("dev", path.rsplit("/", 1)[1].replace("-", "_"))
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    sinks.create_table(t.spark, name, columns, location=path)
    sinks.insert_into(df, name)
    stored = files.read_table(t.spark, name)
    t.spark.sql("DROP TABLE IDENTIFIER(:name)", args={"name": name})
    return stored


@query
def name_table(t: Tables) -> DataFrame:
    return _through_table(t, mapping.names(t), "names")


@query
def error_table(t: Tables) -> DataFrame:
    rows = conform.conform(mapping.errors(t.events), schemas.PIPELINE_ERROR)
    return _through_table(t, rows, "errors")


@query
def name_counts_filtered(t: Tables) -> DataFrame:
    rules = [Rule("valid_customer_name", "name <> 'BUILDING'")]
    return small_tables.filtered_names(small_tables.name_counts(mapping.names(t)), rules)


@query
def name_counts_all(t: Tables) -> DataFrame:
    return _settled(small_tables.name_counts_at_load(mapping.names(t)))


@query
def fare_filter(t: Tables) -> DataFrame:
    return small_tables.cheap_trips(mapping.trips(t))


@query
def schema_conform(t: Tables) -> DataFrame:
    wanted = StructType.fromDDL(
        "event_id BIGINT, ts TIMESTAMP, user_id STRING, value DOUBLE, event_timestamp TIMESTAMP, "
        "schema_version STRING")
    rows = t.events.withColumn("event_timestamp",
                               F.when(F.col("event_id") % 41 != 0, F.col("ts")))
    return conform.schema_report(rows, wanted, required=["event_id", "event_timestamp"])


# --- invented data, one row per row of a given table -----------------------------------------------

def _ids(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).cast("bigint").alias("id"))


@query
def synth_education(t: Tables) -> DataFrame:
    """Sizes as in the given tables; per relation the rows and those without a parent or
    that disagree with it."""
    day = "2024-01-31"
    n = {name: getattr(t, name).count() for name in ("nation", "supplier", "customer", "orders")}
    schools = synthetic.schools(_ids(t.nation, "n_nationkey"))
    educators = synthetic.educators(_ids(t.supplier, "s_suppkey"), n["nation"], day)
    rooms = synthetic.classrooms(_ids(t.customer, "c_custkey"), n["nation"], n["supplier"])
    pupils = synthetic.students(_ids(t.orders, "o_orderkey"), n["nation"], n["customer"], day)
    goals = synthetic.learning_objectives(_ids(t.nation, "n_nationkey"))
    tests = synthetic.assessments(
        t.lineitem.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id")),
        n["orders"], n["supplier"], n["nation"], day)

    def check(name: str, child: DataFrame, key: str, parent: DataFrame, agrees: str) -> DataFrame:
        p = parent.alias("p")
        joined = child.alias("c").join(p, F.col(f"c.{key}") == F.col(f"p.{key}"), "left")
        return joined.agg(
            F.lit(name).alias("relation"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(f"p.{key}").isNull()).alias("orphans"),
            F.count_if(~F.expr(agrees)).alias("mismatches"))

    parts = [
        check("educator-school", educators, "school_id", schools, "true"),
        check("classroom-school", rooms, "school_id", schools, "true"),
        check("classroom-educator", rooms.drop("school_id"), "educator_id", educators,
              "p.role = 'lead_teacher'"),
        check("student-classroom", pupils, "classroom_id", rooms,
              "c.school_id = p.school_id AND c.grade_level = p.grade_level"),
        check("assessment-student", tests, "student_id", pupils,
              "c.score BETWEEN 1 AND 9"),
        check("assessment-objective", tests.withColumnRenamed("learning_objective_id",
                                                              "objective_id"),
              "objective_id", goals, "c.subject = p.subject AND c.domain = p.domain"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def synth_orders(t: Tables) -> DataFrame:
    rows = synthetic.orders(_ids(t.orders, "o_orderkey"), "2024-01-31 00:00:00")
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("order_amount").between(5, 500)).alias("bad_amounts"),
        F.count_if(~F.col("order_ts").between(F.lit("2023-11-02").cast("timestamp"),
                                              F.lit("2024-01-31").cast("timestamp")))
        .alias("bad_times"),
        F.count_distinct("category").alias("categories"),
        F.count_distinct("status").alias("statuses"),
    )


@query
def synth_messages(t: Tables) -> DataFrame:
    """Generated messages, encoded and parsed again: all must pass every rule."""
    made = synthetic.messages(_ids(t.events, "event_id"), "2024-01-31 00:00:00")
    sent = kafka.encode(made).select(
        F.col("key").alias("kafka_key"), F.col("value").alias("kafka_value"),
        F.lit(mapping.TOPIC).alias("kafka_topic"), F.lit(0).alias("kafka_partition"),
        F.lit(0).cast("bigint").alias("kafka_offset"),
        F.lit(AS_OF).cast("timestamp").alias("kafka_timestamp"))
    rules = messages.BRONZE_RULES + messages.SILVER_RULES
    return quality.rule_counts(messages.ingest(sent), rules)


@query
def synth_names(t: Tables) -> DataFrame:
    rows = synthetic.names(_ids(t.customer, "c_custkey"))
    return rows.agg(F.count(F.lit(1)).alias("rows"),
                    F.count_if(~F.col("id").between(0, 99999)).alias("bad_ids"),
                    F.count_distinct("name").alias("names"))
