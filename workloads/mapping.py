"""Projections of the given tables onto the shapes the jobs read. oracle.py states the same
projections in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import json_text, labels
from workloads.tables import Tables

TOPIC = "client-events"


def _case(value: Column, options: list[str]) -> Column:
    """options[value] for value in 0..n-1."""
    return F.element_at(F.array(*map(F.lit, options)), (value + 1).cast("int"))


# --- messages: one per event -------------------------------------------------------------

def _client() -> Column:
    return F.concat(F.lit("client_"), F.lpad((F.col("user_id") % 5 + 1).cast("string"), 3, "0"))


def _message_fields() -> dict[str, Column]:
    number = F.col("event_id")
    return {
        "client_id": _client(),
        "client_name": F.concat(F.lit("Client "), (F.col("user_id") % 5 + 1).cast("string")),
        "timestamp": F.when(number % 41 != 0, F.col("ts")),
        "event_type": F.col("event_type"),
        "data": F.create_map(F.lit("k"), F.get_json_object("props", "$.k")),
        "amount": F.when(number % 37 == 0, -F.col("value")).otherwise(F.col("value")),
        "status": _case(number % 5, ["active", "pending", "completed", "failed",
                                     "invalid_status"]),
        "metadata": F.create_map(F.lit("source"), F.lit("web")),
    }


def raw_messages(events: DataFrame, break_some: bool = False) -> DataFrame:
    """Broker records with a JSON body. With break_some every 50th body is cut short."""
    body = json_text.encode(F.struct(*[c.alias(n) for n, c in _message_fields().items()]))
    if break_some:
        body = F.when(F.col("event_id") % 50 == 0, F.expr("left(props, 4)")).otherwise(body)
    return events.select(
        _client().alias("kafka_key"),
        body.alias("kafka_value"),
        F.lit(TOPIC).alias("kafka_topic"),
        (F.col("event_id") % 3).cast("int").alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
        F.col("ts").alias("kafka_timestamp"),
    )


def bronze_messages(events: DataFrame) -> DataFrame:
    """The bronze table as ingest() leaves it, with arrival time = event time. Monitoring
    reads this table; it does not parse again."""
    fields = _message_fields()
    fields["event_timestamp"] = fields.pop("timestamp")
    return events.select(
        F.lit(TOPIC).alias("kafka_topic"),
        (F.col("event_id") % 3).cast("int").alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
        F.col("ts").alias("ingestion_timestamp"),
        *[c.alias(n) for n, c in fields.items()],
    )


def errors(events: DataFrame) -> DataFrame:
    """The error table: one row per error event."""
    return events.filter(F.col("event_type") == "error").select(
        _client().alias("client_id"),
        F.concat(F.lit("table_"), (F.col("user_id") % 3).cast("string")).alias("table_name"),
        F.concat(F.lit("failure "), F.col("props")).alias("error_message"),
        F.col("ts").alias("error_timestamp"),
    )


def pipeline_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("pipeline_id"),
        F.concat(F.lit("pipeline "), F.col("user_id").cast("string")).alias("pipeline_name"),
        F.col("ts").alias("event_timestamp"),
        F.col("event_type").alias("event_message"),
        F.create_map(F.lit("props"), F.col("props")).alias("planning_details"),
    )


# --- education: nation = school, supplier = educator, customer = classroom, -----------------
# --- orders = student, lineitem = assessment ------------------------------------------------

def schools(t: Tables) -> DataFrame:
    return t.nation.select(
        F.col("n_nationkey").alias("school_id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("District "), F.col("n_regionkey").cast("string")).alias("district"),
        _case(F.col("n_regionkey") % 3, ["CA", "NY", "TX"]).alias("state"),
        _case(F.col("n_nationkey") % 2, ["public", "private"]).alias("school_type"),
    )


def educators(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").alias("educator_id"),
        F.col("s_name").alias("first_name"),
        F.concat(F.lit("L"), F.col("s_suppkey").cast("string")).alias("last_name"),
        _case(F.col("s_suppkey") % 4, ["lead_teacher", "assistant", "specialist",
                                       "administrator"]).alias("role"),
        F.col("s_nationkey").alias("school_id"),
    )


def classrooms(t: Tables) -> DataFrame:
    """Fifteen classrooms per educator, as there are fifteen customers per supplier."""
    return t.customer.select(
        F.col("c_custkey").alias("classroom_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("grade_level"),
        F.col("c_nationkey").alias("school_id"),
        F.expr("c_custkey div 15").alias("educator_id"),
    )


def students(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("student_id"),
        F.col("o_custkey").alias("classroom_id"),
        (F.col("o_custkey") % 25).cast("int").alias("school_id"),
    )


def assessments(t: Tables) -> DataFrame:
    return t.lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("assessment_id"),
        F.col("l_orderkey").alias("student_id"),
        F.col("l_suppkey").alias("educator_id"),
        F.col("l_returnflag").alias("subject"),
        F.col("l_quantity").alias("score"),
        F.to_date("l_shipdate").alias("assessment_date"),
        labels.season(F.col("l_shipdate")).alias("assessment_period"),
    )


# --- e-mails: lineitem = recipients and attachments, orders = the e-mail, part = hits ----------
# Ids stay numbers as given; the results declare them as text.

def recipients(t: Tables) -> DataFrame:
    line, order = F.col("l_linenumber"), F.col("l_orderkey")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey").join(
        t.orders, order == F.col("o_orderkey"))
    return rows.select(
        order.alias("unique_email_id"),
        _case(order % 3, ["org_a", "org_b", "org_c"]).alias("rls_org_key"),
        F.concat(F.lit("user"), F.col("o_custkey").cast("string")).alias("user_email"),
        F.col("o_orderdate").alias("created_date_time"),
        F.col("o_orderpriority").alias("importance"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("subject"),
        _case(order % 3, ["standard", "event", "other"]).alias("email_category"),
        F.when(line <= 3, "to").when(line <= 5, "cc").when(line == 6, "bcc")
        .otherwise("reply_to").alias("recipient_type"),
        F.when(F.col("l_suppkey") % 4 != 0, F.col("l_suppkey") % 3 == 0)
        .alias("recipient_address_domain_is_external"),
        (F.col("l_suppkey") % 7 == 0).alias("recipient_address_domain_is_consumer"),
    )


def attachments(t: Tables) -> DataFrame:
    """One row per line, its size from the price: NULL or 0 for some, up to some hundred MB."""
    key, part = F.col("l_orderkey"), F.col("l_partkey")
    size = F.floor(F.col("l_extendedprice") * F.when(part % 3 == 0, 0.01).otherwise(4096.0))
    return t.lineitem.select(
        F.concat_ws("-", key.cast("string"), F.col("l_linenumber").cast("string"))
        .alias("attachment_unique_id"),
        key.alias("email_unique_id"),
        F.when(part % 17 != 0, part).alias("drive_item_unique_id"),
        _case(part % 4, ["file", "item", "reference", "unknown"]).alias("attachment_type"),
        _case(F.col("l_linenumber") % 2, ["file", "folder"]).alias("reference_type"),
        F.when(part % 11 != 0, F.when(part % 13 == 0, 0).otherwise(size)).cast("bigint")
        .alias("size"),
        F.col("l_shipdate").alias("last_modified_date_time"),
        _case(key % 3, ["org_a", "org_b", "org_c"]).alias("rls_org_key"),
    )


def hits(t: Tables) -> DataFrame:
    """No, one or two hits per part."""
    counted = t.part.select("p_partkey", "p_type", (F.col("p_size") % 3).alias("n"))
    each = counted.select(
        "p_partkey", "p_type",
        F.explode(F.expr("transform(array_repeat(0, n), (x, i) -> i)")).alias("hit"))
    part = F.col("p_partkey").cast("string")
    return each.select(
        F.col("p_partkey").alias("drive_item_unique_id"),
        F.concat(F.lit("sit"), F.col("hit").cast("string")).alias("sit_id"),
        F.col("p_type").alias("sit_name"),
        F.concat_ws("-", part, F.col("hit").cast("string")).alias("hit_id"),
        (F.col("hit") + 1).cast("int").alias("hit_rank"),
        F.lit("found").alias("summary"),
        F.lit("auto").alias("classification_type"),
        F.lit(None).cast("timestamp").alias("classification_last_scan"),
    )


# --- refresh log: one row per event, details as JSON text -----------------------------------

def refresh_log(events: DataFrame) -> DataFrame:
    """Eight events make one update. Clicks and errors become flow definitions, sign-ups are
    of a kind the analysis skips, the rest are planning events with up to five techniques."""
    number = F.col("event_id")
    kind = (F.when(F.col("event_type").isin("click", "error"), "flow_definition")
            .when(F.col("event_type") == "signup", "update_progress")
            .otherwise("planning_information"))

    def issue(n: Column) -> Column:
        named = F.when(n % 3 == 1, "EXPECTATIONS_NOT_SUPPORTED").otherwise("PLAN_NOT_INCREMENTAL")
        return F.when(n % 3 != 0, F.array(F.struct(named.alias("issue_type"))))

    def technique(_: Column, i: Column) -> Column:
        n = number + i
        return F.struct(
            (i == F.expr("event_id div 6 % 6")).alias("is_chosen"),
            F.when(n % 2 == 0, "MAINTENANCE_TYPE_COMPLETE_RECOMPUTE")
            .otherwise("MAINTENANCE_TYPE_ROW_BASED").alias("maintenance_type"),
            (F.col("value") + i).alias("cost"),
            issue(n).alias("incrementalization_issues"),
        )

    techniques = F.transform(F.expr("array_repeat(0, int(event_id % 6))"), technique)
    planning = F.struct(
        techniques.alias("technique_information"),
        F.array(F.struct(number.alias("num_rows"))).alias("source_table_information"))
    flow = F.struct(
        F.concat(F.lit("dataset_"), (number % 7).cast("string")).alias("output_dataset"),
        F.concat(F.lit("select "), F.col("props")).alias("explain_text"),
        F.lit("MATERIALIZED_VIEW").alias("flow_type"))
    method = F.when(number % 4 == 0, "has been planned.").otherwise(
        F.concat(F.lit("has been planned to be executed as "),
                 _case(number % 2, ["COMPLETE_RECOMPUTE", "ROW_BASED"]), F.lit(".")))
    return events.withColumn("_kind", kind).select(
        F.struct(
            F.concat(F.lit("u"), F.expr("event_id div 8").cast("string")).alias("update_id"),
            F.concat(F.lit("org"), (F.col("user_id") % 20).cast("string")).alias("org_id"),
            F.concat(F.lit("p"), F.col("user_id").cast("string")).alias("pipeline_id"),
            F.concat(F.lit("pipeline "), F.col("user_id").cast("string"))
            .alias("pipeline_name")).alias("origin"),
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("Flow "), method).alias("message"),
        F.col("_kind").alias("event_type"),
        F.when(F.col("_kind") == "planning_information",
               F.to_json(F.struct(planning.alias("planning_information"))))
        .when(F.col("_kind") == "flow_definition",
              F.to_json(F.struct(flow.alias("flow_definition")))).alias("details"),
    )


# --- audit events, orders, values, stocks, names, masked e-mails, trips ------------------------

def audit(events: DataFrame) -> DataFrame:
    return events.select(
        F.when(F.col("event_type") == "error", "jobs").otherwise("dashboards")
        .alias("service_name"),
        F.when(F.col("event_type") == "click", "publishDashboard")
        .when(F.col("event_type") == "view", "unpublishDashboard")
        .otherwise("openDashboard").alias("action_name"),
        F.col("ts").alias("event_time"),
        F.struct(F.col("user_id").alias("dashboard_id")).alias("request_params"),
        F.struct(F.concat(F.lit("actor"), (F.col("event_id") % 9).cast("string"))
                 .alias("email")).alias("user_identity"),
        F.struct(F.col("event_id").cast("string").alias("run_by"),
                 F.lit("service").alias("run_as")).alias("identity_metadata"),
    )


def dashboard_names(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("dashboard_id"),
                             F.col("c_name").alias("display_name"))


def order_status() -> Column:
    code = F.col("o_orderstatus")
    return F.when(code == "F", "completed").when(code == "O", "pending").otherwise("cancelled")


def orders(t: Tables) -> DataFrame:
    placed = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    located = placed.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return located.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("c_name").alias("customer_name"),
        F.col("n_name").alias("state"),
        F.col("o_totalprice").alias("order_amount"),
        F.col("c_mktsegment").alias("category"),
        F.col("o_orderdate").alias("order_ts"),
        order_status().alias("status"),
    )


def yearly_runs(t: Tables) -> DataFrame:
    """Run metrics with each order year taken as one run of one job per priority."""
    runs = t.orders.withColumn("_year", F.year("o_orderdate")).groupBy(
        F.col("o_orderpriority").alias("job_id"), "_year").agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count_if(order_status() != "cancelled").alias("silver_rows"),
        F.count_distinct("o_orderdate").alias("gold_rows"))
    return runs.select(
        F.col("_year").cast("string").alias("run_id"), "job_id",
        F.make_timestamp(F.col("_year"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
        .alias("run_ts"),
        "bronze_rows", "silver_rows", "gold_rows",
        (F.col("bronze_rows") / 8).cast("float").alias("total_duration_sec"),
        F.lit("success").alias("status"),
    )


def part_value() -> Column:
    """From -2.01 to 97, NULL for every 23rd part."""
    return F.when(F.col("id") % 23 != 0,
                  F.col("id") % 100 + F.col("id") % 7 * 0.125 - 3.0)


def stock_payloads(t: Tables) -> DataFrame:
    """Documents of one priority ("symbol") and month each, so of at most 31 days: the first,
    highest, lowest and last order of a day, and the number of orders as volume."""
    price = "o_totalprice"
    daily = t.orders.groupBy("o_orderpriority", F.to_date("o_orderdate").alias("day")).agg(
        F.min_by(price, "o_orderkey").alias("open"), F.max(price).alias("high"),
        F.min(price).alias("low"), F.max_by(price, "o_orderkey").alias("close"),
        F.count(F.lit(1)).alias("volume"))
    figures = F.create_map(*[
        part for i, n in enumerate(["open", "high", "low", "close", "volume"], 1)
        for part in (F.lit(f"{i}. {n}"), F.col(n).cast("string"))])
    monthly = daily.groupBy("o_orderpriority", F.trunc("day", "month").alias("month")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("day").cast("string"), figures)))
        .alias("series"))
    return monthly.select(
        F.create_map(F.lit("2. Symbol"), F.col("o_orderpriority")).alias("Meta Data"),
        F.col("series").alias("Time Series (Daily)"))


def names(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("name"))


def turn_emails(t: Tables) -> DataFrame:
    """One e-mail per conversation turn; what a user wrote is still to be processed."""
    return t.conversations.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("email_id"),
        F.col("conv_id").cast("int").alias("customer_id"),
        F.concat(F.lit("Subject "), F.col("conv_id").cast("string")).alias("subject"),
        F.col("text").alias("content"),
        (F.col("turn") % 5 / 4).alias("sentiment"),
        F.lit("2024-01-31").cast("date").alias("received_date"),
        F.length("text").cast("double").alias("requested_amount"),
        F.when(F.col("role") == "user", "N").otherwise("Y").alias("processed"),
    )


def trips(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("trip_id"), F.col("l_linenumber").alias("leg"),
        F.col("l_shipdate").alias("pickup"), F.col("l_quantity").alias("fare_amount"))
