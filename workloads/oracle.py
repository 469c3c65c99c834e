"""SQL twins of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

SQL: dict[str, str] = {}


def _round(x: str, digits: int = 2) -> str:
    """Rounds as Spark does: half up on the shortest decimal text of a double."""
    return f"cast(round(cast(cast({x} AS varchar) AS decimal(38,17)), {digits}) AS double)"


# --- messages ------------------------------------------------------------------------------

MSGS = """msgs AS (
  SELECT 'client_' || lpad(cast(user_id % 5 + 1 AS varchar), 3, '0') AS client_id,
         'Client ' || (user_id % 5 + 1) AS client_name,
         CASE WHEN event_id % 41 <> 0 THEN ts END AS event_timestamp,
         event_type, regexp_extract(props, '([0-9]+)', 1) AS data_k, 'web' AS metadata_source,
         CASE WHEN event_id % 37 = 0 THEN -value ELSE value END AS amount,
         CASE event_id % 5 WHEN 0 THEN 'active' WHEN 1 THEN 'pending' WHEN 2 THEN 'completed'
              WHEN 3 THEN 'failed' ELSE 'invalid_status' END AS status,
         'client-events' AS kafka_topic, cast(event_id % 3 AS int) AS kafka_partition,
         event_id AS kafka_offset, ts AS ingestion_timestamp, event_id, props
  FROM events)"""

ACCEPTED = """accepted AS (
  SELECT * FROM msgs WHERE client_id IS NOT NULL AND event_timestamp IS NOT NULL)"""

SILVER = """silver AS (
  SELECT client_id, client_name, event_timestamp, event_type, amount, status, data_k,
         metadata_source, kafka_topic, kafka_partition, kafka_offset,
         cast(year(event_timestamp) AS int) AS year,
         cast(month(event_timestamp) AS int) AS month,
         cast(day(event_timestamp) AS int) AS day,
         CASE WHEN amount < 100 THEN 'small' WHEN amount < 1000 THEN 'medium' ELSE 'large' END
           AS amount_category
  FROM accepted
  WHERE status IN ('active', 'pending', 'completed', 'failed') AND amount >= 0)"""

HOURLY = """hourly AS (
  SELECT client_id, client_name, date_trunc('hour', event_timestamp) AS window_start,
         date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR AS window_end,
         event_type, status, count(*) AS event_count, sum(amount) AS total_amount,
         avg(amount) AS avg_amount, min(amount) AS min_amount, max(amount) AS max_amount,
         cast(count(DISTINCT event_type) AS int) AS unique_event_types
  FROM silver GROUP BY ALL)"""

SQL["messages_parse"] = f"""WITH {MSGS}
SELECT client_id AS kafka_key, kafka_topic, kafka_partition, kafka_offset,
       ingestion_timestamp AS kafka_timestamp, client_id, client_name, event_timestamp,
       event_type, data_k, amount, status, metadata_source
FROM msgs"""
SQL["client_bronze_stream"] = SQL["messages_parse"]

SQL["messages_malformed"] = f"""WITH {MSGS}
SELECT client_id AS event_key, left(props, 4) AS raw_value,
       'JSON parsing failed' AS failure_reason, 'dead-letters' AS target_dlq_topic
FROM msgs WHERE event_id % 50 = 0"""
SQL["messages_malformed_stream"] = SQL["messages_malformed"]

SQL["messages_quarantine"] = f"""WITH {MSGS}, marked AS (
  SELECT kafka_offset, client_id, concat_ws('|',
    CASE WHEN client_id IS NULL THEN 'valid_client_id' END,
    CASE WHEN event_timestamp IS NULL THEN 'not_null_timestamp' END,
    CASE WHEN NOT coalesce(status IN ('active', 'pending', 'completed', 'failed'), false)
         THEN 'valid_status' END,
    CASE WHEN NOT coalesce(amount >= 0, false) THEN 'valid_amount' END) AS failed_rules
  FROM msgs)
SELECT * FROM marked WHERE failed_rules <> ''"""

SQL["messages_dead_letter"] = f"""WITH {MSGS}
SELECT kafka_offset, client_id, 'Invalid schema' AS failure_reason,
       'dead-letters' AS dlq_topic, 0 AS retry_count
FROM msgs WHERE client_id IS NULL OR event_timestamp IS NULL"""

SQL["rule_counts"] = f"""WITH {MSGS}
SELECT 'valid_client_id' AS rule, 'drop' AS action, count(*) AS checked,
       count(*) FILTER (client_id IS NULL) AS failed FROM msgs
UNION ALL SELECT 'not_null_timestamp', 'drop', count(*),
       count(*) FILTER (event_timestamp IS NULL) FROM msgs
UNION ALL SELECT 'valid_status', 'drop', count(*),
       count(*) FILTER (status NOT IN ('active', 'pending', 'completed', 'failed')) FROM msgs
UNION ALL SELECT 'valid_amount', 'drop', count(*),
       count(*) FILTER (amount < 0 OR amount IS NULL) FROM msgs
UNION ALL SELECT 'has_event_type', 'warn', count(*),
       count(*) FILTER (event_type IS NULL) FROM msgs"""

SQL["client_bronze"] = f"""WITH {MSGS}, {ACCEPTED}
SELECT client_id, kafka_offset, event_timestamp, event_type, amount, status FROM accepted"""
SQL["client_layers_stream"] = SQL["client_bronze"]

SQL["client_silver"] = f"WITH {MSGS}, {ACCEPTED}, {SILVER} SELECT * FROM silver"
SQL["client_silver_stream"] = SQL["client_silver"]
SQL["client_silver_backlog"] = SQL["client_silver"]

SQL["client_gold_hourly"] = f"""WITH {MSGS}, {ACCEPTED}, {SILVER}, {HOURLY}
SELECT * REPLACE ({_round('total_amount')} AS total_amount, {_round('avg_amount', 6)} AS avg_amount)
FROM hourly"""
SQL["client_gold_hourly_stream"] = SQL["client_gold_hourly"]
SQL["client_gold_hourly_compacted"] = SQL["client_gold_hourly"]

SQL["message_layers_stream"] = SQL["client_gold_hourly"]
SQL["client_gold_closed_stream"] = f"""{SQL['client_gold_hourly']}
WHERE window_end <= (SELECT max(event_timestamp) - INTERVAL 1 HOUR FROM silver)"""

SQL["client_registry_stream"] = f"""WITH {MSGS}
SELECT DISTINCT client_id, client_name FROM msgs"""

SQL["client_registry"] = SQL["client_registry_stream"]
SQL["one_client"] = f"""WITH {MSGS}, {ACCEPTED}
SELECT client_id, kafka_offset, event_timestamp, amount, status FROM accepted
WHERE client_id = 'client_001'"""
SQL["json_paths"] = """
SELECT event_id, regexp_extract(props, '([0-9]+)', 1) AS k, NULL::varchar AS absent FROM events"""

SQL["hourly_event_metrics"] = """
SELECT date_trunc('hour', ts) AS hour, count(*) AS event_count,
       count(DISTINCT event_id) AS unique_events, min(ts) AS first_event, max(ts) AS last_event
FROM events GROUP BY 1"""

SQL["stream_foreach_batch"] = f"""WITH {MSGS}
SELECT client_id AS key,
       '{{"client_id":"' || client_id || '","kafka_partition":' || kafka_partition
       || ',"kafka_offset":' || kafka_offset || ',"event_type":"' || event_type
       || '","status":"' || status || '"}}' AS value
FROM msgs"""

SQL["stream_restart"] = f"WITH {MSGS} SELECT client_id, kafka_offset FROM msgs"

# --- monitoring ----------------------------------------------------------------------------

ERRORS = """errors AS (
  SELECT 'client_' || lpad(cast(user_id % 5 + 1 AS varchar), 3, '0') AS client_id,
         'table_' || (user_id % 3) AS table_name, 'failure ' || props AS error_message,
         ts AS error_timestamp
  FROM events WHERE event_type = 'error')"""
END = "TIMESTAMP '2024-01-31 00:00:00'"


def _since(column: str, lookback: str) -> str:
    return f"{column} >= {END} - INTERVAL {lookback}"


SQL["errors_recent"] = f"""WITH {ERRORS}
SELECT client_id, table_name, count(*) AS error_count, max(error_timestamp) AS last_error
FROM errors WHERE {_since('error_timestamp', '7 DAYS')} GROUP BY 1, 2"""
SQL["errors_daily"] = f"""WITH {ERRORS}
SELECT client_id, table_name, count(*) AS error_count, max(error_timestamp) AS last_error
FROM errors WHERE {_since('error_timestamp', '1 DAY')} GROUP BY 1, 2"""
SQL["errors_recent_messages"] = f"""WITH {ERRORS}
SELECT client_id, table_name, error_message, count(*) AS message_count,
       max(error_timestamp) AS last_error
FROM errors WHERE {_since('error_timestamp', '7 DAYS')} GROUP BY 1, 2, 3"""
SQL["pipeline_health"] = f"""WITH {ERRORS}
SELECT client_id, count(*) AS error_count_last_hour, max(error_timestamp) AS last_error_time
FROM errors WHERE {_since('error_timestamp', '7 DAYS')} GROUP BY 1"""
SQL["error_trend"] = f"""WITH {ERRORS}
SELECT date_trunc('hour', error_timestamp) AS error_hour, client_id, count(*) AS error_count
FROM errors WHERE {_since('error_timestamp', '24 HOURS')} GROUP BY 1, 2"""

RECENT = _since("ingestion_timestamp", "30 DAYS")
SQL["volume_by_client"] = f"""WITH {MSGS}
SELECT client_id, client_name, count(*) AS message_count,
       min(ingestion_timestamp) AS first_message, max(ingestion_timestamp) AS last_message
FROM msgs WHERE {RECENT} GROUP BY 1, 2"""
SQL["rows_by_client"] = f"""WITH {MSGS}
SELECT client_id, count(*) AS message_count FROM msgs GROUP BY 1"""
SQL["layer_drop_rate"] = f"""WITH {MSGS}, {ACCEPTED}, {SILVER}, {HOURLY}, n AS (
  SELECT (SELECT count(*) FROM msgs) AS b, (SELECT count(*) FROM silver) AS s,
         (SELECT count(*) FROM hourly) AS g)
SELECT b AS bronze_count, s AS silver_count, g AS gold_count,
       CASE WHEN b = 0 THEN 0.0 ELSE cast(b - s AS double) / b * 100 END AS drop_rate_pct
FROM n"""
SQL["event_type_distribution"] = f"""WITH {MSGS}
SELECT client_id, event_type, count(*) AS event_count, {_round('avg(amount)')} AS avg_amount,
       {_round('sum(amount)')} AS total_amount
FROM msgs WHERE {RECENT} GROUP BY 1, 2"""
SQL["gold_latest20"] = f"""WITH {MSGS}, {ACCEPTED}, {SILVER}, {HOURLY}
SELECT client_id, window_start, window_end, event_type, status, event_count,
       {_round('total_amount')} AS total_amount, {_round('avg_amount')} AS avg_amount,
       min_amount, max_amount
FROM hourly ORDER BY window_start DESC, client_id, event_type, status LIMIT 20"""
SQL["messages_latest20"] = f"""WITH {MSGS}
SELECT client_id, client_name, event_timestamp, event_type, amount, status,
       ingestion_timestamp
FROM msgs ORDER BY ingestion_timestamp DESC, kafka_partition, kafka_offset DESC LIMIT 20"""
SQL["offset_progress"] = f"""WITH {MSGS}
SELECT kafka_partition, min(kafka_offset) AS min_offset, max(kafka_offset) AS max_offset,
       count(*) AS messages_processed, max(ingestion_timestamp) AS last_ingestion_time,
       max(kafka_offset) - min(kafka_offset) + 1 - count(*) AS missing_offsets
FROM msgs GROUP BY 1"""
SQL["status_share"] = f"""WITH {MSGS}, counted AS (
  SELECT client_id, status, count(*) AS status_count FROM msgs WHERE {RECENT} GROUP BY 1, 2),
shared AS (
  SELECT *, status_count * 100.0::double / cast(sum(status_count) OVER (PARTITION BY client_id)
         AS double) AS share FROM counted)
SELECT client_id, status, status_count, {_round('share')} AS percentage FROM shared"""
SQL["failed_alert"] = f"""WITH {MSGS}
SELECT client_id, count(*) AS failed_count, max(event_timestamp) AS last_failure
FROM msgs WHERE status = 'failed' AND {RECENT}
GROUP BY 1 HAVING count(*) > 10"""
SQL["events_of_one"] = """
SELECT user_id AS pipeline_id, 'pipeline ' || user_id AS pipeline_name, event_id AS id,
       ts AS event_timestamp, event_type AS event_message, props
FROM events WHERE user_id = 7"""

# --- audit and refresh log -------------------------------------------------------------------

SQL["dashboard_latest"] = """WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC,
           CASE event_type WHEN 'click' THEN 'publishDashboard' ELSE 'unpublishDashboard' END,
           'actor' || (event_id % 9), cast(event_id AS varchar)) AS rn
  FROM events
  WHERE ts >= TIMESTAMP '2024-07-14 00:00:00' - INTERVAL 180 DAYS
    AND event_type IN ('click', 'view'))
SELECT user_id AS dashboard_id,
       CASE event_type WHEN 'click' THEN 'published' ELSE 'unpublished' END AS publish_state,
       'actor' || (event_id % 9) AS actor_email, cast(event_id AS varchar) AS run_by,
       'service' AS run_as, ts AS event_time,
       'https://host.example/sql/dashboardsv3/' || user_id AS dashboard_url,
       c_name AS display_name
FROM ranked LEFT JOIN customer ON c_custkey = user_id WHERE rn = 1"""


def _issue(i: int) -> str:
    """Issue of technique i: NULL beyond the list or where the rest is 0."""
    return (f"CASE WHEN n > {i} AND (event_id + {i}) % 3 <> 0 THEN "
            f"CASE WHEN (event_id + {i}) % 3 = 1 THEN 'EXPECTATIONS_NOT_SUPPORTED' "
            f"ELSE 'PLAN_NOT_INCREMENTAL' END END")


REFRESHES = f"""planned AS (
  SELECT *, event_id % 6 AS n, (event_id // 6) % 6 AS c FROM events
  WHERE event_type NOT IN ('click', 'error', 'signup')),
typed AS (
  SELECT *, CASE WHEN c < n THEN CASE WHEN (event_id + c) % 2 = 0
           THEN 'MAINTENANCE_TYPE_COMPLETE_RECOMPUTE' ELSE 'MAINTENANCE_TYPE_ROW_BASED' END END
           AS chosen_maintenance_type,
         CASE WHEN c < n THEN value + c END AS cost
  FROM planned),
refreshes AS (
  SELECT 'u' || (event_id // 8) AS update_id, 'org' || (user_id % 20) AS org_id,
         'p' || user_id AS pipeline_id, ts AS timestamp, 'pipeline ' || user_id AS pipeline_name,
         CASE WHEN event_id % 4 = 0 THEN '' WHEN event_id % 2 = 0 THEN 'COMPLETE_RECOMPUTE'
              ELSE 'ROW_BASED' END AS refresh_type,
         chosen_maintenance_type, cost,
         CASE WHEN chosen_maintenance_type = 'MAINTENANCE_TYPE_COMPLETE_RECOMPUTE' THEN coalesce(
           CASE WHEN {_issue(1)} = 'EXPECTATIONS_NOT_SUPPORTED'
                THEN 'EXPECTATIONS_NOT_SUPPORTED' END,
           CASE WHEN {_issue(2)} = 'EXPECTATIONS_NOT_SUPPORTED'
                THEN 'EXPECTATIONS_NOT_SUPPORTED' END,
           {', '.join(map(_issue, range(6)))}, 'UNKNOWN_ISSUE')
         ELSE 'incremental recompute' END AS recompute_reason,
         event_id AS num_rows
  FROM typed)"""

FLOWS = """flows AS (
  SELECT 'u' || (event_id // 8) AS update_id, 'org' || (user_id % 20) AS org_id,
         'p' || user_id AS pipeline_id, 'dataset_' || (event_id % 7) AS output_dataset,
         'select ' || props AS query, 'MATERIALIZED_VIEW' AS table_type
  FROM events WHERE event_type IN ('click', 'error'))"""

SQL["refresh_technique"] = f"WITH {REFRESHES} SELECT * FROM refreshes"
SQL["refresh_log_files"] = SQL["refresh_technique"]
SQL["refresh_raw_log"] = """
SELECT ts AS timestamp, 'Flow ' || CASE WHEN event_id % 4 = 0 THEN 'has been planned.'
         ELSE 'has been planned to be executed as ' || CASE WHEN event_id % 2 = 0
              THEN 'COMPLETE_RECOMPUTE' ELSE 'ROW_BASED' END || '.' END AS message,
       CASE WHEN event_type IN ('click', 'error') THEN 'flow_definition'
            WHEN event_type = 'signup' THEN 'update_progress'
            ELSE 'planning_information' END AS event_type,
       'u' || (event_id // 8) AS update_id, NULL::varchar AS error
FROM events"""
SQL["refresh_flows"] = f"WITH {FLOWS} SELECT * FROM flows"
SQL["refresh_with_flows"] = f"""WITH {REFRESHES}, {FLOWS}
SELECT r.update_id, r.org_id, r.pipeline_id, r.timestamp, r.pipeline_name, r.refresh_type,
       r.chosen_maintenance_type, r.recompute_reason, r.cost, r.num_rows,
       f.output_dataset, f.query, f.table_type
FROM refreshes r LEFT JOIN flows f ON r.update_id = f.update_id"""
SQL["refresh_layers"] = SQL["refresh_with_flows"] + " AND r.pipeline_id = f.pipeline_id"
SQL["refresh_by_update"] = f"""WITH {REFRESHES}, {FLOWS}, per_update AS (
  SELECT update_id, count(*) AS flows_n, count(DISTINCT output_dataset) AS datasets_n
  FROM flows GROUP BY 1)
SELECT r.*, coalesce(flows_n, 0) AS matching_flows, coalesce(datasets_n, 0) AS matching_datasets
FROM refreshes r LEFT JOIN per_update p ON r.update_id = p.update_id"""
SQL["refresh_by_org"] = f"""WITH {REFRESHES}, {FLOWS}, per_org AS (
  SELECT org_id, count(*) AS flows_n, count(DISTINCT output_dataset) AS datasets_n
  FROM flows GROUP BY 1)
SELECT r.org_id, r.timestamp, r.pipeline_id, r.pipeline_name, r.refresh_type,
       r.chosen_maintenance_type, r.recompute_reason, r.cost,
       coalesce(flows_n, 0) AS matching_flows, coalesce(datasets_n, 0) AS matching_datasets
FROM refreshes r LEFT JOIN per_org p ON r.org_id = p.org_id"""

# --- e-mails ---------------------------------------------------------------------------------


def _size_text(x: str) -> str:
    parts = [f"WHEN {x} >= {1 << p} THEN cast({_round(f'{x} / {1 << p}.0::double')} AS varchar)"
             f" || ' {u}'" for u, p in (("GB", 30), ("MB", 20), ("KB", 10))]
    return (f"CASE WHEN {x} IS NULL OR {x} = 0 THEN '-' {' '.join(parts)} "
            f"ELSE cast({x} AS varchar) || ' B' END")


ORG = "CASE {0} % 3 WHEN 0 THEN 'org_a' WHEN 1 THEN 'org_b' ELSE 'org_c' END"
ATTACHMENTS = f"""attachments AS (
  SELECT l_orderkey || '-' || l_linenumber AS attachment_unique_id,
         cast(l_orderkey AS varchar) AS email_unique_id,
         CASE WHEN l_partkey % 17 <> 0 THEN cast(l_partkey AS varchar) END
           AS drive_item_unique_id,
         CASE l_partkey % 4 WHEN 0 THEN 'file' WHEN 1 THEN 'item' WHEN 2 THEN 'reference'
              ELSE 'unknown' END AS attachment_type,
         CASE l_linenumber % 2 WHEN 0 THEN 'file' ELSE 'folder' END AS reference_type,
         CASE WHEN l_partkey % 11 <> 0 THEN CASE WHEN l_partkey % 13 = 0 THEN 0 ELSE
           cast(floor(l_extendedprice * CASE WHEN l_partkey % 3 = 0 THEN 0.01::double
                      ELSE 4096.0::double END) AS bigint) END END AS size,
         l_shipdate AS last_modified_date_time, {ORG.format('l_orderkey')} AS rls_org_key
  FROM lineitem)"""
HITS = """hits AS (
  SELECT cast(p_partkey AS varchar) AS drive_item_unique_id, 'sit' || hit AS sit_id,
         p_type AS sit_name, p_partkey || '-' || hit AS hit_id, cast(hit + 1 AS int) AS hit_rank,
         'found' AS sit_summary, 'auto' AS classification_type
  FROM part, unnest(range(0, p_size % 3)) AS u(hit))"""

SQL["attachment_hits"] = f"""WITH {ATTACHMENTS}, {HITS}
SELECT a.*, CASE WHEN attachment_type IN ('file', 'item') THEN 'Attachment'
                 WHEN attachment_type = 'reference' AND reference_type = 'file'
                 THEN 'M365 File Link'
                 WHEN attachment_type = 'reference' AND reference_type = 'folder'
                 THEN 'M365 Folder Link' END AS share_type,
       {_size_text('size')} AS size_display,
       h.sit_id, h.sit_name, h.hit_id, h.hit_rank, h.sit_summary, h.classification_type
FROM attachments a LEFT JOIN hits h ON a.drive_item_unique_id = h.drive_item_unique_id"""

SQL["email_summary"] = f"""WITH {ATTACHMENTS}, {HITS}, joined AS (
  SELECT a.* FROM attachments a
  LEFT JOIN hits h ON a.drive_item_unique_id = h.drive_item_unique_id),
single AS (
  SELECT email_unique_id, rls_org_key, attachment_unique_id, max(size) AS size
  FROM joined GROUP BY 1, 2, 3),
totals AS (
  SELECT email_unique_id, rls_org_key, count(DISTINCT attachment_unique_id) AS n,
         cast(coalesce(sum(size), 0) AS bigint) AS bytes
  FROM single GROUP BY 1, 2),
recipients AS (
  SELECT cast(l_orderkey AS varchar) AS unique_email_id, {ORG.format('l_orderkey')} AS org,
         o.*,
         CASE WHEN l_linenumber <= 3 THEN 'to' WHEN l_linenumber <= 5 THEN 'cc'
              WHEN l_linenumber = 6 THEN 'bcc' ELSE 'reply_to' END AS kind,
         CASE WHEN l_suppkey % 4 <> 0 THEN l_suppkey % 3 = 0 END AS external,
         l_suppkey % 7 = 0 AS consumer
  FROM lineitem JOIN orders o ON l_orderkey = o_orderkey),
grouped AS (
  SELECT unique_email_id, org, min(o_custkey) AS cust, min(o_orderdate) AS created,
         min(o_orderpriority) AS importance, min(o_orderkey) AS okey,
         count(*) FILTER (kind IN ('to', 'cc', 'bcc')) AS recipient_count,
         count(*) FILTER (kind = 'to') AS to_count, count(*) FILTER (kind = 'cc') AS cc_count,
         count(*) FILTER (kind = 'bcc') AS bcc_count,
         count(*) FILTER (kind = 'reply_to') AS reply_to_count,
         count(*) FILTER (kind IN ('to', 'cc', 'bcc') AND external) AS ext,
         count(*) FILTER (kind IN ('to', 'cc', 'bcc') AND consumer) AS con
  FROM recipients GROUP BY 1, 2)
SELECT unique_email_id, org AS rls_org_key, 'user' || cust AS user_email,
       created AS created_date_time, cast(created AS date) AS created_date,
       'Order ' || okey AS subject, importance,
       CASE okey % 3 WHEN 0 THEN 'standard' WHEN 1 THEN 'event' ELSE 'other' END
         AS email_category,
       CASE okey % 3 WHEN 0 THEN 'Standard Email' WHEN 1 THEN 'Event (Cal Invites)'
            ELSE 'other' END AS email_category_label,
       recipient_count, to_count, cc_count, bcc_count, reply_to_count,
       ext AS external_recipient_count, ext > 0 AS has_external_recipient,
       con > 0 AS has_consumer_recipient, coalesce(n, 0) AS attachment_count,
       coalesce(bytes, 0) AS attachment_size,
       {_size_text('coalesce(bytes, 0)')} AS attachment_size_display
FROM grouped LEFT JOIN totals ON unique_email_id = email_unique_id AND org = rls_org_key"""

SQL["email_layers"] = f"SELECT * FROM ({SQL['email_summary']}) WHERE rls_org_key = 'org_b'"

# --- education -------------------------------------------------------------------------------

SEASON = ("CASE WHEN month({0}) <= 3 THEN 'winter' WHEN month({0}) <= 7 THEN 'spring' "
          "ELSE 'fall' END")
ASSESSMENTS = f"""mapped AS (
  SELECT l_orderkey * 10 + l_linenumber AS assessment_id, l_orderkey AS student_id,
         l_suppkey AS educator_id, l_returnflag AS subject, l_quantity AS score,
         cast(l_shipdate AS date) AS assessment_date,
         {SEASON.format('l_shipdate')} AS assessment_period
  FROM lineitem),
assessments AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY assessment_id ORDER BY student_id, educator_id,
             subject, score, assessment_date, assessment_period) AS rn FROM mapped)
  WHERE rn = 1)"""

SQL["edu_silver"] = f"WITH {ASSESSMENTS} SELECT * FROM assessments"

SQL["edu_assessment_summary"] = f"""WITH {ASSESSMENTS}
SELECT c_custkey AS classroom_id, c_name AS classroom_name, c_mktsegment AS grade_level,
       n_nationkey AS school_id, n_name AS school_name, subject, assessment_period,
       count(DISTINCT student_id) AS student_count, {_round('avg(score)')} AS avg_score,
       min(score) AS min_score, max(score) AS max_score,
       {_round('stddev_samp(score)')} AS stddev_score
FROM assessments JOIN orders ON o_orderkey = student_id
JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
GROUP BY 1, 2, 3, 4, 5, 6, 7"""

SQL["edu_educator_metrics"] = f"""WITH {ASSESSMENTS}
SELECT s_suppkey AS educator_id, s_name AS first_name, 'L' || s_suppkey AS last_name,
       CASE s_suppkey % 4 WHEN 0 THEN 'lead_teacher' WHEN 1 THEN 'assistant'
            WHEN 2 THEN 'specialist' ELSE 'administrator' END AS role,
       n_name AS school_name, count(DISTINCT o_orderkey) AS student_count,
       count(DISTINCT assessment_id) AS assessment_count,
       {_round('avg(score)')} AS avg_student_score,
       count(DISTINCT c_custkey) AS classroom_count
FROM supplier JOIN customer ON c_custkey // 15 = s_suppkey
JOIN orders ON o_custkey = c_custkey
JOIN assessments ON student_id = o_orderkey
JOIN nation ON n_nationkey = s_nationkey
GROUP BY 1, 2, 3, 4, 5"""

SQL["edu_school_overview"] = f"""WITH {ASSESSMENTS},
taken AS (
  SELECT o_custkey % 25 AS k, count(DISTINCT o_orderkey) AS students,
         avg(score) AS mean, count(assessment_id) AS n
  FROM orders LEFT JOIN assessments ON student_id = o_orderkey GROUP BY 1),
staff AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1),
rooms AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1)
SELECT n_nationkey AS school_id, n_name AS name, 'District ' || n_regionkey AS district,
       CASE n_regionkey % 3 WHEN 0 THEN 'CA' WHEN 1 THEN 'NY' ELSE 'TX' END AS state,
       CASE n_nationkey % 2 WHEN 0 THEN 'public' ELSE 'private' END AS school_type,
       coalesce(taken.students, 0) AS total_students, coalesce(staff.n, 0) AS total_educators,
       coalesce(rooms.n, 0) AS total_classrooms, {_round('taken.mean')} AS avg_assessment_score,
       coalesce(taken.n, 0) AS total_assessments
FROM nation LEFT JOIN taken ON taken.k = n_nationkey
LEFT JOIN staff ON staff.k = n_nationkey LEFT JOIN rooms ON rooms.k = n_nationkey"""

# Read from CSV, ids are text and the winner among repeated keys is chosen in text order.
_AS_TEXT = SQL["edu_school_overview"].replace(
    "ORDER BY student_id, educator_id", "ORDER BY student_id, cast(educator_id AS varchar)")
SQL["edu_from_csv"] = f"SELECT * REPLACE (cast(school_id AS varchar) AS school_id) FROM ({_AS_TEXT})"
SQL["season"] = f"SELECT {SEASON.format('o_orderdate')} AS season, count(*) AS n FROM orders GROUP BY 1"
SQL["csv_ingest"] = "SELECT *, true AS has_source FROM customer"
SQL["snapshot_sync"] = SQL["edu_assessment_summary"]

# --- orders and runs ---------------------------------------------------------------------------

STATUS = "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'cancelled' END"
ORDERS = f"""clean AS (
  SELECT o_orderkey AS order_id, c_name AS customer_name, n_name AS state,
         o_totalprice AS order_amount, c_mktsegment AS category, o_orderdate AS order_ts,
         {STATUS} AS status, {_round('o_totalprice')} AS order_amount_usd,
         cast(o_orderdate AS date) AS order_date
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  WHERE o_orderstatus IN ('F', 'O'))"""
SQL["orders_silver"] = f"WITH {ORDERS} SELECT * FROM clean"
SQL["orders_revenue"] = f"""WITH {ORDERS}
SELECT category, state, order_date, count(order_id) AS num_orders,
       sum(cast(round(order_amount_usd * 100) AS bigint))::double / 100 AS total_revenue,
       sum(cast(round(order_amount_usd * 100) AS bigint))::double / 100 / count(*)
         AS avg_order_value
FROM clean GROUP BY 1, 2, 3"""
SQL["run_metrics"] = f"""WITH {ORDERS}
SELECT 'run1' AS run_id, 'job1' AS job_id,
       cast((SELECT count(*) FROM orders JOIN customer ON c_custkey = o_custkey
             JOIN nation ON n_nationkey = c_nationkey) AS bigint) AS bronze_rows,
       cast((SELECT count(*) FROM clean) AS bigint) AS silver_rows,
       cast((SELECT count(*) FROM (SELECT DISTINCT category, state, order_date FROM clean))
            AS bigint) AS gold_rows,
       'success' AS status"""
RUNS = f"""runs AS (
  SELECT o_orderpriority AS job_id, cast(year(o_orderdate) AS varchar) AS run_id,
         make_timestamp(year(o_orderdate), 1, 1, 0, 0, 0.0) AS run_ts,
         cast(count(*) AS bigint) AS bronze_rows,
         cast(count(*) FILTER ({STATUS} <> 'cancelled') AS bigint) AS silver_rows,
         cast(count(DISTINCT o_orderdate) AS bigint) AS gold_rows,
         cast(count(*) / 8 AS float) AS total_duration_sec
  FROM orders GROUP BY 1, 2, 3)"""
SQL["run_last_two"] = f"""WITH {RUNS}
SELECT *, 'success' AS status FROM runs
QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY run_ts DESC, run_id DESC) <= 2"""
SQL["run_compare"] = f"""WITH {RUNS}
SELECT *, bronze_rows - lag(bronze_rows) OVER w AS delta_bronze,
       total_duration_sec - lag(total_duration_sec) OVER w AS delta_duration_sec
FROM runs WINDOW w AS (PARTITION BY job_id ORDER BY run_ts, run_id)"""
SQL["evolving_append"] = """
SELECT o_orderkey, o_totalprice, NULL::varchar AS batch FROM orders
UNION ALL SELECT o_orderkey, o_totalprice, 'second' FROM orders"""

# --- values, stocks, names, masking, trips -------------------------------------------------------

VALUES = f"""raw AS (
  SELECT p_partkey AS id, CASE WHEN p_partkey % 23 <> 0
         THEN p_partkey % 100 + (p_partkey % 7) * 0.125::double - 3.0::double END AS value
  FROM part),
silver AS (
  SELECT id, 'user_' || id AS name, value, 'dev' AS config, 'broker.example' AS kafka_host,
         {_round('value')} AS value_rounded,
         CASE WHEN value < 33 THEN 'low' WHEN value < 66 THEN 'medium' ELSE 'high' END
           AS value_category, '/checkpoints/dev' AS checkpoint_path
  FROM raw WHERE id IS NOT NULL AND value >= 0)"""
SQL["value_silver"] = f"WITH {VALUES} SELECT * FROM silver"
SQL["value_stats"] = f"""WITH {VALUES}
SELECT value_category, config, kafka_host, count(*) AS record_count,
       {_round('avg(value_rounded)', 6)} AS avg_value, min(value_rounded) AS min_value,
       max(value_rounded) AS max_value, {_round('stddev_samp(value_rounded)', 6)} AS stddev_value,
       'dev' AS environment
FROM silver GROUP BY 1, 2, 3"""
SQL["stock_silver"] = """
SELECT cast(cast(o_orderdate AS date) AS varchar) AS stock_date, o_orderpriority AS symbol,
       arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
       min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
       count(*) AS volume
FROM orders GROUP BY 1, 2"""
SQL["stock_gold"] = SQL["stock_silver"]

TURNS = """emails AS (
  SELECT conv_id * 1000 + turn AS email_id, cast(conv_id AS int) AS customer_id,
         'Subject ' || conv_id AS subject, text AS content,
         (turn % 5) / 4.0::double AS sentiment, DATE '2024-01-31' AS received_date,
         cast(length(text) AS double) AS requested_amount,
         CASE WHEN role = 'user' THEN 'N' ELSE 'Y' END AS processed
  FROM conversations)"""
SQL["masked_open"] = f"WITH {TURNS} SELECT * FROM emails"
SQL["masked_restricted"] = f"""WITH {TURNS}
SELECT * REPLACE ('***' AS content) FROM emails WHERE processed = 'Y'"""
SQL["masked_by_sql"] = SQL["masked_restricted"]
SQL["masked_grouped"] = f"""WITH {TURNS}, grouped AS (
  SELECT email_id, customer_id, subject, content, sentiment, received_date, processed,
         sum(requested_amount) AS requested_amount FROM emails GROUP BY ALL)
SELECT * REPLACE ('***' AS content) FROM grouped WHERE processed = 'Y'"""
SQL["name_counts"] = """
SELECT c_mktsegment AS name, count(c_custkey) AS name_count FROM customer GROUP BY 1"""
SQL["name_table"] = "SELECT c_custkey AS id, c_mktsegment AS name FROM customer"
SQL["error_table"] = f"WITH {ERRORS} SELECT * FROM errors"
SQL["name_counts_all"] = SQL["name_counts"]
SQL["name_counts_filtered"] = SQL["name_counts"] + " HAVING c_mktsegment <> 'BUILDING'"
SQL["fare_filter"] = """
SELECT l_orderkey AS trip_id, l_linenumber AS leg, l_shipdate AS pickup,
       l_quantity AS fare_amount FROM lineitem WHERE l_quantity < 30"""


def _state(column: str, want: str | None, have: str | None, state: str, nulls: str) -> str:
    def text(v: str | None) -> str:
        return f"'{v}'" if v else "NULL::varchar"
    return (f"SELECT '{column}' AS \"column\", {text(want)} AS expected_type, "
            f"{text(have)} AS found_type, {state} AS state, {nulls} AS null_rows FROM events")


def _nulls(column: str) -> str:
    return f"count(*) FILTER ({column} IS NULL)"


SQL["schema_conform"] = " UNION ALL ".join([
    _state("event_id", "bigint", "bigint", f"CASE WHEN {_nulls('event_id')} > 0 THEN 'null' ELSE 'ok' END",
           _nulls("event_id")),
    _state("ts", "timestamp", "timestamp", "'ok'", _nulls("ts")),
    _state("user_id", "string", "bigint", "'type'", _nulls("user_id")),
    _state("value", "double", "double", "'ok'", _nulls("value")),
    _state("event_timestamp", "timestamp", "timestamp",
           "CASE WHEN count(*) FILTER (event_id % 41 = 0) > 0 THEN 'null' ELSE 'ok' END",
           "count(*) FILTER (event_id % 41 = 0)"),
    _state("schema_version", "string", None, "'missing'", "count(*)"),
    _state("event_type", None, "string", "'extra'", _nulls("event_type")),
    _state("props", None, "string", "'extra'", _nulls("props")),
])

# --- invented data: sizes come from the tables, the rest must hold by construction ----------------


def _relation(name: str, table: str) -> str:
    return (f"SELECT '{name}' AS relation, count(*) AS rows, 0::bigint AS orphans, "
            f"0::bigint AS mismatches FROM {table}")


SQL["synth_education"] = " UNION ALL ".join([
    _relation("educator-school", "supplier"), _relation("classroom-school", "customer"),
    _relation("classroom-educator", "customer"), _relation("student-classroom", "orders"),
    _relation("assessment-student", "lineitem"), _relation("assessment-objective", "lineitem")])
SQL["synth_orders"] = """
SELECT count(*) AS rows, 0::bigint AS bad_amounts, 0::bigint AS bad_times,
       5::bigint AS categories, 4::bigint AS statuses FROM orders"""
SQL["synth_messages"] = """
SELECT rule, action, count(*) AS checked, 0::bigint AS failed
FROM events, (VALUES ('valid_client_id', 'drop'), ('not_null_timestamp', 'drop'),
  ('valid_status', 'drop'), ('valid_amount', 'drop'), ('has_event_type', 'warn')) r(rule, action)
GROUP BY 1, 2"""
SQL["synth_names"] = """
SELECT count(*) AS rows, 0::bigint AS bad_ids, 5::bigint AS names FROM customer"""

# --- recorded failures, newest messages, observed streams, catalogue objects ----------------

_NEWEST = "string_agg(error_message, ' | ' ORDER BY error_timestamp DESC, error_message)"
SQL["errors_newest"] = f"""WITH {ERRORS}, r AS (
  SELECT *, row_number() OVER (PARTITION BY client_id, table_name
                               ORDER BY error_timestamp DESC, error_message) AS rn
  FROM errors WHERE {_since('error_timestamp', '7 DAYS')})
SELECT client_id, table_name, count(*) AS error_count, max(error_timestamp) AS last_error,
       {_NEWEST} FILTER (WHERE rn <= 5) AS recent_messages FROM r GROUP BY 1, 2"""
SQL["health_newest"] = f"""WITH {ERRORS}, r AS (
  SELECT *, row_number() OVER (PARTITION BY client_id
                               ORDER BY error_timestamp DESC, error_message) AS rn
  FROM errors WHERE {_since('error_timestamp', '7 DAYS')})
SELECT client_id, count(*) AS error_count_last_hour, max(error_timestamp) AS last_error_time,
       {_NEWEST} FILTER (WHERE rn <= 5) AS recent_messages FROM r GROUP BY 1"""
SQL["stream_rule_counts"] = f"""
SELECT rule, action, 4::bigint AS batches, checked, failed FROM ({SQL['rule_counts']})"""
SQL["stream_restart_midway"] = SQL["stream_restart"]
SQL["stream_continuous"] = SQL["stream_restart"]
SQL["stream_from_ticks"] = SQL["stream_foreach_batch"]
SQL["run_recorded"] = """
SELECT 'run1' AS name, 'failed' AS detail, (SELECT count(*) FROM orders) || ',0,0' AS rows
UNION ALL SELECT 'orders_clean', 'broken layer', NULL"""
SQL["masked_view"] = SQL["masked_restricted"]
SQL["ddl_script"] = """
SELECT c_mktsegment AS name, count(c_custkey) AS n, 'customer; key' AS id_comment,
       'bigint' AS id_type, 'names; by customer' AS table_comment
FROM customer GROUP BY 1"""
