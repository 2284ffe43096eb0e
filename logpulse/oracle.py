"""DuckDB SQL computing the expected result of each registered query from ``events``."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Text of each payload field, NULL where the field is absent from that generation.
_TEXT = {
    "event_id": "CASE WHEN shape <> 3 THEN '\"ev-' || id || '\"' END",
    "event_name": "'\"' || service || '.' || event_type || '\"'",
    "ts_ms": "CASE WHEN shape <> 3 THEN ms::VARCHAR END",
    "service": "'\"' || service || '\"'",
    "request_id": "CASE WHEN shape <> 3 THEN '\"req-' || (id // 2) || '\"' END",
    "method": "CASE WHEN shape IN (0, 2) THEN '\"' || CASE WHEN k % 2 = 0 THEN 'GET' "
    "ELSE 'POST' END || '\"' END",
    "route_template": "CASE WHEN shape <> 3 THEN '\"/v2/' || service || '/' || event_type || '\"' END",
    "status_code": "CASE WHEN shape IN (0, 2) OR (shape = 3 AND k % 10 <> 9) THEN sc::VARCHAR END",
    "duration_ms": "CASE WHEN shape IN (0, 2) THEN (k * 3)::VARCHAR END",
    "result": "CASE WHEN shape IN (0, 1) THEN CASE WHEN event_type = 'error' THEN '\"fail\"' "
    "ELSE '\"success\"' END END",
    "user_id": "user_id::VARCHAR",
    "order_id": "CASE WHEN service = 'order' THEN '\"o-' || (id % 1000) || '\"' END",
    "payment_id": "CASE WHEN service = 'payment' THEN '\"p-' || (id % 1000) || '\"' END",
    "reason_code": "CASE WHEN shape = 1 AND event_type = 'error' THEN '\"r' || (k % 7) || '\"' END",
    "api_group": "CASE WHEN shape <> 3 THEN '\"' || upper(service || '_' || event_type) || '\"' END",
    "timestamp_ms": "CASE WHEN shape = 3 THEN ms::VARCHAR END",
    "level": "CASE WHEN shape = 3 AND event_type = 'error' THEN '\"ERROR\"' END",
    "path": "CASE WHEN shape = 3 THEN '\"/v1/' || service || '?k=' || k || '\"' END",
    "product_id": "CASE WHEN service = 'order' THEN (100000 + id % 1000)::VARCHAR END",
    "amount": "CASE WHEN service = 'payment' AND shape IN (0, 2) THEN (1000 + k)::VARCHAR "
    "WHEN service = 'payment' AND shape = 1 THEN (1000 + k) || '.5' END",
}
_JSON = "'{' || concat_ws(',', " + ", ".join(
    f"'\"{name}\":' || ({text})" for name, text in _TEXT.items()
) + ") || '}'"

# Expected event table (``log``), bad rows (``bad``) and everything sent (``raw``).
FIXTURE = f"""
WITH base AS (
  SELECT event_id AS id, user_id, event_type,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
         1704067200000 + (epoch_us(ts) - 1704067200000000) // 1000000 AS ms
  FROM events
), shaped AS (
  SELECT *, id % 4 AS shape,
         CASE WHEN event_type IN ('signup', 'error') THEN 'auth'
              WHEN event_type = 'purchase' THEN 'payment' ELSE 'order' END AS service,
         CASE WHEN event_type <> 'error' THEN 200 WHEN k < 50 THEN 500 ELSE 404 END AS sc,
         ms + 13 * k - CASE WHEN id % 17 = 0 THEN 1500 ELSE 0 END AS broker_ms
  FROM base
), sent AS (
  SELECT s.*, c.copy, broker_ms + 100 + (7 * id) % 900 AS recv_ms,
         broker_ms + 100 + (7 * id) % 900 + (11 * id) % 400 + 5000 * c.copy AS proc_ms
  FROM shaped s JOIN (VALUES (0), (1)) c(copy) ON c.copy = 0 OR s.id % 50 = 0
), raw AS (
  SELECT *, proc_ms + (31 * id) % 90000 AS stored_ms,
         'logs.' || service AS topic, CAST(id % 3 AS INTEGER) AS part, id // 3 AS off,
         id % 101 = 0 OR id % 103 = 0 AS is_bad,
         CASE WHEN id % 101 = 0 THEN '{{"event_id":"e' WHEN id % 103 = 0 THEN ''
              ELSE {_JSON} END AS value
  FROM sent
), bad AS (
  SELECT * FROM raw WHERE is_bad
), log AS (
  SELECT id, shape, k, copy, event_type, ms AS event_ms, broker_ms, recv_ms, proc_ms, stored_ms,
    topic, part, off, value, service,
    CASE WHEN shape <> 3 THEN 'ev-' || id ELSE topic || '-' || part || '-' || off END AS event_id,
    CASE WHEN shape <> 3 THEN 'req-' || (id // 2) ELSE 'unknown' END AS request_id,
    CASE WHEN shape <> 3 THEN upper(service || '_' || event_type) ELSE 'unknown' END AS api_group,
    service || '.' || event_type AS event_name,
    CASE WHEN shape IN (0, 1) THEN CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END
         WHEN shape = 3 AND k % 10 = 9 THEN 'unknown'
         WHEN sc >= 400 THEN 'fail' ELSE 'success' END AS result,
    CASE WHEN shape = 1 THEN CASE WHEN event_type = 'error' THEN 500 ELSE 200 END
         WHEN shape = 3 AND k % 10 = 9 THEN 0 ELSE sc END AS status_code,
    CASE WHEN shape IN (0, 2) THEN CASE WHEN k % 2 = 0 THEN 'GET' ELSE 'POST' END
         ELSE '' END AS method,
    CASE WHEN shape <> 3 THEN '/v2/' || service || '/' || event_type
         ELSE '/v1/' || service || '?k=' || k END AS route_template,
    CASE WHEN shape = 3 THEN '/v1/' || service || '?k=' || k ELSE '' END AS path,
    CASE WHEN shape IN (0, 2) THEN CAST(k * 3 AS INTEGER) END AS duration_ms,
    CASE WHEN shape = 3 AND event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
    user_id,
    CASE WHEN service = 'order' THEN 'o-' || (id % 1000) END AS order_id,
    CASE WHEN service = 'payment' THEN 'p-' || (id % 1000) END AS payment_id,
    CASE WHEN shape = 1 AND event_type = 'error' THEN 'r' || (k % 7) END AS reason_code,
    CASE WHEN service = 'order' THEN CAST(100000 + id % 1000 AS INTEGER) END AS product_id,
    CASE WHEN service = 'payment' AND shape IN (0, 2) THEN CAST(1000 + k AS INTEGER) END AS amount
  FROM raw WHERE NOT is_bad
), timed AS (
  SELECT *, broker_ms // 60000 * 60000 AS minute_ms, broker_ms // 10000 * 10000 AS ten_ms,
    greatest(broker_ms - event_ms, 0) AS producer_to_kafka,
    greatest(recv_ms - broker_ms, 0) AS kafka_to_spark_ingest,
    greatest(proc_ms - recv_ms, 0) AS spark_processing,
    greatest(stored_ms - proc_ms, 0) AS spark_to_stored,
    greatest(stored_ms - broker_ms, 0) AS e2e
  FROM log
), now AS (SELECT max(broker_ms) AS now_ms FROM raw)
"""

_STAGES = ("producer_to_kafka", "kafka_to_spark_ingest", "spark_processing", "spark_to_stored", "e2e")


def _p95(*names: str) -> str:
    return ", ".join(f"quantile_disc({n}, 0.95) AS {n}_p95_ms" for n in (names or _STAGES))


def _add(name: str, sql: str) -> None:
    ORACLE[name] = FIXTURE + sql


def _recent(minutes: int, column: str = "minute_ms") -> str:
    return f"{column} >= (SELECT now_ms FROM now) - {minutes * 60000}"


_add("p_normalized_events", """
SELECT event_ms AS event_timestamp_ms, broker_ms AS kafka_received_at_ms,
  recv_ms AS spark_received_at_ms, proc_ms AS spark_processed_at_ms, request_id, event_id, service,
  api_group, event_name, result, method, route_template, path, status_code, duration_ms, level,
  user_id, order_id, payment_id, reason_code, product_id, amount, topic, part AS kafka_partition,
  off AS kafka_offset, '' AS raw_json, stored_ms AS stored_at_ms FROM log""")

_add("p13_events_with_raw_text", """
SELECT topic, part AS kafka_partition, off AS kafka_offset, value AS raw_json,
  proc_ms AS spark_processed_at_ms, stored_ms AS stored_at_ms FROM log""")

_add("p1_f1_bad_rows", """
SELECT 'json_parse_failed' AS error_type, 'value is not valid JSON' AS error_message,
  user_id::VARCHAR AS kafka_key, topic, part AS partition, off AS "offset",
  broker_ms AS kafka_received_at_ms, value AS raw_json FROM bad""")

_add("f1_split_counts_by_mode", """
SELECT topic, count(*) FILTER (WHERE NOT is_bad) AS good_strict,
  count(*) FILTER (WHERE value <> '') AS good_permissive,
  count(*) FILTER (WHERE is_bad) AS bad_strict, count(*) FILTER (WHERE value = '') AS bad_permissive
FROM raw GROUP BY topic""")

_add("f2_permissive_events", """
SELECT event_id, service, result, status_code, topic FROM log
UNION ALL
SELECT topic || '-' || part || '-' || off, 'unknown', 'unknown', 0, topic
FROM bad WHERE value <> ''""")

_ENVELOPE = """
  SELECT 'json_parse_failed' AS error_type, 'value is not valid JSON' AS error_message,
    CAST(NULL AS VARCHAR) AS service, topic || '-' || part || '-' || off AS event_id,
    CAST(NULL AS VARCHAR) AS request_id, topic AS source_topic, part AS source_partition,
    off AS source_offset, user_id::VARCHAR AS source_key, broker_ms AS created_ms,
    value AS raw_json FROM bad"""
_add("p17_bad_row_envelopes", _ENVELOPE)

_add("p20_dead_letter_messages", """
SELECT user_id::VARCHAR AS key,
  '{"error_type":"json_parse_failed","error_message":"value is not valid JSON","event_id":"'
  || topic || '-' || part || '-' || off || '","source_topic":"' || topic || '","source_partition":'
  || part || ',"source_offset":' || off || ',"source_key":"' || user_id || '","created_ms":'
  || broker_ms || ',"raw_json":"' || replace(value, '"', chr(92) || '"') || '"}' AS value
FROM bad""")

_add("p16_f3_dead_letter_table", f"""
SELECT created_ms AS kafka_received_at_ms, created_ms AS spark_processed_at_ms, service, event_id,
  request_id, source_topic, source_partition, source_offset, source_key,
  created_ms AS event_timestamp_ms, error_type, error_message, raw_json FROM ({_ENVELOPE})""")

_add("p18_failed_batch_envelopes", """
SELECT 'sink_write_failed' AS error_type, 'refused' AS error_message, service, event_id, request_id,
  topic AS source_topic, part AS source_partition, off AS source_offset, event_id AS source_key,
  broker_ms AS created_ms, value AS raw_json FROM log""")

_add("p19_failed_publish_envelopes", """
SELECT 'TimeoutError' AS error_type, 'no broker' AS error_message, service,
  CASE WHEN NOT is_bad AND shape <> 3 THEN 'ev-' || id END AS event_id,
  CASE WHEN NOT is_bad AND shape <> 3 THEN 'req-' || (id // 2) END AS request_id,
  topic AS source_topic, CAST(NULL AS INTEGER) AS source_partition,
  CAST(NULL AS BIGINT) AS source_offset,
  CASE WHEN NOT is_bad AND shape <> 3 THEN 'req-' || (id // 2) END AS source_key,
  broker_ms AS created_ms, value AS raw_json FROM raw""")

_IDENTITY = {
    "service": "service", "event_name": "event_name",
    "request_id": "CASE WHEN shape <> 3 THEN request_id END",
    "ts_ms": "CASE WHEN shape <> 3 THEN event_ms::VARCHAR END",
    "route_template": "CASE WHEN shape <> 3 THEN route_template END", "method": "method",
    "result": "CASE WHEN shape IN (0, 1) THEN result END",
    "status_code": "CASE WHEN shape IN (0, 2) OR (shape = 3 AND k % 10 <> 9) "
    "THEN status_code::VARCHAR END",
    "duration_ms": "duration_ms::VARCHAR", "user_id": "user_id::VARCHAR", "order_id": "order_id",
    "payment_id": "payment_id", "reason_code": "reason_code", "amount": "amount::VARCHAR",
    "api_group": "CASE WHEN shape <> 3 THEN api_group END",
    "timestamp_ms": "CASE WHEN shape = 3 THEN event_ms::VARCHAR END",
    "product_id": "product_id::VARCHAR",
}
_add("p21_stable_event_ids", "SELECT topic, part AS partition, off AS \"offset\", 'evt_v1_' || "
     "left(sha256(concat_ws('|', '_v:2:v1', " + ", ".join(
    f"'{name}:' || length(coalesce({sql}, '')) || ':' || coalesce({sql}, '')"
    for name, sql in _IDENTITY.items()) + ")), 32) AS stable_id FROM log")

_add("p22_p23_time_buckets", """
SELECT broker_ms // 60000 * 60000 AS minute_ms, broker_ms // 10000 * 10000 AS ten_seconds_ms,
  count(*) AS n FROM raw GROUP BY ALL""")

_add("p24_stage_latencies", "SELECT topic, part AS kafka_partition, off AS kafka_offset, "
     + ", ".join(f"{s} AS {s}_ms" for s in _STAGES) + " FROM timed")

_add("f4_complete_timelines", """
SELECT service, count(*) FILTER (WHERE event_ms IS NOT NULL AND broker_ms IS NOT NULL AND recv_ms
  IS NOT NULL AND proc_ms IS NOT NULL AND stored_ms IS NOT NULL) AS complete, count(*) AS n
FROM log GROUP BY service""")

_TRAFFIC = "count(event_id) AS total, count(*) FILTER (WHERE status_code >= 500) AS errors"
_add("f5_last_minutes", f"""
SELECT ten_ms AS bucket_ms, {_TRAFFIC} FROM timed WHERE {_recent(5, "ten_ms")} GROUP BY ten_ms""")
_add("f6_time_range", f"""
SELECT ten_ms AS bucket_ms, {_TRAFFIC} FROM timed
WHERE ten_ms BETWEEN 1704067500000 AND 1704069000000 GROUP BY ten_ms""")

_add("f7_topic_routing", """
SELECT svc AS service, CASE WHEN coalesce(svc, '') = '' THEN 'logs.unknown' ELSE 'logs.' || svc END
  AS topic, count(*) AS n
FROM (SELECT CASE WHEN k = 0 THEN '' WHEN k = 1 THEN NULL WHEN k < 10 THEN event_type
             ELSE service END AS svc FROM raw) GROUP BY ALL""")

_add("f8_error_fan_out", """
SELECT service, topic, part AS partition, off AS "offset" FROM log
UNION ALL
SELECT service, 'logs.error', part, off FROM log
WHERE event_type = 'error' AND (shape IN (0, 1) OR (shape = 2 AND k < 50)
  OR (shape = 3 AND k % 10 <> 9 AND k < 50))""")

_LATEST = """
SELECT event_id, service, broker_ms AS kafka_received_at_ms, topic, part AS kafka_partition,
  off AS kafka_offset, proc_ms AS spark_processed_at_ms, stored_ms AS stored_at_ms
FROM log QUALIFY row_number() OVER (PARTITION BY {keys}
  ORDER BY proc_ms DESC, off DESC, topic DESC, part DESC) = 1"""
_add("a15_latest_per_event", _LATEST.format(keys="service, event_id"))
_add("a15_latest_per_event_and_day",
     _LATEST.format(keys="service, event_id, broker_ms // 86400000"))
_add("a15_latest_by_position", _LATEST.format(keys="service, event_id"))
_add("a15_latest_by_position_and_day",
     _LATEST.format(keys="service, event_id, broker_ms // 86400000"))
_add("u2_distinct_keys", "SELECT DISTINCT service, event_id FROM log")

# An older-layout event has no id of its own, so its copy on the error topic is a new event.
_add("t4_rollup_raw_and_deduplicated", """
, twice AS (
  SELECT id, service, shape, event_id, status_code, broker_ms // 60000 * 60000 AS bucket_ms, topic
  FROM log
  UNION ALL
  SELECT id, service, shape, CASE WHEN shape <> 3 THEN event_id
    ELSE 'logs.error-' || part || '-' || off END, status_code, broker_ms // 60000 * 60000,
    'logs.error' FROM log WHERE event_type = 'error')
SELECT 'raw' AS side, bucket_ms, service, count(*) AS total,
  count(*) FILTER (WHERE status_code >= 500) AS errors FROM twice GROUP BY ALL
UNION ALL
SELECT 'latest', bucket_ms, service, count(*), count(*) FILTER (WHERE status_code >= 500)
FROM (SELECT DISTINCT service, event_id, status_code, bucket_ms FROM twice) GROUP BY ALL""")

_A1 = f"SELECT minute_ms AS bucket_ms, service, {_TRAFFIC} FROM timed GROUP BY ALL"
_A2 = """SELECT event_ms // 60000 * 60000 AS bucket_ms, count(*) AS created,
  count(*) FILTER (WHERE stored_ms // 60000 = event_ms // 60000) AS stored FROM log GROUP BY ALL"""
_A3 = """SELECT bucket_ms, CAST(sum(created) AS BIGINT) AS created, CAST(sum(stored) AS BIGINT)
  AS stored FROM (SELECT event_ms // 60000 * 60000 AS bucket_ms, 1 AS created, 0 AS stored FROM log
  UNION ALL SELECT stored_ms // 60000 * 60000, 0, 1 FROM log) GROUP BY bucket_ms"""
_A4 = """SELECT minute_ms AS bucket_ms,
  CAST(sum(greatest(broker_ms // 1000 - event_ms // 1000, 0)) AS BIGINT) AS sum_lag,
  count(*) AS cnt, count(*) FILTER (WHERE broker_ms // 1000 < event_ms // 1000) AS skew_cnt
  FROM timed GROUP BY ALL"""
_A6 = """SELECT broker_ms // 60000 * 60000 AS bucket_ms, 'unknown' AS service,
  'json_parse_failed' AS error_type, count(*) AS total FROM bad GROUP BY ALL"""
_A7 = f"SELECT ten_ms AS bucket_ms, {_TRAFFIC} FROM timed GROUP BY ALL"
_A8 = f"SELECT ten_ms AS bucket_ms, {_p95()} FROM timed GROUP BY ALL"
_add("a1_traffic_1m", _A1)
_add("a2_created_stored_1m", _A2)
_add("a3_u1_created_stored_backfill", _A3)
_add("u1_created_stored_by_union", _A3)
_add("a4_ingest_lag_1m", _A4)
_add("a5_stage_latency_service_1m",
     f"SELECT minute_ms AS bucket_ms, service, {_p95()} FROM timed GROUP BY ALL")
_add("a6_dlq_1m", _A6)
_add("a7_traffic_10s", _A7)
_add("a8_stage_latency_10s", _A8)
_add("a9_overall_latency_1m", f"SELECT minute_ms AS bucket_ms, {_p95()} FROM timed GROUP BY ALL")
_add("a10_a14_merged_partials", _A1)
_add("a12_rolled_up_dimensions", f"SELECT service, {_TRAFFIC} FROM log GROUP BY service")
_add("a13_newest_ingest", "SELECT service, max(broker_ms) AS max_ingest_ms FROM log GROUP BY service")
_add("st12_shared_states_traffic_1m", _A1)
_add("st12_shared_states_lag_1m", _A4)
_add("st12_shared_states_created_stored_1m", _A2)

_add("q1_eps_10s", f"SELECT bucket_ms, total / 10 AS eps FROM ({_A7})")
_add("q2_error_rate_10s", f"""
SELECT bucket_ms, CASE WHEN total = 0 THEN 0 ELSE errors / total END * 100 AS error_rate
FROM ({_A7})""")
_add("q3_e2e_p95_10s", f"SELECT bucket_ms, e2e_p95_ms AS p95_ms FROM ({_A8})")
_add("q4_stage_p95_10s", _A8)

_Q5 = f"""SELECT minute_ms AS bucket_ms, count(*) / 60 AS eps,
  count(*) FILTER (WHERE status_code >= 500) / count(*) * 100 AS error_rate_pct
  FROM timed WHERE {_recent(5)} GROUP BY ALL ORDER BY minute_ms DESC LIMIT 1"""
_Q6 = f"""SELECT minute_ms AS bucket_ms, {_p95()} FROM timed WHERE {_recent(5)}
  GROUP BY ALL ORDER BY minute_ms DESC LIMIT 1"""
_Q7 = f"""SELECT (SELECT now_ms FROM now) - max(broker_ms) AS freshness_ms FROM log
  WHERE {_recent(10, "broker_ms")}"""
_Q8 = f"""SELECT dlq / total * 100 AS dlq_rate_pct FROM
  (SELECT count(*) AS dlq FROM bad WHERE {_recent(5, "broker_ms // 60000 * 60000")}),
  (SELECT count(*) AS total FROM timed WHERE {_recent(5)})"""
_Q10 = f"SELECT minute_ms AS bucket_ms, {_p95()} FROM timed WHERE {_recent(10)} GROUP BY ALL"
_add("q5_latest_traffic", _Q5)
_add("q6_latest_stage_p95", _Q6)
_add("q7_a16_freshness", _Q7)
_add("q7_a16_freshness_from_states", _Q7)
_add("q8_a18_j2_dlq_rate", _Q8)
_add("q9_j1_health", f"""
SELECT q5.bucket_ms AS eps_bucket_ms, eps, error_rate_pct, q6.bucket_ms AS latency_bucket_ms,
  {", ".join(f"{s}_p95_ms" for s in _STAGES)}, freshness_ms, dlq_rate_pct
FROM ({_Q5}) q5, ({_Q6}) q6, ({_Q7}) q7, ({_Q8}) q8""")
_add("q10_stage_p95_1m", _Q10)
_add("q11_sink_p95_1m", f"""
SELECT bucket_ms, spark_to_stored_p95_ms AS sink_p95_ms, e2e_p95_ms FROM ({_Q10})""")
_add("q12_ingest_p95_1m", f"SELECT bucket_ms, kafka_to_spark_ingest_p95_ms FROM ({_Q10})")
_add("q13_eps_1m", f"""
SELECT minute_ms AS bucket_ms, count(*) AS total, round(count(*) / 60, 2) AS eps
FROM timed WHERE {_recent(10)} GROUP BY ALL""")
_add("q14_o3_top_services", f"""
SELECT service, quantile_disc(producer_to_kafka, 0.95) AS publish_p95_ms FROM timed
WHERE {_recent(10)} GROUP BY service ORDER BY publish_p95_ms DESC, service LIMIT 5""")
_add("q15_a17_mean_lag", f"""
SELECT CAST(sum(greatest(broker_ms // 1000 - event_ms // 1000, 0)) AS BIGINT) / count(*) * 1000
  AS lag_ms FROM timed WHERE {_recent(5)}""")
_add("q16_created_stored_ratio", f"""
SELECT bucket_ms, created, stored, CASE WHEN created = 0 THEN 0 ELSE stored / created END AS ratio
FROM ({_A2})""")
_add("q17_dlq_counts", _A6)

# --- observability and alerts -----------------------------------------------------------------
_add("f9_alerting_log_lines", r"""
, lines AS (
  SELECT id AS event_id,
    CASE event_type WHEN 'signup' THEN 'kafka' WHEN 'purchase' THEN 'spark-driver'
      WHEN 'error' THEN 'clickhouse' WHEN 'click' THEN 'grafana' ELSE 'other' END AS component,
    CASE k % 10 WHEN 0 THEN 'java.lang.OutOfMemoryError: heap' WHEN 1 THEN 'FATAL ERROR: log dir'
      WHEN 2 THEN 'Job aborted due to stage failure' WHEN 3 THEN 'Code:  241 at ' || id
      WHEN 4 THEN 'memory_limit_exceeded' WHEN 5 THEN 'DB::Exception: Memory limit exceeded'
      WHEN 6 THEN 'level=ERROR msg=x' WHEN 7 THEN 'panic: nil' WHEN 8 THEN 'outofmemoryerror'
      ELSE 'took ' || k || ' ms' END AS line
  FROM base
), patterns(component, rank, pattern) AS (VALUES
  ('kafka', 1, '(?i)OutOfMemoryError'), ('kafka', 2, '(?i)Fatal error'),
  ('spark-driver', 1, 'OutOfMemoryError'), ('spark-driver', 2, 'StreamingQueryException'),
  ('spark-driver', 3, 'Job aborted'), ('spark-driver', 4, 'Code:\s*241'),
  ('spark-driver', 5, '(?i)MEMORY_LIMIT_EXCEEDED'), ('clickhouse', 1, 'Code:\s*241'),
  ('clickhouse', 2, '(?i)Memory limit exceeded'), ('clickhouse', 3, 'DB::Exception'),
  ('grafana', 1, '(?i)level=error'), ('grafana', 2, '(?i)panic:'))
SELECT event_id, component, line, arg_min(pattern, rank) AS pattern
FROM lines JOIN patterns USING (component) WHERE regexp_matches(line, pattern) GROUP BY ALL""")

_add("j3_batches_to_recover", """
SELECT topic AS stream_name, 'event_log' AS target_table, 'q' AS query_id,
  broker_ms // 1000 // 60 AS batch_id
FROM raw GROUP BY ALL HAVING max(stored_ms) > (SELECT now_ms FROM now) - 300000""")

_LAG = """
, latest AS (SELECT topic, part, max(off) + 1 AS latest FROM raw GROUP BY ALL
), done AS (
  SELECT topic, part, max(off) + 1 AS committed FROM raw
  WHERE broker_ms <= (SELECT now_ms FROM now) - 600000 AND NOT (topic = 'logs.payment' AND part = 2)
  GROUP BY ALL
), lag AS (
  SELECT topic, part AS partition, latest, {committed} AS committed,
    CASE WHEN {committed} IS NOT NULL THEN greatest(latest - {committed}, 0) END AS lag
  FROM latest LEFT JOIN done USING (topic, part))"""
_add("j4_o4_offset_lag", _LAG.format(committed="committed") + "SELECT * FROM lag")
_add("j4_offset_lag_from_zero",
     _LAG.format(committed="coalesce(committed, 0)") + "SELECT * FROM lag")
_add("s1_j4_offset_gap", _LAG.format(committed="coalesce(committed, 0)") + """
SELECT r.topic, r.part AS partition, r.off AS "offset", r.broker_ms AS timestamp_ms
FROM raw r JOIN lag ON lag.topic = r.topic AND lag.partition = r.part WHERE r.off >= lag.committed""")
_add("a19_offset_lag_totals", _LAG.format(committed="committed") + """
SELECT topic, CAST(coalesce(sum(lag), 0) AS BIGINT) AS lag_sum, coalesce(max(lag), 0) AS lag_max,
  count(*) FILTER (WHERE lag IS NULL) AS missing_partitions FROM lag GROUP BY ROLLUP (topic)""")

_LIMITS = [
    ("eps_low", "ingest", "eps", 1.0, "<"),
    ("error_rate", "ingest", "error_rate_pct", 1.0, ">"),
    *[(f"{s}_p95", s, f"{s}_p95_ms", 60000.0, ">") for s in _STAGES],
]
_add("j5_threshold_breaches", f"""
, minutes AS (
  SELECT minute_ms AS bucket_ms, count(*) / 60 AS eps,
    count(*) FILTER (WHERE status_code >= 500) / count(*) * 100 AS error_rate_pct, {_p95()}
  FROM timed GROUP BY ALL)
""" + " UNION ALL ".join(
    f"SELECT bucket_ms, '{metric}' AS metric, '{stage}' AS stage, CAST({column} AS DOUBLE) AS value, "
    f"CAST({limit} AS DOUBLE) AS \"limit\", {column} {sign} {limit} AS breached FROM minutes"
    for metric, stage, column, limit, sign in _LIMITS))

_add("a20_batch_timing_summary", f"""
, batches AS (SELECT service, total / 1000 AS t, (errors * 10 + 5) / 1000 AS w FROM ({_A1}))
SELECT service AS stream, count(*) AS batches, round(avg(t), 6) AS mean_transform,
  round(avg(w), 6) AS mean_write, round(avg(t + w), 6) AS mean_total,
  round(max(t + w), 6) AS max_total,
  round(count(*) FILTER (WHERE t + w > 0.1) / count(*) * 100, 6) AS over_trigger_pct
FROM batches GROUP BY service""")

_add("a21_publish_rates", """
, counted AS (SELECT broker_ms // 10000 * 10000 AS bucket_ms, service, count(*) AS n FROM raw
  GROUP BY ALL)
SELECT bucket_ms, service, n, n / 10 AS rate,
  (SELECT sum(c.n) FROM counted c WHERE c.bucket_ms = counted.bucket_ms)::BIGINT / 10 AS total_rate
FROM counted WHERE service IN ('auth', 'order')""")

_add("k11_live_rows", """
, newest AS (SELECT max(ts) AS as_of FROM events)
SELECT 'event_log' AS table_name, CAST(ts::DATE AS VARCHAR) AS day, count(*) AS n
FROM events, newest WHERE as_of::DATE < ts::DATE + 3 GROUP BY ALL
UNION ALL
SELECT 'event_log_dlq', CAST(ts::DATE AS VARCHAR), count(*)
FROM events, newest WHERE as_of < ts + INTERVAL 7 DAY GROUP BY ALL""")

_READINGS = """
, per_bucket AS (SELECT service AS key, ten_ms AS at_ms, count(*) AS total FROM timed GROUP BY ALL
), readings AS (
  SELECT key, at_ms, total * count(*) OVER (PARTITION BY key) < sum(total) OVER (PARTITION BY key)
    AS breached, row_number() OVER (PARTITION BY key ORDER BY at_ms) AS rn FROM per_bucket)"""
_add("st13_sustained_breaches", _READINGS + """
, islands AS (
  SELECT *, count(*) FILTER (WHERE NOT breached) OVER (PARTITION BY key ORDER BY at_ms) AS island
  FROM readings
), aged AS (
  SELECT *, at_ms - min(at_ms) FILTER (WHERE breached) OVER (PARTITION BY key, island) AS age
  FROM islands)
SELECT key, at_ms, breached, breached AND age > 0 AND age >= 20000 AS ready FROM aged""")

# One step per reading: since = start of the current breach, fired = last alert.
_ALERTS = FIXTURE.replace("WITH base", "WITH RECURSIVE base", 1) + _READINGS + """
, walk AS (
  SELECT key, at_ms, breached, rn, CASE WHEN breached THEN at_ms END AS since,
    CAST(NULL AS BIGINT) AS fired_at, false AS ready, false AS fired
  FROM readings WHERE rn = 1
  UNION ALL
  SELECT r.key, r.at_ms, r.breached, r.rn,
    CASE WHEN r.breached THEN coalesce(w.since, r.at_ms) END,
    CASE WHEN r.breached AND w.since IS NOT NULL AND r.at_ms - w.since >= 20000
      AND (w.fired_at IS NULL OR r.at_ms - w.fired_at >= 60000) THEN r.at_ms ELSE w.fired_at END,
    r.breached AND w.since IS NOT NULL AND r.at_ms - w.since >= 20000,
    r.breached AND w.since IS NOT NULL AND r.at_ms - w.since >= 20000
      AND (w.fired_at IS NULL OR r.at_ms - w.fired_at >= 60000)
  FROM walk w JOIN readings r ON r.key = w.key AND r.rn = w.rn + 1)
SELECT key, at_ms, breached, ready, fired FROM walk"""
ORACLE["st13_st14_alerts"] = _ALERTS
ORACLE["st13_st14_streamed_alerts"] = _ALERTS

# Readings are changes, so a breach lasts until the next one. Fired once: at the end of its grace period
# or of the cooldown after the alert before, if that comes before the next reading.
_SILENT = FIXTURE.replace("WITH base", "WITH RECURSIVE base", 1) + _READINGS + """
, changes AS (
  SELECT key, at_ms, breached, lead(at_ms) OVER (PARTITION BY key ORDER BY at_ms) AS next_ms
  FROM (SELECT *, lag(breached) OVER (PARTITION BY key ORDER BY at_ms) AS before FROM readings)
  WHERE breached IS DISTINCT FROM before
), breaches AS (
  SELECT key, at_ms, coalesce(next_ms - 1, (SELECT max(at_ms) FROM changes)) AS last_ms,
    row_number() OVER (PARTITION BY key ORDER BY at_ms) AS breach
  FROM changes WHERE breached
), walk AS (
  SELECT key, breach, CASE WHEN at_ms + 20000 <= last_ms THEN at_ms + 20000 END AS due_ms,
    CASE WHEN at_ms + 20000 <= last_ms THEN at_ms + 20000 END AS fired_ms
  FROM breaches WHERE breach = 1
  UNION ALL
  SELECT key, breach, CASE WHEN next_due <= last_ms THEN next_due END,
    CASE WHEN next_due <= last_ms THEN next_due ELSE fired_ms END
  FROM (SELECT b.*, w.fired_ms, greatest(b.at_ms + 20000, coalesce(w.fired_ms + 60000, 0)) AS next_due
    FROM walk w JOIN breaches b ON b.key = w.key AND b.breach = w.breach + 1))
SELECT key, at_ms, breached, false AS ready, false AS fired, false AS silent FROM changes
UNION ALL
SELECT key, due_ms, true, true, true, true FROM walk WHERE due_ms IS NOT NULL"""
ORACLE["st13_st14_silent_alerts"] = _SILENT
ORACLE["st13_st14_streamed_silent_alerts"] = _SILENT

# Levels 0 low, 1 mid, 2 high. ``asked`` is the direction the reading asks for.
ORACLE["st15_capacity_levels"] = FIXTURE.replace("WITH base", "WITH RECURSIVE base", 1) + """
, readings AS (
  SELECT service AS key, minute_ms AS at_ms,
    CAST(sum(greatest(broker_ms // 1000 - event_ms // 1000, 0)) AS BIGINT) / count(*) * 1000 AS lag_ms,
    row_number() OVER (PARTITION BY service ORDER BY minute_ms) AS rn
  FROM timed GROUP BY service, minute_ms
), walk AS (
  SELECT key, CAST(NULL AS BIGINT) AS at_ms, CAST(NULL AS DOUBLE) AS lag_ms, CAST(0 AS BIGINT) AS rn,
    1 AS level, 0 AS ups, 0 AS downs, CAST(NULL AS BIGINT) AS changed, 0 AS asked, 'none' AS action,
    1 AS was
  FROM (SELECT DISTINCT key FROM readings)
  UNION ALL
  SELECT key, at_ms, lag_ms, rn,
    CASE WHEN action = 'switch' THEN was + asked ELSE was END, ups, downs,
    CASE WHEN action = 'switch' THEN at_ms ELSE changed END, asked, action, was
  FROM (
    SELECT *, CASE WHEN asked = 0 THEN 'keep'
        WHEN (asked > 0 AND ups < 2) OR (asked < 0 AND downs < 3) THEN 'pending'
        WHEN at_ms - changed < 180000 THEN 'cooldown' ELSE 'switch' END AS action
    FROM (
      SELECT key, at_ms, lag_ms, rn, was, changed, asked,
        CASE WHEN asked > 0 THEN ups + 1 ELSE 0 END AS ups,
        CASE WHEN asked < 0 THEN downs + 1 ELSE 0 END AS downs
      FROM (
        SELECT r.key, r.at_ms, r.lag_ms, r.rn, w.level AS was, w.ups, w.downs, w.changed,
          CASE WHEN w.level = 0 AND round_even(r.lag_ms, 0) > 640 THEN 1
               WHEN w.level = 1 AND round_even(r.lag_ms, 0) > 680 THEN 1
               WHEN w.level = 1 AND round_even(r.lag_ms, 0) < 620 THEN -1
               WHEN w.level = 2 AND round_even(r.lag_ms, 0) < 650 THEN -1 ELSE 0 END AS asked
        FROM walk w JOIN readings r ON r.key = w.key AND r.rn = w.rn + 1))))
SELECT key, at_ms, lag_ms, ['low', 'mid', 'high'][level + 1] AS level,
  ['low', 'mid', 'high'][was + asked + 1] AS wanted, action FROM walk WHERE rn > 0"""

# --- sinks and streams ------------------------------------------------------------------------
_add("k1_k10_stored_days", """
SELECT strftime(make_timestamp(broker_ms * 1000), '%Y-%m-%d') AS ingest_date, service, count(*) AS n,
  count(DISTINCT event_id) AS events FROM log GROUP BY ALL""")
_add("s6_view_range", """
, spread AS (
  SELECT broker_ms + (off % 5) * 86400000 AS ms, event_ms, service, event_id, status_code FROM log),
ranged AS (
  SELECT * FROM spread WHERE ms >= epoch_ms(TIMESTAMP '2024-01-02 00:05:00') AND ms < epoch_ms(TIMESTAMP '2024-01-03 00:20:00'))
SELECT 'traffic_1m' AS name, service, ms // 60000 * 60000 AS bucket_ms, count(event_id) AS n FROM ranged GROUP BY ALL
UNION ALL
SELECT 'traffic_10s', NULL, ms // 10000 * 10000 AS bucket_ms, count(*) FILTER (WHERE status_code >= 500) FROM ranged GROUP BY ALL
UNION ALL
SELECT 'created_stored_1m', NULL, event_ms // 60000 * 60000 AS bucket_ms, count(*) FROM spread
WHERE event_ms >= epoch_ms(TIMESTAMP '2024-01-01 00:10:00') AND event_ms < epoch_ms(TIMESTAMP '2024-01-01 00:30:00') GROUP BY ALL""")
_add("k11_tiers", """
, spread AS (
  SELECT broker_ms + (off % 5) * 86400000 AS ms, event_id, status_code FROM log)
SELECT 'traffic_1m' AS name, ms // 60000 * 60000 AS bucket_ms, count(event_id) AS total,
  count(*) FILTER (WHERE status_code >= 500) AS errors FROM spread GROUP BY ALL
UNION ALL
SELECT 'traffic_10s', ms // 10000 * 10000, count(event_id), count(*) FILTER (WHERE status_code >= 500)
FROM spread WHERE ms // 86400000 = (SELECT max(ms // 86400000) FROM spread) GROUP BY ALL""")
_add("st12_backfilled_traffic_1m", _A1)
_add("k1_k4_backfilled_dead_letters", _A6)
_add("st8_k6_guarded_replay", "SELECT service, count(*) AS n FROM log GROUP BY service")
_add("k5_st10_refused_batch", """
SELECT 'sink_write_failed' AS error_type, 'table is read-only' AS error_message, service,
  count(*) AS n FROM log GROUP BY service""")
_add("st1_streamed_events", """
SELECT event_ms AS event_timestamp_ms, broker_ms AS kafka_received_at_ms, request_id, event_id,
  service, api_group, event_name, result, method, route_template, path, status_code, duration_ms,
  level, user_id, order_id, payment_id, reason_code, product_id, amount, topic,
  part AS kafka_partition, off AS kafka_offset, '' AS raw_json FROM log""")
_add("k7_k8_batch_vitals", """
SELECT 'event_log' AS stream, 'event_log' AS table_name, 'written' AS outcome, count(*)::BIGINT AS n,
  (count(*) FILTER (WHERE broker_ms - event_ms > 500))::BIGINT AS late, min(broker_ms) AS oldest_ms,
  max(broker_ms) AS newest_ms FROM log""")
_add("k3_k4_doubled_messages", """
, once AS (SELECT DISTINCT topic, part, off FROM bad)
SELECT topic AS source_topic, 'json_parse_failed' AS error_type, count(*) AS n,
  (SELECT count(*) FROM once)::BIGINT AS rolled_up FROM once GROUP BY topic""")
_add("k2_s5_staged_database_append", """
SELECT service, count(*) AS n, min(status_code) AS least FROM log GROUP BY service""")
_add("st12_streamed_traffic_1m", _A1)
_add("st12_streamed_created_stored_1m", _A2)
_add("st12_native_traffic_10s", _A7)
_add("st2_st3_streamed_distinct_events", "SELECT DISTINCT service, event_id FROM log")
_add("k3_k4_s4_streamed_dead_letters", """
SELECT topic || '-' || part || '-' || off AS event_id, topic AS source_topic,
  part AS source_partition, off AS source_offset, user_id::VARCHAR AS source_key,
  broker_ms AS event_timestamp_ms, 'json_parse_failed' AS error_type, value AS raw_json FROM bad""")


def _within(keys: str, rows: str = "timed") -> str:
    """Each sketch answer is expected to lie within the error of its rank."""
    return " UNION ALL ".join(
        f"SELECT {keys} '{s}' AS stage, count(*) AS n, true AS \"within\" FROM {rows} GROUP BY ALL"
        for s in _STAGES
    )


_add("a5_stage_latency_service_1m_sketch", _within("minute_ms AS bucket_ms, service,"))
for _name in ("a8_stage_latency_10s_sketch", "q4_stage_p95_10s_sketch", "st12_streamed_stage_p95_sketch"):
    _add(_name, _within("ten_ms AS bucket_ms,"))
_add("a11_merged_sketches", _within(""))
_add("q10_stage_p95_1m_sketch", _within("minute_ms AS bucket_ms,", f"(SELECT * FROM timed WHERE {_recent(10)})"))
ORACLE["st12_rollup_switched_off_and_on"] = ORACLE["a7_traffic_10s"]
ORACLE["k4_replayed_dead_letters"] = ORACLE["k3_k4_s4_streamed_dead_letters"]
_add("f1_strict_hostile_texts", """
SELECT CAST(0 AS BIGINT) AS kind, count(*) AS whole, 2 * count(*) AS narrow FROM events WHERE event_id % 6 = 0""")
_add("st3_watermark_with_bad_clocks", "SELECT DISTINCT 'ev-' || id AS event_id FROM raw")
_add("k11_expired_folders", """
, dated AS (SELECT ts, CAST(ts AS DATE) AS day FROM events),
newest AS (SELECT max(day) AS as_of FROM dated),
keep(table_name, days, whole) AS (VALUES ('event_log', 3, true), ('event_log_dlq', 7, false),
  ('stream_batch_guard', 30, false), ('traffic_1m', 7, true), ('created_stored_1m', 7, true),
  ('lag_1m', 7, true), ('latency_service_1m', 7, true), ('traffic_10s', 1, true),
  ('latency_stage_10s', 1, true), ('arrival_1m', 7, true), ('dlq_1m', 8, true))
SELECT DISTINCT table_name, CAST(day AS VARCHAR) AS day FROM dated, newest, keep
WHERE CASE WHEN whole THEN as_of < day + CAST(days AS INTEGER)
  ELSE CAST(as_of AS TIMESTAMP) < CAST(ts AS TIMESTAMP) + to_days(CAST(days AS INTEGER)) END""")
