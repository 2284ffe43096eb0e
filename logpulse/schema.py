"""Column contracts. Everything is declared; nothing is inferred from data."""

from __future__ import annotations


def names(ddl: str) -> tuple[str, ...]:
    """Column names of a DDL string, in order."""
    return tuple(part.split()[0] for part in ddl.split(","))


# Row shape of a broker topic (real or file stand-in).
BROKER_ROW = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)

# --- Fixed values: payload and table layouts that other systems rely on. -------------------
# Event payload: current fields first, then the older generation's fields.
EVENT_PAYLOAD = (
    "event_id STRING, event_name STRING, ts_ms BIGINT, service STRING, request_id STRING, "
    "method STRING, route_template STRING, status_code INT, duration_ms INT, result STRING, "
    "user_id BIGINT, order_id STRING, payment_id STRING, reason_code STRING, api_group STRING, "
    "amount INT, "
    "timestamp_ms BIGINT, level STRING, path STRING, product_id INT"
)

# Wide event table, as delivered to a sink.
EVENT_LOG = (
    "event_timestamp TIMESTAMP, kafka_received_at TIMESTAMP, spark_received_at TIMESTAMP, "
    "spark_processed_at TIMESTAMP, "
    "request_id STRING, event_id STRING, "
    "service STRING, api_group STRING, event_name STRING, result STRING, "
    "method STRING, route_template STRING, path STRING, status_code INT, duration_ms INT, "
    "level STRING, "
    "user_id BIGINT, order_id STRING, payment_id STRING, reason_code STRING, product_id INT, "
    "amount INT, "
    "topic STRING, kafka_partition INT, kafka_offset BIGINT, "
    "raw_json STRING"
)

# Dead-letter envelope, the JSON value of a dead-letter message.
DLQ_ENVELOPE = (
    "error_type STRING, error_message STRING, service STRING, event_id STRING, "
    "request_id STRING, source_topic STRING, source_partition INT, source_offset BIGINT, "
    "source_key STRING, created_ms BIGINT, raw_json STRING"
)

# Dead-letter table.
EVENT_LOG_DLQ = (
    "kafka_received_at TIMESTAMP, spark_processed_at TIMESTAMP, service STRING, "
    "event_id STRING, request_id STRING, source_topic STRING, source_partition INT, "
    "source_offset BIGINT, source_key STRING, event_timestamp TIMESTAMP, error_type STRING, "
    "error_message STRING, raw_json STRING"
)

# Log of delivered micro-batches.
BATCH_GUARD = (
    "stream_name STRING, target_table STRING, query_id STRING, batch_id BIGINT, "
    "committed_at TIMESTAMP"
)
# --------------------------------------------------------------------------------------------

STORED_AT = "stored_at"  # stamped by the sink, so not part of EVENT_LOG

EVENT_FIELDS = names(EVENT_PAYLOAD)
EVENT_LOG_COLUMNS = names(EVENT_LOG)
DLQ_ENVELOPE_COLUMNS = names(DLQ_ENVELOPE)
EVENT_LOG_DLQ_COLUMNS = names(EVENT_LOG_DLQ)


def only(ddl: str, keep) -> str:
    """``ddl`` reduced to the columns in ``keep`` (order unchanged)."""
    keep = set(keep)
    return ", ".join(p.strip() for p in ddl.split(",") if p.split()[0] in keep)
