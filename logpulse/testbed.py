"""Log-domain rows computed from the ``events`` table.

A pure row-wise rule: every row of ``events`` becomes one broker row (two where a delivery is
repeated), so the frame grows with the table and can be read as a batch or as a stream. The
rule covers every payload generation, malformed and empty values, clock skew and repeats, with
integer arithmetic only so that another engine can compute the expected results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logpulse.operators.normalize import normalize_events, payload_fields
from logpulse.operators.parse import good_events, parse_events, split_events
from logpulse.operators.quarantine import envelope_bad_rows, parse_dlq, to_messages
from logpulse.schema import EVENT_LOG_COLUMNS

EVENTS_DDL = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
    "props STRING"
)
ORIGIN_US = 1_704_067_200_000_000  # 2024-01-01T00:00:00Z
STAMPS = ("recv_ms", "proc_ms", "stored_ms")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    # A glob, because the file source wants a folder or a pattern, never a single file.
    reader = spark.readStream.schema(EVENTS_DDL)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.parquet(f"{sf_dir}/events.parquet*")


def dealt(rows: DataFrame) -> DataFrame:
    """``events`` rows over all cores, before texts are made of them.

    A file is read by at most as many tasks as it has row groups, which may be a million rows
    each; the short rows are cheap to move and their texts are not cheap to write and parse.
    """
    tasks = max(24, 3 * rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(tasks, "event_id")


def log_rows(rows: DataFrame, *, repeats: bool = True) -> DataFrame:
    """``events`` rows with the log-domain columns the payload is made of."""
    ms = (
        f"{ORIGIN_US // 1000}L + (unix_micros(CAST(ts AS TIMESTAMP)) - {ORIGIN_US}L) div 1000000"
    )
    base = (
        rows.selectExpr(
            "event_id AS id",
            "user_id",
            "event_type",
            # Generator output: read once per row, and not copied into filters on broker times.
            "explode(array(CAST(get_json_object(props, '$.k') AS BIGINT))) AS k",
            f"{ms} AS ms",
        )
        .withColumns(
            {
                "service": F.expr(
                    "CASE WHEN event_type IN ('signup', 'error') THEN 'auth' "
                    "WHEN event_type = 'purchase' THEN 'payment' ELSE 'order' END"
                ),
                "sc": F.expr(
                    "CASE WHEN event_type <> 'error' THEN 200 WHEN k < 50 THEN 500 ELSE 404 END"
                ),
                "shape": F.expr("id % 4"),
                "broker_ms": F.expr("ms + 13 * k - if(id % 17 = 0, 1500, 0)"),
            }
        )
        .withColumn("recv_ms", F.expr("broker_ms + 100 + (7 * id) % 900"))
        .withColumn("proc_ms", F.expr("recv_ms + (11 * id) % 400"))
        .withColumn("stored_ms", F.expr("proc_ms + (31 * id) % 90000"))
    )
    if not repeats:
        return base.withColumn("copy", F.lit(0))
    copies = F.expr("explode(sequence(0, if(id % 50 = 0, 1, 0)))")
    return base.select("*", copies.alias("copy")).withColumns(
        {
            "proc_ms": F.expr("proc_ms + 5000 * copy"),
            "stored_ms": F.expr("stored_ms + 5000 * copy"),
        }
    )


# Payload fields by generation: 0 complete, 1 domain event, 2 HTTP event, 3 older layout.
_PAYLOAD = {
    "event_id": "if(shape <> 3, concat('ev-', id), NULL)",
    "event_name": "concat(service, '.', event_type)",
    "ts_ms": "if(shape <> 3, ms, NULL)",
    "service": "service",
    "request_id": "if(shape <> 3, concat('req-', id div 2), NULL)",
    "method": "if(shape IN (0, 2), if(k % 2 = 0, 'GET', 'POST'), NULL)",
    "route_template": "if(shape <> 3, concat('/v2/', service, '/', event_type), NULL)",
    "status_code": "if(shape IN (0, 2) OR (shape = 3 AND k % 10 <> 9), sc, NULL)",
    "duration_ms": "if(shape IN (0, 2), k * 3, NULL)",
    "result": "if(shape IN (0, 1), if(event_type = 'error', 'fail', 'success'), NULL)",
    "user_id": "user_id",
    "order_id": "if(service = 'order', concat('o-', id % 1000), NULL)",
    "payment_id": "if(service = 'payment', concat('p-', id % 1000), NULL)",
    "reason_code": "if(shape = 1 AND event_type = 'error', concat('r', k % 7), NULL)",
    "api_group": "if(shape <> 3, upper(concat(service, '_', event_type)), NULL)",
    "timestamp_ms": "if(shape = 3, ms, NULL)",
    "level": "if(shape = 3 AND event_type = 'error', 'ERROR', NULL)",
    "path": "if(shape = 3, concat('/v1/', service, '?k=', k), NULL)",
    "product_id": "if(service = 'order', 100000 + id % 1000, NULL)",
}
# Amounts are whole in HTTP events and fractional in domain events, as producers do it.
_AMOUNT = (
    "CASE WHEN service <> 'payment' OR shape = 3 THEN '' "
    "WHEN shape = 1 THEN concat(',\"amount\":', 1000 + k, '.5') "
    "ELSE concat(',\"amount\":', 1000 + k) END"
)


def broker_rows(rows: DataFrame, *, repeats: bool = True, error_copies: bool = False):
    """Broker rows (``schema.BROKER_ROW``) plus the stamps a replay brings along.

    ``error_copies`` delivers failed events a second time on the error topic.
    """
    base = log_rows(dealt(rows), repeats=repeats)
    fields = ", ".join(f"'{name}', {rule}" for name, rule in _PAYLOAD.items())
    full = base.withColumn("_json", F.expr(f"to_json(named_struct({fields}))"))
    value = (
        "CASE WHEN id % 101 = 0 THEN '{\"event_id\":\"e' WHEN id % 103 = 0 THEN '' "
        f"ELSE concat(left(_json, length(_json) - 1), {_AMOUNT}, '}}') END"
    )
    topic = F.expr("concat('logs.', service)")
    if error_copies:
        topic = F.explode(
            F.expr(
                "if(event_type = 'error', array(concat('logs.', service), 'logs.error'), "
                "array(concat('logs.', service)))"
            )
        )
    return full.select(
        F.expr("CAST(CAST(user_id AS STRING) AS BINARY)").alias("key"),
        F.expr(f"CAST({value} AS BINARY)").alias("value"),
        topic.alias("topic"),
        F.expr("CAST(id % 3 AS INT)").alias("partition"),
        F.expr("id div 3").alias("offset"),
        F.expr("timestamp_millis(broker_ms)").alias("timestamp"),
        *STAMPS,
    )


REPLAYED = {
    "spark_processed_at": "timestamp_millis(proc_ms)",
    "stored_at": "timestamp_millis(stored_ms)",
}


def replay_parse(raw: DataFrame, fields=None, mode: str = "strict") -> DataFrame:
    received_at = F.expr("timestamp_millis(recv_ms)")
    return parse_events(raw, mode=mode, received_at=received_at, fields=fields, keep=STAMPS)


def event_log(
    raw: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    mode: str = "strict",
    store_raw_json: bool = False,
) -> DataFrame:
    """The event table, with the stamps of the replay instead of the wall clock's.

    ``columns`` names the columns wanted; only the payload fields behind them are parsed.
    """
    columns = EVENT_LOG_COLUMNS if columns is None else columns
    good = good_events(replay_parse(raw, payload_fields(columns), mode))
    log = normalize_events(
        good, columns=columns, overrides=REPLAYED, store_raw_json=store_raw_json
    )
    return log


def dead_letters(raw: DataFrame, *, mode: str = "strict") -> DataFrame:
    """The dead-letter table: bad rows through the envelope, the topic and back."""
    _, bad = split_events(replay_parse(raw, (), mode))
    topic = to_messages(envelope_bad_rows(bad), keep=["created_ms"])
    # The topic adds its own coordinates; the receive time is the one the bad row had.
    delivered = topic.selectExpr(
        "CAST(key AS BINARY) AS key",
        "CAST(value AS BINARY) AS value",
        "'logs.dlq' AS topic",
        "0 AS partition",
        "CAST(NULL AS BIGINT) AS offset",
        "timestamp_millis(created_ms) AS timestamp",
    )
    return parse_dlq(delivered, processed_at=F.col("kafka_received_at"))
