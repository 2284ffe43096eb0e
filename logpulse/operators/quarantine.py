"""Dead letters: envelopes out of failed rows, table rows out of envelopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logpulse.functions.ids import record_id
from logpulse.operators.dedup import drop_repeats
from logpulse.operators.normalize import timestamp_of_ms
from logpulse.operators.parse import decode, json_column
from logpulse.schema import DLQ_ENVELOPE, DLQ_ENVELOPE_COLUMNS, EVENT_LOG_DLQ_COLUMNS

SINK_FAILURE_TYPE = "sink_write_failed"


def _envelope(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Envelope columns in order; a rule left out is a NULL of the declared type."""
    kinds = dict(part.split() for part in DLQ_ENVELOPE.split(","))
    return df.selectExpr(
        *[f"CAST({rules.get(c, 'NULL')} AS {kinds[c]}) AS {c}" for c in DLQ_ENVELOPE_COLUMNS]
    )


_BAD_ROW = {
    "error_type": "coalesce(error_type, 'unknown')",
    "error_message": "coalesce(error_message, '')",
    "event_id": f"coalesce({record_id()}, sha2(raw_json, 256), 'unknown')",
    "source_topic": "topic",
    "source_partition": "partition",
    "source_offset": "offset",
    "source_key": "kafka_key",
    "created_ms": "unix_millis(kafka_received_at)",
    "raw_json": "raw_json",
}


def envelope_bad_rows(bad: DataFrame) -> DataFrame:
    """Envelopes for rows that failed parsing. Their service and request are not known."""
    return _envelope(bad, _BAD_ROW)


def envelope_failed_batch(
    batch: DataFrame,
    error: str,
    *,
    error_type: str = SINK_FAILURE_TYPE,
    message_limit: int | None = None,
) -> DataFrame:
    """Envelopes for a batch a table refused. Works on any schema: what is missing is NULL.

    ``message_limit`` cuts the error message to so many characters, for topics that bound
    the size of a message.
    """
    have = set(batch.columns)

    def pick(name: str) -> str:
        return name if name in have else "NULL"

    now = "unix_millis(current_timestamp())"
    whole_row = f"to_json(struct({', '.join(f'`{c}`' for c in batch.columns)}))"
    labelled = batch.withColumns(
        {
            "_error_type": F.lit(error_type),
            "_error_message": F.lit((error or "")[:message_limit]),
        }
    )
    return _envelope(
        labelled,
        {
            "error_type": "_error_type",
            "error_message": "_error_message",
            "service": pick("service"),
            "event_id": pick("event_id"),
            "request_id": pick("request_id"),
            "source_topic": pick("topic"),
            "source_partition": pick("kafka_partition"),
            "source_offset": pick("kafka_offset"),
            "source_key": f"coalesce({pick('source_key')}, {pick('event_id')})",
            "created_ms": (
                f"coalesce(unix_millis(kafka_received_at), {now})"
                if "kafka_received_at" in have
                else now
            ),
            "raw_json": "raw_json" if "raw_json" in have else whole_row,
        },
    )


def envelope_failed_publish(failed: DataFrame) -> DataFrame:
    """Envelopes for events a producer could not send, keyed by request, else by event.

    ``failed`` has ``service, raw_json, error_type, error_message, topic, failed_at``. The ids
    are salvaged from the text when it still parses.
    """
    ids = failed.withColumns(
        {
            "_event_id": F.get_json_object("raw_json", "$.event_id"),
            "_request_id": F.get_json_object("raw_json", "$.request_id"),
        }
    )
    return _envelope(
        ids,
        {
            "error_type": "error_type",
            "error_message": "error_message",
            "service": "service",
            "event_id": "_event_id",
            "request_id": "_request_id",
            "source_topic": "topic",
            "source_key": "coalesce(_request_id, _event_id)",
            "created_ms": "unix_millis(failed_at)",
            "raw_json": "raw_json",
        },
    )


def to_messages(envelopes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Envelopes as topic rows: key for partitioning, value as JSON of the ordered columns."""
    return envelopes.select(
        F.coalesce("source_key", "event_id").alias("key"),
        F.to_json(F.struct(*DLQ_ENVELOPE_COLUMNS)).alias("value"),
        *keep,
    )


def dead_letter_rows(bad: DataFrame) -> DataFrame:
    """Bad rows straight to the dead-letter table, for backfills: no topic in between.

    They are filed under the time the broker received them.
    """
    rows = _envelope(bad, _BAD_ROW).withColumns(
        {
            "kafka_received_at": F.timestamp_millis("created_ms"),
            "event_timestamp": F.timestamp_millis("created_ms"),
            "spark_processed_at": F.current_timestamp(),
        }
    )
    return rows.select(*EVENT_LOG_DLQ_COLUMNS)


#: What a dead letter is about: the row it came from and what went wrong with it. A message
#: that does not say where its row came from is only ever itself.
MESSAGE_ID = """if(json.source_topic IS NULL OR json.source_partition IS NULL OR json.source_offset IS NULL,
    concat_ws('/', 'message', topic, partition, offset),
    concat_ws('/', 'source', json.source_topic, json.source_partition, json.source_offset, json.error_type))"""


def parse_dlq(
    raw: DataFrame, *, processed_at: Column | None = None, once_within: str | None = None
) -> DataFrame:
    """Dead-letter topic rows to the dead-letter table.

    ``once_within`` keeps one message per failed row: a producer that is replayed sends its
    messages again, under offsets of their own. In a stream, repeats that far apart in broker
    time are recognised (state in the state store), and messages older than that behind the newest
    are dropped, so it must exceed how far partitions of the topic may be read apart; in a batch
    all are recognised.

    Whatever the envelope leaves out comes from the message that carried it. A message that
    is no envelope is stored as well, with its text and an unknown error type: there is no
    later place to catch it. Only messages without any text are left out.
    """
    parsed = (
        decode(raw)
        .select("*", json_column("raw_json", DLQ_ENVELOPE).alias("json"))
        .where("raw_json IS NOT NULL")
        .withColumn(
            "spark_processed_at", F.current_timestamp() if processed_at is None else processed_at
        )
    )
    rules = {
        "kafka_received_at": "kafka_received_at",
        "spark_processed_at": "spark_processed_at",
        "service": "json.service",
        "event_id": "json.event_id",
        "request_id": "json.request_id",
        "source_topic": "coalesce(json.source_topic, topic)",
        "source_partition": "CAST(coalesce(json.source_partition, partition) AS INT)",
        "source_offset": "CAST(coalesce(json.source_offset, offset) AS BIGINT)",
        "source_key": "coalesce(json.source_key, kafka_key)",
        "event_timestamp": timestamp_of_ms("json.created_ms"),
        "error_type": "coalesce(json.error_type, 'unknown')",
        "error_message": "coalesce(json.error_message, '')",
        "raw_json": "coalesce(json.raw_json, raw_json)",
    }
    if once_within:
        # Of repeats within a frame the first by broker coordinates is kept, under their names.
        names = {"partition": "kafka_partition", "offset": "kafka_offset"}
        named = parsed.withColumn("message_id", F.expr(MESSAGE_ID)).withColumnsRenamed(names)
        parsed = drop_repeats(named, ["message_id"], watermark=once_within).withColumnsRenamed(
            {new: old for old, new in names.items()}
        )
    return parsed.selectExpr(*[f"{rules[c]} AS {c}" for c in EVENT_LOG_DLQ_COLUMNS])
