"""Parsed events to the wide event table."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from logpulse.functions.ids import record_id
from logpulse.schema import EVENT_FIELDS, EVENT_LOG_COLUMNS

# Epoch milliseconds outside this range do not fit a timestamp: such a time is no time at all,
# and counts as missing.
_MS_LIMIT = 9_223_372_036_854_775


def fitting_ms(ms: str) -> str:
    """SQL for epoch milliseconds that fit a timestamp, else NULL."""
    return f"if({ms} BETWEEN -{_MS_LIMIT}L AND {_MS_LIMIT}L, {ms}, NULL)"


def timestamp_of_ms(*candidates: str) -> str:
    """The first of the times given that is known and fits a timestamp."""
    return f"timestamp_millis(coalesce({', '.join(map(fitting_ms, candidates))}))"


# One SQL rule per stored column. ``json`` is the parsed payload.
RULES: dict[str, str] = {
    "event_timestamp": timestamp_of_ms(
        "json.ts_ms", "json.timestamp_ms", "unix_millis(kafka_received_at)"
    ),
    "kafka_received_at": "kafka_received_at",
    "spark_received_at": "spark_received_at",
    "spark_processed_at": "CAST(NULL AS TIMESTAMP)",  # stamped by the sink
    "request_id": "coalesce(json.request_id, 'unknown')",
    "event_id": f"coalesce(json.event_id, {record_id()}, 'unknown')",
    "service": "coalesce(json.service, 'unknown')",
    "api_group": "coalesce(json.api_group, 'unknown')",
    "event_name": "coalesce(json.event_name, 'unknown')",
    "result": """coalesce(json.result,
        CASE WHEN json.status_code >= 400 THEN 'fail'
             WHEN json.status_code < 400 THEN 'success' END,
        'unknown')""",
    "method": "coalesce(json.method, '')",
    "route_template": "coalesce(json.route_template, json.path, '')",
    "path": "coalesce(json.path, '')",
    "status_code": """coalesce(json.status_code,
        CASE json.result WHEN 'fail' THEN 500 WHEN 'success' THEN 200 END,
        0)""",
    "duration_ms": "json.duration_ms",
    "level": "coalesce(json.level, 'INFO')",
    "user_id": "json.user_id",
    "order_id": "json.order_id",
    "payment_id": "json.payment_id",
    "reason_code": "json.reason_code",
    "product_id": "json.product_id",
    "amount": "json.amount",
    "topic": "topic",
    "kafka_partition": "CAST(partition AS INT)",
    "kafka_offset": "CAST(offset AS BIGINT)",
    "raw_json": "''",
}

assert tuple(RULES) == EVENT_LOG_COLUMNS


def payload_fields(columns: Iterable[str], rules: dict[str, str] = RULES) -> list[str]:
    """Payload fields the given columns are made of: all a narrow query has to parse."""
    used = {f for c in columns if c in rules for f in re.findall(r"json\.(\w+)", rules[c])}
    return [f for f in EVENT_FIELDS if f in used] or [EVENT_FIELDS[0]]


def normalize_events(
    good: DataFrame,
    *,
    store_raw_json: bool = False,
    columns: Sequence[str] = EVENT_LOG_COLUMNS,
    overrides: dict[str, str] | None = None,
) -> DataFrame:
    """Project events onto the table contract: defaults, inferences, fallbacks.

    ``columns`` narrows the projection; ``overrides`` replaces or adds rules, for replays that
    bring their own stamps.
    """
    rules = RULES | ({"raw_json": "raw_json"} if store_raw_json else {}) | (overrides or {})
    wanted = list(columns) + [c for c in (overrides or {}) if c not in columns]
    return good.selectExpr(*[f"{rules[name]} AS {name}" for name in wanted])
