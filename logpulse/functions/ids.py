"""Record identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

RULE_VERSION = "v1"

# The fields that make up an event's content identity, in hashing order.
IDENTITY_FIELDS = (
    "service", "event_name", "request_id", "ts_ms", "route_template", "method", "result",
    "status_code", "duration_ms", "user_id", "order_id", "payment_id", "reason_code", "amount",
    "api_group", "timestamp_ms", "product_id",
)


def record_id(topic: str = "topic", partition: str = "partition", offset: str = "offset") -> str:
    """SQL for ``topic-partition-offset``; NULL unless all three are known.

    ``concat`` (unlike ``concat_ws``) is NULL as soon as one part is.
    """
    return f"concat({topic}, '-', {partition}, '-', {offset})"


def _as_text(name: str, schema: T.StructType) -> Column:
    if name not in schema.names:
        return F.lit("")
    value, kind = F.col(name), schema[name].dataType
    if isinstance(kind, T.BooleanType):
        text = F.when(value, "1").when(~value, "0")
    elif isinstance(kind, T.FloatType | T.DoubleType):
        # 12.0 and 12 are the same amount.
        text = F.when(value == F.floor(value), F.floor(value).cast("string")).otherwise(
            value.cast("string")
        )
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(""))


def stable_event_id(schema: T.StructType) -> Column:
    """Content-derived id: equal contents give equal ids whatever the delivery.

    The canonical text is ``name:length:value`` per field joined by pipes, so no two different
    contents share one; fields absent from ``schema`` count as empty.
    """
    parts = [F.lit(f"_v:{len(RULE_VERSION)}:{RULE_VERSION}")]
    for name in IDENTITY_FIELDS:
        text = _as_text(name, schema)
        parts.append(F.concat(F.lit(f"{name}:"), F.char_length(text), F.lit(":"), text))
    digest = F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 32)
    return F.concat(F.lit(f"evt_{RULE_VERSION}_"), digest)
