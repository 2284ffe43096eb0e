"""Latency of each stage an event passes, from the five timestamps it carries."""

from __future__ import annotations

# stage -> (from, to)
STAGES: dict[str, tuple[str, str]] = {
    "producer_to_kafka": ("event_timestamp", "kafka_received_at"),
    "kafka_to_spark_ingest": ("kafka_received_at", "spark_received_at"),
    "spark_processing": ("spark_received_at", "spark_processed_at"),
    "spark_to_stored": ("spark_processed_at", "stored_at"),
    "e2e": ("kafka_received_at", "stored_at"),
}

TIMELINE = (
    "event_timestamp",
    "kafka_received_at",
    "spark_received_at",
    "spark_processed_at",
    "stored_at",
)


def stage_ms(stage: str) -> str:
    """SQL for the millisecond latency of a stage; clock skew never makes it negative."""
    start, end = STAGES[stage]
    ms = f"unix_millis({end}) - unix_millis({start})"
    return f"if({ms} < 0, 0L, {ms})"  # NULL stays NULL, which greatest() would not do


def complete_timeline() -> str:
    """SQL predicate: all five timestamps are present."""
    return " AND ".join(f"{ts} IS NOT NULL" for ts in TIMELINE)
