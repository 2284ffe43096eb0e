"""Column-level building blocks (built-in Spark expressions only)."""

from logpulse.functions.ids import record_id, stable_event_id
from logpulse.functions.latency import STAGES, complete_timeline, stage_ms
from logpulse.functions.quantiles import (
    exact_quantiles,
    sketch_quantile,
)
from logpulse.functions.timebuckets import bucket_of, lag_seconds, to_millis

__all__ = [
    "STAGES",
    "bucket_of",
    "complete_timeline",
    "exact_quantiles",
    "lag_seconds",
    "record_id",
    "sketch_quantile",
    "stable_event_id",
    "stage_ms",
    "to_millis",
]
