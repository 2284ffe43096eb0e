"""The rollups kept over the event table and the dead-letter table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logpulse.functions.latency import STAGES, complete_timeline, stage_ms
from logpulse.functions.timebuckets import bucket_of, lag_seconds
from logpulse.plans.rollups import Measure, Rollup, SharedStates

INGEST, EVENT = "kafka_received_at", "event_timestamp"
ERROR_STATUS = "status_code >= 500"

_total = Measure("total", "count", "event_id")
_errors = Measure("errors", "count", "event_id", ERROR_STATUS)
_stages = tuple(Measure(f"{stage}_ms", "quantile", stage_ms(stage)) for stage in STAGES)
_lag = lag_seconds(EVENT, INGEST)

TRAFFIC_1M = Rollup(
    "traffic_1m", INGEST, 60, (_total, _errors), dims=(("service", "service"),)
)
CREATED_STORED_1M = Rollup(
    "created_stored_1m",
    EVENT,
    60,
    (
        Measure("created", "count"),
        # Stored within the minute the event was created in.
        Measure(
            "stored", "count", where=f"unix_seconds(stored_at) div 60 = unix_seconds({EVENT}) div 60"
        ),
    ),
    where=f"{EVENT} IS NOT NULL",
)
LAG_1M = Rollup(
    "lag_1m",
    INGEST,
    60,
    (
        Measure("sum_lag", "sum", f"greatest({_lag}, 0L)"),
        Measure("cnt", "count"),
        Measure("skew_cnt", "count", where=f"{_lag} < 0"),
    ),
    where=f"{EVENT} IS NOT NULL AND {INGEST} IS NOT NULL",
)
LATENCY_1M = Rollup(
    "latency_service_1m",
    INGEST,
    60,
    (*_stages, Measure("max_ingest", "max", INGEST)),
    dims=(("service", "service"),),
    where=complete_timeline(),
)
DLQ_1M = Rollup(
    "dlq_1m",
    INGEST,
    60,
    (Measure("total", "count"),),
    dims=(
        ("service", "coalesce(service, 'unknown')"),
        ("error_type", "coalesce(error_type, 'unknown')"),
    ),
    keep_days=8,
)
#: When the newest event of a minute arrived: freshness without a scan of the event table.
ARRIVAL_1M = Rollup("arrival_1m", INGEST, 60, (Measure("newest", "max", INGEST),))
TRAFFIC_10S = Rollup("traffic_10s", INGEST, 10, (_total, _errors), keep_days=1)
LATENCY_10S = Rollup(
    "latency_stage_10s", INGEST, 10, _stages, where=complete_timeline(), keep_days=1
)

EVENT_ROLLUPS = (
    TRAFFIC_1M, CREATED_STORED_1M, LAG_1M, LATENCY_1M, ARRIVAL_1M, TRAFFIC_10S, LATENCY_10S,
)
DLQ_ROLLUPS = (DLQ_1M,)
ROLLUPS = {r.name: r for r in (*EVENT_ROLLUPS, *DLQ_ROLLUPS)}

EVENT_STATES = SharedStates(EVENT_ROLLUPS)


def created_stored_backfill(events: DataFrame) -> DataFrame:
    """Created per event minute next to stored per *stored* minute, for past data.

    A full outer join by union: each event contributes one row to each side. Written as a
    two-element explode so that the events are read once.
    """

    def side(at: str, created: int, stored: int):
        return F.struct(
            bucket_of(at, 60).alias("bucket"),
            F.lit(created).alias("created"),
            F.lit(stored).alias("stored"),
        )

    return (
        events.select(F.inline(F.array(side(EVENT, 1, 0), side("stored_at", 0, 1))))
        .where("bucket IS NOT NULL")
        .groupBy("bucket")
        .agg(F.sum("created").alias("created"), F.sum("stored").alias("stored"))
    )


def created_stored_by_union(events: DataFrame) -> DataFrame:
    """The same as a plain UNION ALL, for two separately stored inputs."""
    created = (
        events.where(f"{EVENT} IS NOT NULL")
        .groupBy(bucket_of(EVENT, 60).alias("bucket"))
        .agg(F.count("*").alias("created"))
        .withColumn("stored", F.lit(0).cast("bigint"))
    )
    stored = (
        events.where("stored_at IS NOT NULL")
        .groupBy(bucket_of("stored_at", 60).alias("bucket"))
        .agg(F.count("*").alias("stored"))
        .withColumn("created", F.lit(0).cast("bigint"))
    )
    return (
        created.unionByName(stored)
        .groupBy("bucket")
        .agg(F.sum("created").alias("created"), F.sum("stored").alias("stored"))
    )
