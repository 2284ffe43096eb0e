"""Answers served from rollup states.

``as_of`` is always a parameter (a timestamp column, usually a literal or a scalar subquery):
no query reads the clock by itself, so each can be asked about the past. Filters on ``bucket``
are applied before states are merged, so they reach the partitions of a stored rollup.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logpulse.functions.latency import STAGES, complete_timeline, stage_ms
from logpulse.functions.quantiles import exact_quantiles
from logpulse.functions.timebuckets import bucket_of
from logpulse.plans.catalog import (
    CREATED_STORED_1M,
    DLQ_1M,
    LAG_1M,
    LATENCY_10S,
    LATENCY_1M,
    TRAFFIC_10S,
    TRAFFIC_1M,
)
from logpulse.plans.rollups import Rollup

P95_COLUMNS = [f"{stage}_p95_ms" for stage in STAGES]
EPOCH = "timestamp_seconds(0)"


# --- time filters ---------------------------------------------------------------------------
def last_minutes(states: DataFrame, as_of: Column, minutes: int, at: str = "bucket") -> DataFrame:
    """Rows of the ``minutes`` before ``as_of``."""
    return states.where(F.col(at) >= as_of - F.make_dt_interval(mins=F.lit(minutes)))


def between(states: DataFrame, start: Column, end: Column, at: str = "bucket") -> DataFrame:
    """Rows of a dashboard's time range, both ends included."""
    return states.where(F.col(at).between(start, end))


def or_zero(ratio: Column) -> Column:
    return F.coalesce(ratio, F.lit(0.0))


def percent(part: str, whole: str) -> Column:
    return or_zero(F.try_divide(F.col(part), F.col(whole)) * 100)


# --- per bucket -----------------------------------------------------------------------------
def eps_10s(states: DataFrame) -> DataFrame:
    merged = TRAFFIC_10S.merge(states)
    return merged.select("bucket", (F.col("total") / 10).alias("eps")).orderBy("bucket")


def error_rate_10s(states: DataFrame) -> DataFrame:
    merged = TRAFFIC_10S.merge(states)
    return merged.select("bucket", percent("errors", "total").alias("error_rate")).orderBy("bucket")


def eps_1m(states: DataFrame) -> DataFrame:
    merged = TRAFFIC_1M.merge(states, by=["bucket"])
    return merged.select(
        "bucket", "total", F.round(F.col("total") / 60, 2).alias("eps")
    ).orderBy("bucket")


def stage_p95(states: DataFrame, rollup: Rollup, by: Sequence[str] = ("bucket",)) -> DataFrame:
    """p95 per stage from sketches, merged over the dimensions ``by`` leaves out."""
    merged = rollup.answers(rollup.merge(states, by=by))
    return merged.select(*by, *[F.col(f"{s}_ms").alias(f"{s}_p95_ms") for s in STAGES])


def exact_stage_p95(
    events: DataFrame, seconds: int = 60, by: Sequence[str] = ("bucket",)
) -> DataFrame:
    """``stage_p95`` without sketches, from the events themselves."""
    timed = events.where(complete_timeline()).select(
        bucket_of("kafka_received_at", seconds).alias("bucket"),
        "service",
        *[F.expr(stage_ms(s)).alias(f"{s}_p95_ms") for s in STAGES],
    )
    return exact_quantiles(timed, by, {c: c for c in P95_COLUMNS})


def stage_p95_10s(states: DataFrame) -> DataFrame:
    return stage_p95(states, LATENCY_10S).orderBy("bucket")


def stage_p95_1m(states: DataFrame) -> DataFrame:
    return stage_p95(states, LATENCY_1M).orderBy("bucket")


def e2e_p95(p95: DataFrame) -> DataFrame:
    return p95.select("bucket", F.col("e2e_p95_ms").alias("p95_ms"))


def sink_p95(p95: DataFrame) -> DataFrame:
    return p95.select(
        "bucket",
        F.col("spark_to_stored_p95_ms").alias("sink_p95_ms"),
        "e2e_p95_ms",
    )


def ingest_p95(p95: DataFrame) -> DataFrame:
    return p95.select("bucket", "kafka_to_spark_ingest_p95_ms")


def top_services(p95_by_service: DataFrame, k: int = 5) -> DataFrame:
    """Slowest services to publish; a service's name breaks ties."""
    return (
        p95_by_service.select("service", F.col("producer_to_kafka_p95_ms").alias("publish_p95_ms"))
        .orderBy(F.desc("publish_p95_ms"), "service")
        .limit(k)
    )


def created_stored_ratio(states: DataFrame) -> DataFrame:
    merged = CREATED_STORED_1M.merge(states)
    return merged.select(
        "bucket",
        "created",
        "stored",
        or_zero(F.try_divide("stored", "created")).alias("ratio"),
    ).orderBy("bucket")


def dlq_counts(states: DataFrame) -> DataFrame:
    return DLQ_1M.merge(states).orderBy("bucket", "service", "error_type")


# --- latest state ---------------------------------------------------------------------------
def latest_bucket(frame: DataFrame) -> DataFrame:
    return frame.orderBy(F.desc("bucket")).limit(1)


def latest_traffic(states: DataFrame) -> DataFrame:
    """EPS and error rate of the newest minute."""
    newest = latest_bucket(TRAFFIC_1M.merge(states, by=["bucket"]))
    return newest.select(
        "bucket",
        (F.col("total") / 60).alias("eps"),
        percent("errors", "total").alias("error_rate_pct"),
    )


def freshness(received: DataFrame, as_of: Column, at: str = "kafka_received_at") -> DataFrame:
    """Milliseconds since the newest row; with no rows the newest one counts as the epoch."""
    newest = F.coalesce(F.max(at), F.expr(EPOCH))
    return received.agg(newest.alias("_newest")).select(
        (F.unix_millis(as_of) - F.unix_millis("_newest")).alias("freshness_ms")
    )


def mean_lag_ms(states: DataFrame) -> DataFrame:
    merged = LAG_1M.merge(states, by=[])
    return merged.select(or_zero(F.try_divide("sum_lag", "cnt") * 1000).alias("lag_ms"))


def dlq_rate(dlq_states: DataFrame, traffic_states: DataFrame) -> DataFrame:
    """Dead letters per hundred stored events: one total divided by another."""
    dlq = DLQ_1M.merge(dlq_states, by=[]).select("total").scalar()
    total = TRAFFIC_1M.merge(traffic_states, by=[])
    return total.select(or_zero(F.try_divide(dlq, F.col("total")) * 100).alias("dlq_rate_pct"))


def health(
    traffic: DataFrame, latency: DataFrame, fresh: DataFrame, dlq: DataFrame
) -> DataFrame:
    """One row with everything a monitor checks.

    Each part has at most one row; a part without rows reads as zeros and the epoch, which is
    itself a finding (no events, nothing fresh), so it must not become NULL.
    """
    spark = traffic.sparkSession
    row = spark.range(1).select(F.lit(1).alias("_k"))
    parts = [
        traffic.withColumnRenamed("bucket", "eps_bucket"),
        latency.withColumnRenamed("bucket", "latency_bucket"),
        fresh,
        dlq,
    ]
    for part in parts:
        # One row, whatever is handed in: that is what may be broadcast.
        row = row.join(F.broadcast(part.limit(1).withColumn("_k", F.lit(1))), "_k", "left")
    filled = []
    for field in row.schema:
        if field.name == "_k":
            continue
        empty = F.expr(EPOCH) if field.name.endswith("bucket") else F.lit(0).cast(field.dataType)
        filled.append(F.coalesce(field.name, empty).alias(field.name))
    return row.select(*filled)
