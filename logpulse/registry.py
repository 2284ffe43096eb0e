"""Queries registered for checking: each reads the given tables whole.

Log rows are computed from ``events`` (see ``testbed``); results are flattened so that two
engines can be compared: timestamps become ``<name>_ms`` (epoch milliseconds).
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from dataclasses import replace
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logpulse import testbed as tb
from logpulse.config import SinkSettings, StreamSettings
from logpulse.functions.ids import stable_event_id
from logpulse.functions.latency import STAGES, complete_timeline, stage_ms
from logpulse.functions.quantiles import SKETCH_RANK_ERROR, within_rank_error
from logpulse.functions.timebuckets import bucket_of
from logpulse.operators import dedup, observe, quarantine, routing
from logpulse.operators.parse import IS_EVENT, MODES, good_events, split_events
from logpulse.plans import catalog, retention, serve, thresholds
from logpulse.plans.rollups import union_states
from logpulse.schema import EVENT_LOG_COLUMNS
from logpulse.session import scratch_dir, tune
from logpulse.sources import database, telemetry
from logpulse.sources.broker import topic_stream, topic_table
from logpulse.sources.tables import read_table
from logpulse.sources.views import register_views
from logpulse.streaming import alerts
from logpulse.streaming.archive import TopicArchive, newest
from logpulse.streaming.batch import Batch
from logpulse.streaming.delivery import Delivery
from logpulse.streaming.guard import FileCommitLog, not_committed
from logpulse.streaming.ingest import DeadLetterTopic, backfill
from logpulse.streaming.maintenance import downsample
from logpulse.streaming.microbatch import MicroBatch, start
from logpulse.streaming.rollup_store import RollupStore
from logpulse.streaming.silence import Watch, watched, watched_stream
from logpulse.streaming.superseded import Superseded
from logpulse.streaming.targets import FileTopic, ParquetTable, StagedJdbcTable
from logpulse.streaming.vitals import BatchVitals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Columns the rollups need.
TRAFFIC = ("kafka_received_at", "event_id", "service", "status_code")
_ROLLED_UP = ["event_timestamp", "kafka_received_at", "spark_received_at", "event_id", "service", "status_code"]
TIMELINE = ("event_timestamp", "kafka_received_at", "spark_received_at", "service")


def flat(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.unix_millis(f.name).alias(f"{f.name}_ms")
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def register(name: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        @wraps(query)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return flat(query(tune(spark), sf_dir))

        QUERIES[name] = run
        return query

    return add


def raw_rows(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return tb.broker_rows(tb.events(spark, sf_dir), **options)


def log(spark: SparkSession, sf_dir: str, columns=None, **options) -> DataFrame:
    return tb.event_log(raw_rows(spark, sf_dir), columns, **options)


def clock(spark: SparkSession, sf_dir: str) -> Column:
    """"Now" of the replay: the newest broker time, a scalar subquery that parses nothing."""
    sent = tb.log_rows(tb.events(spark, sf_dir), repeats=False)
    return sent.select(F.timestamp_millis(F.max("broker_ms"))).scalar()


# --- parsing, normalisation, dead letters -----------------------------------------------------
@register("p_normalized_events")
def _(spark, d):
    return log(spark, d)


@register("p13_events_with_raw_text")
def _(spark, d):
    return log(spark, d, ["topic", "kafka_partition", "kafka_offset", "raw_json"],
               store_raw_json=True)


@register("p1_f1_bad_rows")
def _(spark, d):
    _, bad = split_events(tb.replay_parse(raw_rows(spark, d), ()))
    return bad.select(
        "error_type", "error_message", "kafka_key", "topic", "partition", "offset",
        "kafka_received_at", "raw_json",
    )


@register("f1_split_counts_by_mode")
def _(spark, d):
    raw = raw_rows(spark, d)
    judged = [
        tb.replay_parse(raw, (), mode).select("topic", F.lit(mode).alias("mode"), F.expr(IS_EVENT).alias("good"))
        for mode in MODES
    ]
    counts = {f"{kind}_{mode}": f"mode = '{mode}' AND {test}" for kind, test in (("good", "good"), ("bad", "NOT good")) for mode in MODES}
    return judged[0].union(judged[1]).groupBy("topic").agg(
        *[F.count_if(F.expr(test)).alias(name) for name, test in counts.items()]
    )


# Texts near an event, by kind; only the first is one.
_HOSTILE = (
    """concat('{"event_id":"', id, '","status_code":200}')""",
    """concat('{"event_id":"', id, '","event_id":"b","status_code":200}')""",
    """concat("{'event_id':'", id, "','status_code':200}")""",
    """concat('{"event_id":"', id, '","v":NaN}')""",
    """concat('{"event_id":"', id, '"} and more')""",
    """concat('{"event_id":"', id, '","status_code":20')""",
)


@register("f1_strict_hostile_texts")
def _(spark, d):
    """The same verdict on a text however few of its fields are parsed."""
    kinds = " ".join(f"WHEN {n} THEN {text}" for n, text in enumerate(_HOSTILE))
    rows = tb.broker_rows(tb.events(spark, d), repeats=False).selectExpr("offset * 3 + partition AS id", "*")
    rows = rows.withColumn("value", F.expr(f"CAST(CASE id % {len(_HOSTILE)} {kinds} END AS BINARY)"))

    def good(fields):
        kept = good_events(tb.parse_events(rows, fields=fields, keep=["id"]))
        return kept.select(F.expr("id % 6 AS kind"), F.lit(fields is None).alias("whole"))

    both = good(None).union(good(["status_code"])).union(good(["ts_ms"]))
    return both.groupBy("kind").agg(F.count_if("whole").alias("whole"), F.count_if(F.expr("NOT whole")).alias("narrow"))


@register("f2_permissive_events")
def _(spark, d):
    return log(spark, d, ["event_id", "service", "result", "status_code", "topic"],
               mode="permissive").drop("spark_processed_at", "stored_at")


@register("p17_bad_row_envelopes")
def _(spark, d):
    _, bad = split_events(tb.replay_parse(raw_rows(spark, d), ()))
    return quarantine.envelope_bad_rows(bad)


@register("p20_dead_letter_messages")
def _(spark, d):
    _, bad = split_events(tb.replay_parse(raw_rows(spark, d), ()))
    return quarantine.to_messages(quarantine.envelope_bad_rows(bad))


@register("p16_f3_dead_letter_table")
def _(spark, d):
    return tb.dead_letters(raw_rows(spark, d))


@register("p18_failed_batch_envelopes")
def _(spark, d):
    # The whole table as one batch a sink refused.
    batch = log(spark, d, store_raw_json=True)
    return quarantine.envelope_failed_batch(batch, "refused")


@register("p19_failed_publish_envelopes")
def _(spark, d):
    raw = raw_rows(spark, d)
    failed = raw.select(
        F.substring_index("topic", ".", -1).alias("service"),
        F.col("value").cast("string").alias("raw_json"),
        F.lit("TimeoutError").alias("error_type"),
        F.lit("no broker").alias("error_message"),
        "topic",
        F.col("timestamp").alias("failed_at"),
    )
    return quarantine.envelope_failed_publish(failed)


@register("p21_stable_event_ids")
def _(spark, d):
    good = good_events(tb.replay_parse(raw_rows(spark, d)))
    payload = good.select("topic", "partition", "offset", "json.*")
    return payload.select("topic", "partition", "offset",
                          stable_event_id(payload.schema).alias("stable_id"))


@register("p22_p23_time_buckets")
def _(spark, d):
    rows = raw_rows(spark, d)
    return rows.groupBy(
        bucket_of("timestamp", 60).alias("minute"), bucket_of("timestamp", 10).alias("ten_seconds")
    ).agg(F.count("*").alias("n"))


@register("p24_stage_latencies")
def _(spark, d):
    events = log(spark, d, ["event_timestamp", "kafka_received_at", "spark_received_at",
                            "topic", "kafka_partition", "kafka_offset"])
    return events.select(
        "topic", "kafka_partition", "kafka_offset",
        *[F.expr(stage_ms(s)).alias(f"{s}_ms") for s in STAGES],
    )


@register("f4_complete_timelines")
def _(spark, d):
    events = log(spark, d, TIMELINE)
    return events.groupBy("service").agg(
        F.count_if(F.expr(complete_timeline())).alias("complete"), F.count("*").alias("n")
    )


@register("f5_last_minutes")
def _(spark, d):
    states = catalog.TRAFFIC_10S.states(log(spark, d, TRAFFIC))
    recent = serve.last_minutes(states, clock(spark, d), 5)
    return catalog.TRAFFIC_10S.merge(recent)


@register("f6_time_range")
def _(spark, d):
    states = catalog.TRAFFIC_10S.states(log(spark, d, TRAFFIC))
    ranged = serve.between(
        states,
        F.lit("2024-01-01 00:05:00").cast("timestamp"),
        F.lit("2024-01-01 00:30:00").cast("timestamp"),
    )
    return catalog.TRAFFIC_10S.merge(ranged).orderBy("bucket")


@register("f7_topic_routing")
def _(spark, d):
    # Services include ones without a listed topic, and empty and missing ones.
    rows = tb.log_rows(tb.events(spark, d)).withColumn(
        "service",
        F.expr("CASE WHEN k = 0 THEN '' WHEN k = 1 THEN NULL "
               "WHEN k < 10 THEN event_type ELSE service END"),  # fmt: skip
    )
    return rows.groupBy("service", routing.topic_of("service").alias("topic")).agg(
        F.count("*").alias("n")
    )


@register("f8_error_fan_out")
def _(spark, d):
    parsed = good_events(tb.replay_parse(raw_rows(spark, d))).select(
        "json.service", "json.result", "json.status_code", "partition", "offset"
    )
    return routing.fan_out_errors(parsed).select("service", "topic", "partition", "offset")


# --- deduplication ----------------------------------------------------------------------------
_A15 = ["event_id", "service", "kafka_received_at", "topic", "kafka_partition", "kafka_offset"]


@register("a15_latest_per_event")
def _(spark, d):
    return dedup.keep_latest(log(spark, d, _A15))


@register("a15_latest_per_event_and_day")
def _(spark, d):
    return dedup.keep_latest(log(spark, d, _A15), scope="partition")


def _settled(spark, d, scope):
    """The table in three batches, settled after the second, so that lists and new rows differ."""
    path = scratch_dir(spark, "settled")
    rows = log(spark, d, _A15)
    table, lists = ParquetTable(path, "kafka_received_at"), Superseded(path, scope)
    for n in range(3):
        table.write(rows.where(F.col("kafka_partition") == n), Batch("s", "event_log", n, "q"))
        if n == 1:
            lists.settle(spark)
    return lists


@register("a15_latest_by_position")
def _(spark, d):
    """Latest versions out of stored batches: only keys and positions are shuffled."""
    lists = _settled(spark, d, "table")
    lists.settle(spark)
    return lists.read(spark).drop("ingest_date", "batch_key")


@register("a15_latest_by_position_and_day")
def _(spark, d):
    lists = _settled(spark, d, "partition")
    return lists.read(spark, fresh=True).drop("ingest_date", "batch_key")


@register("u2_distinct_keys")
def _(spark, d):
    keys = ["service", "event_id"]
    return dedup.drop_repeats(log(spark, d, keys).select(*keys), keys)


@register("t4_rollup_raw_and_deduplicated")
def _(spark, d):
    # Failed events are delivered twice, so errors double unless repeats are settled first.
    events = tb.event_log(raw_rows(spark, d, error_copies=True), _A15 + ["status_code"])
    latest = dedup.keep_latest(events)
    sides = [("raw", events), ("latest", latest)]
    return union_states(
        [
            catalog.TRAFFIC_1M.states(rows).select(F.lit(side).alias("side"), "*")
            for side, rows in sides
        ]
    )


# --- rollups ----------------------------------------------------------------------------------
@register("a1_traffic_1m")
def _(spark, d):
    return catalog.TRAFFIC_1M.states(log(spark, d, TRAFFIC))


@register("a2_created_stored_1m")
def _(spark, d):
    return catalog.CREATED_STORED_1M.states(log(spark, d, ["event_timestamp"]))


@register("a3_u1_created_stored_backfill")
def _(spark, d):
    return catalog.created_stored_backfill(log(spark, d, ["event_timestamp"]))


@register("u1_created_stored_by_union")
def _(spark, d):
    return catalog.created_stored_by_union(log(spark, d, ["event_timestamp"]))


@register("a4_ingest_lag_1m")
def _(spark, d):
    return catalog.LAG_1M.states(log(spark, d, ["event_timestamp", "kafka_received_at"]))


@register("a5_stage_latency_service_1m")
def _(spark, d):
    return serve.exact_stage_p95(log(spark, d, TIMELINE), 60, ["bucket", "service"])


def _checked(answers, events, seconds, keys):
    """Quantiles answered by sketches, each judged by its rank among the events.

    Twice the error one sketch has in 99 of 100 cases: very many sketches are judged.
    """
    stages = F.array(*[F.lit(s) for s in STAGES])
    of = {c.removesuffix("_ms").removesuffix("_p95"): c for c in answers.columns}
    named = answers.select(
        *keys, F.inline(F.arrays_zip(stages.alias("stage"), F.array(*[of[s] for s in STAGES]).alias("answer")))
    ).toDF(*keys, "stage", "answer")
    timed = events.where(complete_timeline()).select(
        *[k for k in keys if k != "bucket"],
        *([bucket_of("kafka_received_at", seconds).alias("bucket")] if "bucket" in keys else []),
        F.inline(F.arrays_zip(stages.alias("stage"), F.array(*[F.expr(stage_ms(s)) for s in STAGES]).alias("reading"))),
    )
    timed = timed.toDF(*[k for k in keys if k != "bucket"], *[k for k in keys if k == "bucket"], "stage", "reading")
    return within_rank_error(named, timed, [*keys, "stage"], 0.95, 2 * SKETCH_RANK_ERROR)


@register("a5_stage_latency_service_1m_sketch")
def _(spark, d):
    r, events = catalog.LATENCY_1M, log(spark, d, TIMELINE)
    return _checked(r.answers(r.states(events)), events, 60, ["bucket", "service"])


@register("a6_dlq_1m")
def _(spark, d):
    return catalog.DLQ_1M.states(tb.dead_letters(raw_rows(spark, d)))


@register("a7_traffic_10s")
def _(spark, d):
    return catalog.TRAFFIC_10S.states(log(spark, d, TRAFFIC))


@register("a8_stage_latency_10s")
def _(spark, d):
    return serve.exact_stage_p95(log(spark, d, TIMELINE), 10)


@register("a8_stage_latency_10s_sketch")
def _(spark, d):
    r, events = catalog.LATENCY_10S, log(spark, d, TIMELINE)
    return _checked(r.answers(r.states(events)), events, 10, ["bucket"])


@register("a9_overall_latency_1m")
def _(spark, d):
    # Not kept as a rollup of its own: merged out of the per-service one (exact twin here).
    return serve.exact_stage_p95(log(spark, d, TIMELINE), 60)


@register("a10_a14_merged_partials")
def _(spark, d):
    # Partial states per broker partition, then merged over the partitions.
    r = catalog.TRAFFIC_1M
    per_partition = replace(r, dims=(*r.dims, ("kafka_partition", "kafka_partition")))
    partial = per_partition.states(log(spark, d, (*TRAFFIC, "kafka_partition")))
    return r.merge(partial)


@register("a11_merged_sketches")
def _(spark, d):
    r, events = catalog.LATENCY_10S, log(spark, d, TIMELINE)
    return _checked(r.answers(r.merge(r.states(events), by=[])), events, 10, [])


@register("a12_rolled_up_dimensions")
def _(spark, d):
    return catalog.TRAFFIC_1M.merge(
        catalog.TRAFFIC_1M.states(log(spark, d, TRAFFIC)), by=["service"]
    )


@register("a13_newest_ingest")
def _(spark, d):
    r = catalog.LATENCY_1M
    merged = r.merge(r.states(log(spark, d, TIMELINE)), by=["service"])
    return merged.select("service", "max_ingest")


def _shared(spark, d):
    return catalog.EVENT_STATES.states(log(spark, d))


@register("st12_shared_states_traffic_1m")
def _(spark, d):
    return catalog.EVENT_STATES.rollup(_shared(spark, d), "traffic_1m")


@register("st12_shared_states_lag_1m")
def _(spark, d):
    return catalog.EVENT_STATES.rollup(_shared(spark, d), "lag_1m")


@register("st12_shared_states_created_stored_1m")
def _(spark, d):
    return catalog.EVENT_STATES.rollup(_shared(spark, d), "created_stored_1m")


# --- serving ----------------------------------------------------------------------------------
@register("q1_eps_10s")
def _(spark, d):
    return serve.eps_10s(catalog.TRAFFIC_10S.states(log(spark, d, TRAFFIC)))


@register("q2_error_rate_10s")
def _(spark, d):
    return serve.error_rate_10s(catalog.TRAFFIC_10S.states(log(spark, d, TRAFFIC)))


@register("q3_e2e_p95_10s")
def _(spark, d):
    return serve.e2e_p95(serve.exact_stage_p95(log(spark, d, TIMELINE), 10))


@register("q4_stage_p95_10s")
def _(spark, d):
    return serve.exact_stage_p95(log(spark, d, TIMELINE), 10).orderBy("bucket")


@register("q4_stage_p95_10s_sketch")
def _(spark, d):
    events = log(spark, d, TIMELINE)
    return _checked(serve.stage_p95_10s(catalog.LATENCY_10S.states(events)), events, 10, ["bucket"])


def _recent(spark, d, columns, minutes, now=None):
    """Events of the last minutes, cut by bucket before they are parsed."""
    now = clock(spark, d) if now is None else now
    since = now - F.make_dt_interval(mins=F.lit(minutes))
    return log(spark, d, columns).where(bucket_of("kafka_received_at", 60) >= since)


@register("q5_latest_traffic")
def _(spark, d):
    return serve.latest_traffic(catalog.TRAFFIC_1M.states(_recent(spark, d, TRAFFIC, 5)))


@register("q6_latest_stage_p95")
def _(spark, d):
    return serve.latest_bucket(serve.exact_stage_p95(_recent(spark, d, TIMELINE, 5)))


@register("q7_a16_freshness")
def _(spark, d):
    now = clock(spark, d)
    events = log(spark, d, ["kafka_received_at"])
    return serve.freshness(serve.last_minutes(events, now, 10, at="kafka_received_at"), now)


def _recent_dlq(spark, d, minutes, now):
    states = catalog.DLQ_1M.states(tb.dead_letters(raw_rows(spark, d)))
    return serve.last_minutes(states, now, minutes)


@register("q8_a18_j2_dlq_rate")
def _(spark, d):
    now = clock(spark, d)
    traffic = catalog.TRAFFIC_1M.states(_recent(spark, d, TRAFFIC, 5, now))
    return serve.dlq_rate(_recent_dlq(spark, d, 5, now), traffic)


@register("q7_a16_freshness_from_states")
def _(spark, d):
    now = clock(spark, d)
    arrivals = catalog.ARRIVAL_1M.states(log(spark, d, ["kafka_received_at"]))
    return serve.freshness(serve.last_minutes(arrivals, now, 10, at="newest"), now, at="newest")


@register("q9_j1_health")
def _(spark, d):
    """The text is read once: all parts come from a stored event table and dead-letter table."""
    now, root = clock(spark, d), scratch_dir(spark, "health")
    log(spark, d, [*_ROLLED_UP, "topic"]).write.parquet(f"{root}/events")
    events = spark.read.parquet(f"{root}/events")
    recent = events.where(bucket_of("kafka_received_at", 60) >= now - F.make_dt_interval(mins=F.lit(5)))
    traffic = catalog.TRAFFIC_1M.states(recent)
    arrivals = serve.last_minutes(catalog.ARRIVAL_1M.states(events), now, 10, at="newest")
    return serve.health(
        serve.latest_traffic(traffic),
        serve.latest_bucket(serve.exact_stage_p95(recent)),
        serve.freshness(arrivals, now, at="newest"),
        serve.dlq_rate(_recent_dlq(spark, d, 5, now), traffic),
    )


@register("q10_stage_p95_1m")
def _(spark, d):
    return serve.exact_stage_p95(_recent(spark, d, TIMELINE, 10)).orderBy("bucket")


@register("q10_stage_p95_1m_sketch")
def _(spark, d):
    events = _recent(spark, d, TIMELINE, 10)
    return _checked(serve.stage_p95_1m(catalog.LATENCY_1M.states(events)), events, 60, ["bucket"])


@register("q11_sink_p95_1m")
def _(spark, d):
    return serve.sink_p95(serve.exact_stage_p95(_recent(spark, d, TIMELINE, 10)))


@register("q12_ingest_p95_1m")
def _(spark, d):
    return serve.ingest_p95(serve.exact_stage_p95(_recent(spark, d, TIMELINE, 10)))


@register("q13_eps_1m")
def _(spark, d):
    return serve.eps_1m(catalog.TRAFFIC_1M.states(_recent(spark, d, TRAFFIC, 10)))


@register("q14_o3_top_services")
def _(spark, d):
    recent = _recent(spark, d, TIMELINE, 10)
    return serve.top_services(serve.exact_stage_p95(recent, 60, ["service"]))


@register("q15_a17_mean_lag")
def _(spark, d):
    columns = ["event_timestamp", "kafka_received_at"]
    return serve.mean_lag_ms(catalog.LAG_1M.states(_recent(spark, d, columns, 5)))


@register("q16_created_stored_ratio")
def _(spark, d):
    return serve.created_stored_ratio(
        catalog.CREATED_STORED_1M.states(log(spark, d, ["event_timestamp"]))
    )


@register("q17_dlq_counts")
def _(spark, d):
    return serve.dlq_counts(catalog.DLQ_1M.states(tb.dead_letters(raw_rows(spark, d))))


# --- observability and alerts -----------------------------------------------------------------
# Component and log line of each event.
_COMPONENT = (
    "CASE event_type WHEN 'signup' THEN 'kafka' WHEN 'purchase' THEN 'spark-driver' "
    "WHEN 'error' THEN 'clickhouse' WHEN 'click' THEN 'grafana' ELSE 'other' END"
)
_LINE = (
    "CASE k % 10 WHEN 0 THEN 'java.lang.OutOfMemoryError: heap' WHEN 1 THEN 'FATAL ERROR: log dir' "
    "WHEN 2 THEN 'Job aborted due to stage failure' WHEN 3 THEN concat('Code:  241 at ', event_id) "
    "WHEN 4 THEN 'memory_limit_exceeded' WHEN 5 THEN 'DB::Exception: Memory limit exceeded' "
    "WHEN 6 THEN 'level=ERROR msg=x' WHEN 7 THEN 'panic: nil' WHEN 8 THEN 'outofmemoryerror' "
    "ELSE concat('took ', k, ' ms') END"
)


@register("f9_alerting_log_lines")
def _(spark, d):
    lines = (
        tb.events(spark, d)
        .withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
        .selectExpr("event_id", f"{_COMPONENT} AS component", f"{_LINE} AS line")
    )
    return observe.alerting_lines(lines)


@register("j3_batches_to_recover")
def _(spark, d):
    # A minute of a topic is a batch; one stored five minutes ago or earlier is committed.
    cutoff = clock(spark, d) - F.make_dt_interval(mins=F.lit(5))
    batches = raw_rows(spark, d).groupBy(
        F.col("topic").alias("stream_name"),
        F.lit("event_log").alias("target_table"),
        F.lit("q").alias("query_id"),
        F.expr("unix_seconds(timestamp) div 60").alias("batch_id"),
    ).agg(F.max("stored_ms").alias("last_ms"))
    committed = batches.where(F.timestamp_millis("last_ms") <= cutoff)
    return not_committed(batches.drop("last_ms"), committed)


def _offset_lag(spark, d, absent):
    rows = raw_rows(spark, d)
    ends = F.max("offset") + 1
    latest = rows.groupBy("topic", "partition").agg(ends.alias("end"))
    cutoff = clock(spark, d) - F.make_dt_interval(mins=F.lit(10))
    # One partition has never been read.
    read = (
        rows.where(F.col("timestamp") <= cutoff)
        .groupBy("topic", "partition")
        .agg(ends.alias("end"))
        .where("NOT (topic = 'logs.payment' AND partition = 2)")
    )
    # Both sides as the texts they arrive in.
    printed = latest.select(F.concat_ws(":", "topic", "partition", "end").alias("value"))
    checkpointed = read.select(
        F.to_json(
            F.create_map("topic", F.create_map(F.col("partition").cast("string"), "end"))
        ).alias("value")
    )
    return observe.offset_lag(
        telemetry.latest_offsets(printed), telemetry.committed_offsets(checkpointed), absent=absent
    )


@register("j4_o4_offset_lag")
def _(spark, d):
    return _offset_lag(spark, d, "report").orderBy("topic", "partition")


@register("j4_offset_lag_from_zero")
def _(spark, d):
    return _offset_lag(spark, d, "zero")


@register("s1_j4_offset_gap")
def _(spark, d):
    """The rows behind the lag: what the topics hold past the committed offsets, read from an archive."""
    archive = TopicArchive(scratch_dir(spark, "archive"), span=5000)
    rows = raw_rows(spark, d)
    for n in range(3):
        archive.write(rows.where(f"offset div 700 % 3 = {n}"), Batch("archive", "topics", n))
    read = rows.where(F.col("timestamp") <= clock(spark, d) - F.make_dt_interval(mins=F.lit(10)))
    read = read.where("NOT (topic = 'logs.payment' AND partition = 2)")
    return archive.between(spark, newest(read), newest(rows)).select("topic", "partition", "offset", "timestamp")


@register("a19_offset_lag_totals")
def _(spark, d):
    return observe.lag_totals(_offset_lag(spark, d, "report"))


def _minutes(spark, d):
    """Health metrics of every minute."""
    traffic = catalog.TRAFFIC_1M.merge(
        catalog.TRAFFIC_1M.states(log(spark, d, TRAFFIC)), by=["bucket"]
    ).select("bucket", (F.col("total") / 60).alias("eps"),
             serve.percent("errors", "total").alias("error_rate_pct"))
    return traffic.join(serve.exact_stage_p95(log(spark, d, TIMELINE)), "bucket", "left")


@register("j5_threshold_breaches")
def _(spark, d):
    return thresholds.check(_minutes(spark, d), keep=("bucket",))


@register("a20_batch_timing_summary")
def _(spark, d):
    # A minute of a service is a batch: a millisecond per event to transform, ten per error
    # to write, reported as the lines a running stream leaves.
    per_minute = catalog.TRAFFIC_1M.states(log(spark, d, TRAFFIC))
    stages = F.explode(
        F.map_from_arrays(
            F.array(F.lit("transform"), F.lit("write")),
            F.array(F.col("total") / 1000, (F.col("errors") * 10 + 5) / 1000),
        )
    ).alias("stage", "seconds")
    lines = per_minute.select("bucket", "service", stages).select(
        F.concat(
            F.date_format("bucket", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            F.lit(" [spark batch] stream="), "service",
            F.lit(" table=event_log query=event_log_stream batch_id="),
            F.expr("unix_seconds(bucket) div 60"),
            F.lit(" stage="), "stage", F.lit(" duration="),
            F.format_string("%.3f", "seconds"), F.lit("s"),
        ).alias("value")
    )
    summary = observe.timing_summary(telemetry.timing_lines(lines), 0.1)
    return summary.select(
        "stream", "batches",
        *[F.round(c, 6).alias(c) for c in summary.columns if c not in ("stream", "batches")],
    )


@register("a21_publish_rates")
def _(spark, d):
    rows = raw_rows(spark, d).withColumn("service", F.substring_index("topic", ".", -1))
    return observe.publish_rates(rows, services=["auth", "order"])


@register("k11_live_rows")
def _(spark, d):
    stamped = tb.events(spark, d).select(F.col("ts").cast("timestamp").alias("kafka_received_at"))
    now = stamped.select(F.max("kafka_received_at")).scalar()
    return union_states(
        [
            retention.live(stamped, table, now)
            .groupBy(F.lit(table).alias("table_name"),
                     F.to_date("kafka_received_at").cast("string").alias("day"))
            .agg(F.count("*").alias("n"))
            for table in ("event_log", "event_log_dlq")
        ]
    )


def _readings(spark, d):
    """Ten-second traffic of each service; low when under the service's own average."""
    r = replace(catalog.TRAFFIC_10S, dims=(("service", "service"),))
    traffic = r.states(log(spark, d, TRAFFIC))
    own = Window.partitionBy("service")
    return traffic.select(
        F.col("service").alias("key"),
        F.col("bucket").alias("at"),
        (F.col("total") * F.count("*").over(own) < F.sum("total").over(own)).alias("breached"),
    )


ALERTS = alerts.AlertRule(grace_seconds=20, cooldown_seconds=60)
LEVELS = alerts.LevelRule(
    low_to_mid=640, mid_to_low=620, mid_to_high=680, high_to_mid=650, cooldown_seconds=180
)


@register("st13_sustained_breaches")
def _(spark, d):
    return alerts.sustained_breaches(_readings(spark, d), ALERTS.grace_seconds)


@register("st13_st14_alerts")
def _(spark, d):
    return alerts.in_order(_readings(spark, d), ALERTS)


def _changes(spark, d):
    """Readings of collectors that report changes alone: most breaches end their grace period in silence."""
    before = F.lag("breached").over(Window.partitionBy("key").orderBy("at"))
    rows = _readings(spark, d).withColumn("before", before)
    return rows.where(~F.col("breached").eqNullSafe(F.col("before"))).drop("before")


@register("st13_st14_silent_alerts")
def _(spark, d):
    changes = _changes(spark, d)
    until = changes.agg(F.max("at")).first()[0]
    return watched(changes, Watch(ALERTS), until)


@register("st15_capacity_levels")
def _(spark, d):
    r = replace(catalog.LAG_1M, dims=(("service", "service"),))
    lags = r.states(log(spark, d, ["event_timestamp", "kafka_received_at", "service"]))
    return alerts.in_order(
        lags.select(
            F.col("service").alias("key"),
            F.col("bucket").alias("at"),
            (F.col("sum_lag") / F.col("cnt") * 1000).alias("lag_ms"),
        ),
        LEVELS,
    )


# --- sinks and streams ------------------------------------------------------------------------
CONTENT = [c for c in EVENT_LOG_COLUMNS if c not in ("spark_received_at", "spark_processed_at")]


@register("k1_k10_stored_days")
def _(spark, d):
    path = scratch_dir(spark, "stored")
    table = ParquetTable(path, "kafka_received_at", ("service", "event_id"), rebalance=True)
    Delivery(table)(log(spark, d), Batch("backfill", "event_log", 0))
    return (
        read_table(spark, path)
        .groupBy(F.col("ingest_date").cast("string").alias("ingest_date"), "service")
        .agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("events"))
    )


def _five_days(spark, d):
    """The event table over five ingest days."""
    later = F.expr("kafka_received_at + make_dt_interval(kafka_offset % 5)")
    rows = log(spark, d, [*_ROLLED_UP, "kafka_offset", "kafka_partition"])
    return rows.withColumn("kafka_received_at", later)


@register("k11_tiers")
def _(spark, d):
    """Totals by minute of all days, and by ten seconds of the day whose fine states still live.

    Days are down-sampled twice: a batch that is late for days already kept by the minute is
    merged into them.
    """
    store, rows = RollupStore(scratch_dir(spark, "tiers"), catalog.EVENT_ROLLUPS), _five_days(spark, d)
    as_of = rows.select(F.max(F.to_date("kafka_received_at"))).first()[0]
    for n in range(3):
        store(rows.where(F.col("kafka_partition") == n), Batch("s", "event_log", n, "q"))
        if n:
            downsample(spark, store, as_of)

    def totals(name):
        merged = store.rollup(spark, name).groupBy("bucket")
        return merged.agg(F.lit(name).alias("name"), F.sum("total").alias("total"), F.sum("errors").alias("errors"))

    return union_states([totals("traffic_1m"), totals("traffic_10s")])


@register("s6_view_range")
def _(spark, d):
    """Rollups in SQL over a range of time, out of states of five days of which it reads two."""
    root = scratch_dir(spark, "views")
    store = RollupStore(f"{root}/rollups/event_log", catalog.EVENT_ROLLUPS)
    store(_five_days(spark, d), Batch("s", "event_log", 0, "q"))
    register_views(spark, root, prefix="s6_")
    ends = "TIMESTAMP '2024-01-02 00:05:00', TIMESTAMP '2024-01-03 00:20:00'"
    return spark.sql(
        f"""SELECT 'traffic_1m' AS name, service, bucket, total AS n FROM s6_traffic_1m_between({ends})
        UNION ALL SELECT 'traffic_10s', NULL, bucket, errors FROM s6_traffic_10s_between({ends})
        UNION ALL SELECT 'created_stored_1m', NULL, bucket, created
        FROM s6_created_stored_1m_between(TIMESTAMP '2024-01-01 00:10:00', TIMESTAMP '2024-01-01 00:30:00')"""
    )


@register("st12_backfilled_traffic_1m")
def _(spark, d):
    root = scratch_dir(spark, "backfill")
    for _ in range(2):  # repeated, it replaces itself
        backfill(raw_rows(spark, d), root, "sample", dead_letters=False)
    return _store(root, "rollups/event_log").rollup(spark, "traffic_1m")


@register("k1_k4_backfilled_dead_letters")
def _(spark, d):
    root = scratch_dir(spark, "backfill")
    backfill(raw_rows(spark, d), root, "sample")
    store = RollupStore(f"{root}/rollups/event_log_dlq", catalog.DLQ_ROLLUPS)
    return store.rollup(spark, "dlq_1m")


@register("st8_k6_guarded_replay")
def _(spark, d):
    root = scratch_dir(spark, "guarded")
    guard = FileCommitLog(f"{root}/guard")
    guard.create(spark)
    table = ParquetTable(f"{root}/event_log", "kafka_received_at")
    deliver = Delivery(table, guard=guard)
    events = log(spark, d, ["kafka_received_at", "service", "event_id"])
    for _ in range(2):  # the second delivery is recognised
        deliver(events, Batch("replay", "event_log", 0))
    return read_table(spark, f"{root}/event_log").groupBy("service").agg(F.count("*").alias("n"))


class _Refusing:
    def write(self, df, batch):
        raise RuntimeError("table is read-only")


@register("k5_st10_refused_batch")
def _(spark, d):
    root = scratch_dir(spark, "refused")
    deliver = Delivery(
        _Refusing(), SinkSettings(retry_max=1), bypass=FileTopic(root, "logs.dlq")
    )
    deliver(log(spark, d, ["kafka_received_at", "service", "event_id"]), Batch("s", "event_log", 0))
    topic = StreamSettings(files_root=root)
    dead = quarantine.parse_dlq(topic_table(spark, topic, "logs.dlq"))
    return dead.groupBy("error_type", "error_message", "service").agg(F.count("*").alias("n"))


def _streamed(spark, d, **options):
    """Broker rows of the sample as a stream over the given table."""
    return tb.broker_rows(tb.events_stream(spark, d, **options))


def _run(df, each, root, **options):
    """Run a stream to the end of its input."""
    start(df, each, f"{root}/checkpoint", once=True, **options).awaitTermination()


def _stream_events(spark, d, then=()):
    root = scratch_dir(spark, "stream")
    events = tb.event_log(_streamed(spark, d))
    each = MicroBatch(
        Delivery(ParquetTable(f"{root}/event_log", "kafka_received_at"),
                 SinkSettings(fail_on_error=True)),
        stream="event_log", table="event_log", stamps=False, then=[t(root) for t in then], reread=bool(then),
    )
    _run(events, each, root)
    return root


@register("k7_k8_batch_vitals")
def _(spark, d):
    """A run's own metrics, read back: rows, late rows and receive times of what it wrote."""
    root = scratch_dir(spark, "vitals")
    each = MicroBatch(
        Delivery(ParquetTable(f"{root}/event_log", "kafka_received_at"), SinkSettings(fail_on_error=True)),
        stream="event_log", table="event_log", stamps=False,
        vitals=BatchVitals(f"{root}/vitals", late_after=0.5),
    )
    _run(tb.event_log(_streamed(spark, d)), each, root)
    return telemetry.batch_vitals(spark, f"{root}/vitals").groupBy("stream", "table_name", "outcome").agg(
        F.sum("rows").alias("n"), F.sum("late_rows").alias("late"),
        F.min("oldest").alias("oldest"), F.max("newest").alias("newest"),
    )


@register("k2_s5_staged_database_append")
def _(spark, d):
    """Batches of which one dies half-way and all are delivered twice, counted by the database."""
    root = scratch_dir(spark, "derby")
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    sink = SinkSettings(
        url=f"jdbc:derby:memory:{root.rpartition('-')[2]};create=true",
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver", batchsize=500, fail_on_error=True,
    )
    events = log(spark, d, ["event_id", "service", "status_code", "kafka_partition", "kafka_offset"])
    events = events.select("event_id", F.col("service").cast("varchar(32)"), "status_code", "kafka_partition", "kafka_offset")
    table = StagedJdbcTable(sink, "event_log")
    dying = events.withColumn("status_code", F.expr("if(kafka_offset = 1000, CAST(raise_error('lost') AS INT), status_code)"))
    for n in range(3):
        own = F.col("kafka_partition") == n
        batch = Batch("s", "event_log", n, "q")
        with suppress(Exception):
            table.write(dying.where(own).repartition(4), batch)
        for _ in range(2):
            table.write(events.where(own).repartition(4), batch)
    q = {c: f'"{c}"' for c in ("service", "status_code")}
    return database.scan(
        spark, sink, f"SELECT service AS service, count(*) AS n, min({q['status_code']}) AS least FROM "
        f"(SELECT CAST({q['service']} AS VARCHAR(32)) AS service, {q['status_code']} FROM event_log) AS t GROUP BY service",
    ).toDF("service", "n", "least").select("service", F.col("n").cast("bigint").alias("n"), "least")


@register("st1_streamed_events")
def _(spark, d):
    root = _stream_events(spark, d)
    return read_table(spark, f"{root}/event_log").select(*CONTENT)


def _store(root, part="rollups"):
    return RollupStore(f"{root}/{part}", catalog.EVENT_ROLLUPS)


@register("st12_streamed_traffic_1m")
def _(spark, d):
    root = _stream_events(spark, d, then=[_store])
    return _store(root).rollup(spark, "traffic_1m")


@register("st12_streamed_created_stored_1m")
def _(spark, d):
    root = _stream_events(spark, d, then=[_store])
    return _store(root).rollup(spark, "created_stored_1m")


@register("st12_streamed_stage_p95_sketch")
def _(spark, d):
    root = _stream_events(spark, d, then=[_store])
    p95 = serve.stage_p95_10s(_store(root).rollup(spark, "latency_stage_10s"))
    return _checked(p95, log(spark, d, TIMELINE), 10, ["bucket"])


@register("st12_rollup_switched_off_and_on")
def _(spark, d):
    # Three batches; the second keeps neither the minute traffic nor latencies of services.
    root = scratch_dir(spark, "switched")
    events = tb.event_log(raw_rows(spark, d))
    fewer = [r for r in catalog.EVENT_ROLLUPS if not r.dims]
    for n, kept in enumerate((catalog.EVENT_ROLLUPS, fewer, catalog.EVENT_ROLLUPS)):
        RollupStore(root, kept)(
            events.where(f"kafka_offset % 3 = {n}"), Batch("s", "event_log", n)
        )
    return RollupStore(root, catalog.EVENT_ROLLUPS).rollup(spark, "traffic_10s")


@register("st12_native_traffic_10s")
def _(spark, d):
    # A watermark longer than the sample, so nothing is late.
    states = catalog.TRAFFIC_10S.stream_states(tb.event_log(_streamed(spark, d)), "1 day")
    root = scratch_dir(spark, "native")

    def keep(df, batch_id):
        df.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(
            f"{root}/states/batch_id={batch_id}"
        )

    _run(states, keep, root, output_mode="update")
    newest = F.max_by(F.struct("total", "errors"), "batch")
    return (
        spark.read.parquet(f"{root}/states")
        .groupBy("bucket")
        .agg(newest.alias("_newest"))
        .select("bucket", "_newest.*")
    )


@register("st2_st3_streamed_distinct_events")
def _(spark, d):
    tune(spark, streaming=True)
    root = scratch_dir(spark, "distinct")
    events = dedup.drop_repeats(
        tb.event_log(_streamed(spark, d)), ["service", "event_id"], watermark="2 hours"
    )
    each = MicroBatch(
        Delivery(ParquetTable(f"{root}/event_log", "kafka_received_at"),
                 SinkSettings(fail_on_error=True)),
        stream="event_log", table="event_log", stamps=False,
    )
    _run(events, each, root)
    return read_table(spark, f"{root}/event_log").select("service", "event_id")


@register("st3_watermark_with_bad_clocks")
def _(spark, d):
    """Every tenth event has a clock far in the future; none of the others may count as late."""
    tune(spark, streaming=True)
    root = scratch_dir(spark, "clocks")
    rows = tb.broker_rows(tb.events(spark, d)).selectExpr("offset * 3 + partition AS id", "*")
    payload = """concat('{"event_id":"ev-', id, '","service":"auth","ts_ms":',
        if(id % 10 = 0, if(id % 20 = 0, 9223372036854775807, 9223372036854775), 1704067200000), '}')"""
    rows = rows.withColumn("value", F.expr(f"CAST({payload} AS BINARY)"))
    # Three files in the order of arrival, one in each micro-batch.
    first, last = rows.select(F.unix_millis("timestamp").alias("at")).agg(F.min("at"), F.max("at")).first()
    third = F.expr(f"least(2, (unix_millis(timestamp) - {first}L) * 3 div greatest(1L, {last - first}L))")
    for n in range(3):
        rows.where(third == n).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1").parquet(f"{root}/in")
    events = dedup.drop_repeats(tb.event_log(stream), ["service", "event_id"], watermark="1 minute")
    each = MicroBatch(
        Delivery(ParquetTable(f"{root}/event_log", "kafka_received_at")),
        stream="event_log", table="event_log", stamps=False,
    )
    _run(events, each, root)
    return read_table(spark, f"{root}/event_log").select("event_id").distinct()


@register("k4_replayed_dead_letters")
def _(spark, d):
    """The batch of bad rows is sent again after the consumer has read it."""
    root = scratch_dir(spark, "replayed")
    _, bad = split_events(tb.replay_parse(raw_rows(spark, d), ()))
    to_topic = DeadLetterTopic(FileTopic(root, "logs.dlq"))
    to_table = MicroBatch(
        Delivery(ParquetTable(f"{root}/table", "kafka_received_at")),
        stream="dlq_table", table="event_log_dlq", skip_empty=True,
    )
    topic = StreamSettings(files_root=root)
    for _ in range(2):
        to_topic.write(bad, Batch("dlq", "logs.dlq", 0, "replayed"))
        _run(quarantine.parse_dlq(topic_stream(spark, topic, "logs.dlq")), to_table, f"{root}/consumer")
    return read_table(spark, f"{root}/table").select(
        "event_id", "source_topic", "source_partition", "source_offset", "source_key",
        "event_timestamp", "error_type", "raw_json",
    )


@register("k3_k4_doubled_messages")
def _(spark, d):
    """A producer that sends every message twice, in batches of their own: rows are stored once."""
    tune(spark, streaming=True)
    root = scratch_dir(spark, "doubled")
    _, bad = split_events(tb.replay_parse(raw_rows(spark, d), ()))
    bad = bad.persist()  # sent four times; the text of all rows is read for the first alone
    topic, table = DeadLetterTopic(FileTopic(root, "logs.dlq")), ParquetTable(f"{root}/table", "kafka_received_at")
    store = RollupStore(f"{root}/rollups", catalog.DLQ_ROLLUPS)
    to_table = MicroBatch(
        Delivery(table), stream="dlq_table", table="event_log_dlq", skip_empty=True, then=[store],
    )
    for n in range(2):
        topic.write(bad, Batch("dlq", "logs.dlq", n, "doubled"))
        topic.write(bad.where("partition = 0"), Batch("dlq", "logs.dlq", 10 + n, "doubled"))
        rows = topic_stream(spark, StreamSettings(files_root=root), "logs.dlq")
        _run(quarantine.parse_dlq(rows, once_within="1 hour"), to_table, f"{root}/consumer")
    bad.unpersist()
    stored = read_table(spark, table.path).groupBy("source_topic", "error_type").agg(F.count("*").alias("n"))
    total = store.rollup(spark, "dlq_1m").agg(F.sum("total")).scalar()
    return stored.withColumn("rolled_up", total)


@register("k11_expired_folders")
def _(spark, d):
    """Day folders that expiry keeps, for every table."""
    root = scratch_dir(spark, "days")
    days = tb.events(spark, d).select(F.to_date("ts").alias("day"), "event_id")
    days.write.partitionBy("day").parquet(root)
    as_of = days.agg(F.max("day")).first()[0]
    kept = spark.read.parquet(root).select(F.col("day").cast("string").alias("day")).distinct()
    found = []
    for name, keep in retention.KEEP.items():
        gone = retention.drop_expired(spark, root, keep, as_of, dry_run=True)
        gone = [folder.partition("=")[2] for folder in gone]
        found.append(kept.where(~F.col("day").isin(gone)).select(F.lit(name).alias("table_name"), "day"))
    return union_states(found)


@register("k3_k4_s4_streamed_dead_letters")
def _(spark, d):
    """Bad rows to the topic in one query, topic to table in another."""
    root = scratch_dir(spark, "dead")
    _, bad = split_events(tb.replay_parse(_streamed(spark, d)))
    to_topic = MicroBatch(
        Delivery(DeadLetterTopic(FileTopic(root, "logs.dlq")), SinkSettings(fail_on_error=True)),
        stream="dlq_kafka", table="dlq_kafka", skip_empty=True, stamps=False,
    )
    _run(bad, to_topic, f"{root}/producer")
    topic = StreamSettings(files_root=root)
    to_table = MicroBatch(
        Delivery(ParquetTable(f"{root}/table", "kafka_received_at"),
                 SinkSettings(fail_on_error=True)),
        stream="dlq_table", table="event_log_dlq", skip_empty=True,
    )
    _run(quarantine.parse_dlq(topic_stream(spark, topic, "logs.dlq")), to_table, f"{root}/consumer")
    return read_table(spark, f"{root}/table").select(
        "event_id", "source_topic", "source_partition", "source_offset", "source_key",
        "event_timestamp", "error_type", "raw_json",
    )


@register("st13_st14_streamed_alerts")
def _(spark, d):
    tune(spark, streaming=True)
    root = scratch_dir(spark, "alerts")
    readings = _readings(spark, d)
    readings.write.parquet(f"{root}/readings")
    stream = spark.readStream.schema(readings.schema).parquet(f"{root}/readings")

    def keep(df, batch_id):
        df.write.mode("overwrite").parquet(f"{root}/alerts/batch_id={batch_id}")

    # All files in one batch: readings of a key must not overtake each other.
    _run(alerts.in_stream(stream, ALERTS), keep, root)
    return spark.read.parquet(f"{root}/alerts").drop("batch_id")


@register("st13_st14_streamed_silent_alerts")
def _(spark, d):
    """Alerts that fall due without a reading, from timers; the newest reading sets the watermark."""
    tune(spark, streaming=True)
    root = scratch_dir(spark, "silent")
    changes = _changes(spark, d)
    changes.write.parquet(f"{root}/readings")
    stream = spark.readStream.schema(changes.schema).parquet(f"{root}/readings")

    def keep(df, batch_id):
        df.write.mode("overwrite").parquet(f"{root}/alerts/batch_id={batch_id}")

    _run(watched_stream(stream, Watch(ALERTS), "0 seconds"), keep, root)
    return spark.read.parquet(f"{root}/alerts").drop("batch_id")
