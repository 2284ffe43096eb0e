"""Streams against their batch twins: same rows, idempotent replays, failure paths."""

from __future__ import annotations

import os
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from logpulse import registry, testbed as tb
from logpulse.config import DlqSettings, FactSettings, SinkSettings, StreamSettings, TelemetrySettings
from logpulse.operators.normalize import normalize_events
from logpulse.operators.parse import good_events, parse_events
from logpulse.operators.dedup import keep_latest
from logpulse.plans.catalog import EVENT_ROLLUPS, EVENT_STATES, TRAFFIC_1M, TRAFFIC_10S
from logpulse.schema import BROKER_ROW, EVENT_LOG_COLUMNS, names
from logpulse.sources import storage, telemetry
from logpulse.sources.tables import read_table
from logpulse.sources.views import register_views
from logpulse.streaming.alerts import AlertRule, LevelRule, in_order, in_stream
from logpulse.streaming.batch import Batch
from logpulse.streaming.delivery import Delivery, Outcome, partitioned
from logpulse.streaming.guard import FileCommitLog, not_committed
from logpulse.streaming.ingest import Ingest, backfill
from logpulse.streaming.maintenance import close_rollup_day, downsample, expire, expire_guard, settle_day
from logpulse.streaming.microbatch import MicroBatch, start
from logpulse.streaming.rollup_store import RollupStore
from logpulse.streaming.silence import Watch, watched, watched_stream
from logpulse.streaming.targets import FileTopic, ParquetTable

from conftest import SF_DIR


@pytest.fixture(scope="module")
def topics(spark):
    """The sample as topic folders, several files each."""
    from logpulse.session import scratch_dir

    root = scratch_dir(spark, "topics")
    raw = tb.broker_rows(tb.events(spark, SF_DIR)).select(*names(BROKER_ROW))
    for service in ("auth", "order", "payment"):
        topic = f"logs.{service}"
        raw.where(F.col("topic") == topic).repartition(2).write.parquet(f"{root}/{topic}/first")
    return root


def settings(topics, **more):
    return StreamSettings(
        fact_topics="logs.auth,logs.order,logs.payment",
        dlq_topic="logs.dlq",
        files_root=topics,
        **more,
    )


def ingest(spark, topics, folder, **more):
    stream = more.pop("stream", None) or settings(topics)
    return Ingest(
        spark,
        checkpoints=f"{folder}/checkpoints",
        stream=stream,
        sink=SinkSettings(root=f"{folder}/tables", fail_on_error=True),
        once=True,
        **more,
    )


def copy_topics(spark, topics, folder):
    """Own dead-letter topic per test: the topics are linked by copying their files."""
    for service in ("auth", "order", "payment"):
        spark.read.schema(BROKER_ROW).option("recursiveFileLookup", "true").parquet(
            f"{topics}/logs.{service}"
        ).repartition(2).write.parquet(f"{folder}/topics/logs.{service}/first")
    return f"{folder}/topics"


CONTENT = [c for c in EVENT_LOG_COLUMNS if c not in ("spark_received_at", "spark_processed_at")]


def bag(df, columns):
    return sorted(map(str, df.select(*columns).collect()))


@pytest.mark.parametrize("combined", [True, False])
def test_stream_stores_what_batch_computes(spark, topics, folder, combined):
    topics = copy_topics(spark, topics, folder)
    app = ingest(
        spark,
        topics,
        folder,
        combined=combined,
        files_per_trigger=2,
        telemetry=TelemetrySettings(
            timing_log=f"{folder}/timing.log",
            progress_log=f"{folder}/progress.log",
            vitals_table=f"{folder}/vitals",
        ),
    )
    app.run()
    stored = read_table(spark, f"{folder}/tables/event_log")
    raw = tb.broker_rows(tb.events(spark, SF_DIR))
    expected = normalize_events(good_events(parse_events(raw)))
    assert bag(stored, CONTENT) == bag(expected, CONTENT)
    # Stamps are in order and at millisecond precision.
    assert (
        stored.where(
            "spark_received_at IS NULL OR spark_processed_at IS NULL OR stored_at IS NULL OR "
            "spark_processed_at > stored_at OR unix_micros(stored_at) % 1000 <> 0"
        ).count()
        == 0
    )
    # Bad rows went through the topic into the dead-letter table.
    dead = read_table(spark, f"{folder}/tables/event_log_dlq")
    columns = ["event_id", "source_topic", "source_key", "error_type", "raw_json"]
    assert bag(dead, columns) == bag(tb.dead_letters(raw), columns)
    # Rollups kept per batch answer as one computed over everything.
    store = RollupStore(f"{folder}/tables/rollups/event_log", EVENT_ROLLUPS)
    kept = store.rollup(spark, "traffic_1m")
    assert bag(kept, TRAFFIC_1M.columns) == bag(TRAFFIC_1M.states(expected), TRAFFIC_1M.columns)
    lag = store.rollup(spark, "lag_1m").agg(F.sum("cnt"), F.sum("sum_lag")).first()
    assert lag[0] == expected.count() and lag[1] >= 0
    # Everything stored can be asked in SQL.
    views = register_views(spark, f"{folder}/tables", prefix="stored_")
    assert len(views) == 2 + len(EVENT_ROLLUPS) + 1
    answer = spark.sql(
        "SELECT kll_sketch_get_quantile_double(kll_merge_agg_double(e2e_ms), 0.95D) AS p95, "
        "(SELECT sum(total) FROM stored_traffic_1m) AS n, (SELECT count(*) FROM stored_event_log) "
        "AS stored, (SELECT sum(total) FROM stored_dlq_1m) AS dead FROM stored_latency_stage_10s"
    ).first()
    assert answer.p95 > 0 and answer.n == answer.stored == expected.count()
    assert answer.dead == dead.count()
    # The run's own metrics are a table, gathered on the way to the sinks.
    vitals = telemetry.batch_vitals(spark, f"{folder}/vitals").groupBy("stream").agg(F.sum("rows"), F.max("newest"), F.sum("late_rows"))
    told = {r[0]: tuple(r)[1:] for r in vitals.collect()}
    newest = expected.agg(F.max("kafka_received_at")).first()[0]
    assert told["event_log"] == (expected.count(), newest, 0)
    assert told["dlq_kafka"][0] == told["dlq_table"][0] == dead.count()
    # The timing lines parse.
    lines = telemetry.timings(spark, f"{folder}/timing.log")
    stages = {r.stage for r in lines.where("table = 'event_log'").select("stage").collect()}
    assert stages == {"transform", "write"}
    # So do the progress lines; the listener is told asynchronously.
    for _ in range(50):
        seen = telemetry.progress(spark, f"{folder}/progress.log")
        events = {r.event for r in seen.select("event").collect()}
        if events == {"started", "progress", "terminated"}:
            break
        time.sleep(0.2)
    assert events == {"started", "progress", "terminated"}
    read = seen.where("query = 'event_log_stream'").agg(F.sum("numInputRows")).first()[0]
    assert read == raw.count()


def test_running_until_stopped(spark, topics, folder):
    """Processing-time triggers, and queries that keep running."""
    app = ingest(
        spark,
        copy_topics(spark, topics, folder),
        folder,
        fact=FactSettings(trigger="200 milliseconds"),
        dlq=DlqSettings(table_trigger="200 milliseconds", topic_trigger="200 milliseconds"),
        combined=False,
    )
    app.once = False
    queries = app.start()
    try:
        assert [q.name for q in queries] == [
            "event_log_stream", "event_log_dlq_kafka_stream", "event_log_dlq_stream",
        ]
        for query in queries:
            query.processAllAvailable()
        dead = read_table(spark, f"{folder}/tables/event_log_dlq").count()
        assert dead == tb.dead_letters(tb.broker_rows(tb.events(spark, SF_DIR))).count()
        assert all(q.isActive for q in queries)
    finally:
        for query in queries:
            query.stop()


def test_native_windows_drop_what_is_late(spark, folder):
    """The opt-in mode; per-batch maintenance has no cut-off (see the rollup store)."""
    rows = "kafka_received_at TIMESTAMP, event_id STRING, status_code INT"
    at = F.timestamp_seconds(F.col("s"))
    for n, seconds in enumerate(([0, 5, 100], [200], [3, 400])):
        df = spark.createDataFrame([(s,) for s in seconds], "s INT").select(
            at.alias("kafka_received_at"), F.lit("e").alias("event_id"), F.lit(500).alias("status_code")
        )
        df.coalesce(1).write.parquet(f"{folder}/in/{n}")
        time.sleep(0.05)
    stream = (
        spark.readStream.schema(rows)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", "1")
        .parquet(f"{folder}/in")
    )

    def keep(df, batch_id):
        df.write.mode("append").parquet(f"{folder}/out")

    states = TRAFFIC_10S.stream_states(stream, "10 seconds")
    start(states, keep, f"{folder}/checkpoint", once=True).awaitTermination()
    got = {
        int(r.bucket.timestamp()): (r.total, r.errors)
        for r in spark.read.parquet(f"{folder}/out").collect()
    }
    # 3 s arrived after its bucket was closed and emitted.
    assert got[0] == (2, 2) and got[100] == (1, 1)


def test_restart_takes_only_new_files(spark, topics, folder):
    topics = copy_topics(spark, topics, folder)
    app = ingest(spark, topics, folder, stream=settings(topics, enable_dlq=False))
    app.run()
    before = read_table(spark, f"{folder}/tables/event_log").count()
    app.run()
    assert read_table(spark, f"{folder}/tables/event_log").count() == before
    more = tb.broker_rows(tb.events(spark, SF_DIR).where("event_id < 100"), repeats=False)
    more.select(*names(BROKER_ROW)).write.parquet(f"{topics}/logs.auth/second")
    app.run()
    added = good_events(parse_events(more)).count()
    assert read_table(spark, f"{folder}/tables/event_log").count() == before + added


def test_crash_before_the_checkpoint_commit_changes_nothing(spark, topics, folder):
    """The last batch is delivered again after a restart, and replaces itself."""
    topics = copy_topics(spark, topics, folder)
    app = ingest(
        spark, topics, folder, stream=settings(topics, enable_dlq=False), files_per_trigger=2
    )
    app.run()

    def state():
        stored = read_table(spark, f"{folder}/tables/event_log")
        kept = RollupStore(f"{folder}/tables/rollups/event_log", EVENT_ROLLUPS)
        return bag(stored, [*CONTENT, "batch_key"]), bag(
            kept.rollup(spark, "traffic_1m"), TRAFFIC_1M.columns
        )

    before = state()
    commits = f"{folder}/checkpoints/event_log/commits"
    names_ = [n for n in os.listdir(commits) if n.isdigit()]
    assert len(names_) > 1
    last = max(names_, key=int)
    os.remove(f"{commits}/{last}")
    if os.path.exists(f"{commits}/.{last}.crc"):
        os.remove(f"{commits}/.{last}.crc")
    app.run()
    assert os.path.exists(f"{commits}/{last}")
    assert state() == before


def test_stateful_deduplication_drops_replays(spark, topics, folder):
    topics = copy_topics(spark, topics, folder)
    app = ingest(
        spark,
        topics,
        folder,
        stream=settings(topics, enable_dlq=False),
        fact=FactSettings(dedup_keys=("service", "event_id"), dedup_watermark="2 hours"),
        files_per_trigger=2,
    )
    app.run()
    stored = read_table(spark, f"{folder}/tables/event_log")
    raw = tb.broker_rows(tb.events(spark, SF_DIR))
    expected = tb.event_log(raw).select("service", "event_id").distinct().count()
    assert stored.count() == expected < tb.event_log(raw).count()


def test_per_batch_deduplication(spark, topics, folder):
    topics = copy_topics(spark, topics, folder)
    app = ingest(
        spark,
        topics,
        folder,
        stream=settings(topics, enable_dlq=False),
        fact=FactSettings(dedup_keys=("service", "event_id"), skip_empty=True),
    )
    app.run()  # one batch
    stored = read_table(spark, f"{folder}/tables/event_log")
    assert stored.count() == stored.select("service", "event_id").distinct().count()


# --- delivery ---------------------------------------------------------------------------------
ROWS = "event_id STRING, service STRING, request_id STRING, kafka_received_at TIMESTAMP"


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [("a", "auth", "r1"), ("b", "order", "r2")], "event_id STRING, service STRING, request_id STRING"
    ).withColumn("kafka_received_at", F.timestamp_seconds(F.lit(1_704_067_200)))


class Flaky:
    """Refuses the first ``failures`` writes, then hands on to ``target``."""

    def __init__(self, target, failures):
        self.target, self.failures, self.calls = target, failures, 0

    def write(self, df, batch):
        self.calls += 1
        if self.calls <= self.failures:
            raise RuntimeError("x" * 3000)
        self.target.write(df, batch)


def table(folder):
    return ParquetTable(f"{folder}/t", "kafka_received_at", ("service",))


def test_replay_overwrites_its_own_batch(spark, rows, folder):
    deliver = Delivery(table(folder))
    for n in (0, 1, 1, 0):
        assert deliver(rows, Batch("s", "t", n, "q1")) is Outcome.WRITTEN
    assert spark.read.parquet(f"{folder}/t").count() == 4
    # A new query starts counting at zero again: its batch 0 is not a replay.
    deliver(rows, Batch("s", "t", 0, "q2"))
    assert spark.read.parquet(f"{folder}/t").count() == 6


def test_guard_skips_committed_batches(spark, rows, folder):
    guard = FileCommitLog(f"{folder}/guard")
    guard.create(spark)
    target = Flaky(table(folder), 0)
    deliver = Delivery(target, guard=guard)
    batch = Batch("s", "t", 7, "q")
    assert deliver(rows, batch) is Outcome.WRITTEN
    assert deliver(rows, batch) is Outcome.SKIPPED
    assert target.calls == 1
    # Recovery over many batches at once.
    wanted = spark.createDataFrame(
        [("s", "t", "q", 7), ("s", "t", "q", 8)],
        "stream_name STRING, target_table STRING, query_id STRING, batch_id BIGINT",
    )
    left = not_committed(wanted, spark.read.parquet(f"{folder}/guard"))
    assert [r.batch_id for r in left.collect()] == [8]


def test_missing_guard_is_switched_off(rows, folder):
    deliver = Delivery(table(folder), guard=FileCommitLog(f"{folder}/nowhere"))
    assert deliver(rows, Batch("s", "t", 0)) is Outcome.WRITTEN
    assert deliver.guard is None


class BrokenGuard:
    def seen(self, spark, batch):
        return False

    def mark(self, spark, batch):
        raise RuntimeError("guard down")


def test_written_but_unmarked_is_not_retried(rows, folder):
    target = Flaky(table(folder), 0)
    quiet = Delivery(target, SinkSettings(retry_max=3, fail_on_error=False), guard=BrokenGuard())
    assert quiet(rows, Batch("s", "t", 0)) is Outcome.UNMARKED
    assert target.calls == 1
    strict = Delivery(target, SinkSettings(fail_on_error=True), guard=BrokenGuard())
    with pytest.raises(RuntimeError, match="guard down"):
        strict(rows, Batch("s", "t", 1))
    assert target.calls == 2


def test_retry_then_success(rows, folder):
    target = Flaky(table(folder), 2)
    assert Delivery(target, SinkSettings(retry_max=2))(rows, Batch("s", "t", 0)) is Outcome.WRITTEN
    assert target.calls == 3


def test_final_failure_bypasses_to_dead_letters(spark, rows, folder):
    deliver = Delivery(
        Flaky(None, 9), SinkSettings(retry_max=1), bypass=FileTopic(folder, "logs.dlq")
    )
    assert deliver(rows, Batch("s", "t", 0)) is Outcome.BYPASSED
    value = F.col("value").cast("string")
    sent = spark.read.parquet(f"{folder}/logs.dlq/*").select(
        F.col("key").cast("string"),
        F.get_json_object(value, "$.error_type").alias("kind"),
        F.length(F.get_json_object(value, "$.error_message")).alias("length"),
        F.get_json_object(value, "$.created_ms").alias("created"),
        F.get_json_object(value, "$.raw_json").alias("raw"),
    )
    got = {r.key: r for r in sent.collect()}
    assert set(got) == {"a", "b"}
    assert got["a"].kind == "sink_write_failed" and got["a"].length == 3000
    assert got["a"].created == "1704067200000" and '"request_id":"r1"' in got["a"].raw


@pytest.mark.parametrize("fail, outcome", [(True, None), (False, Outcome.LOST)])
def test_final_failure_without_bypass(rows, fail, outcome):
    deliver = Delivery(Flaky(None, 9), SinkSettings(fail_on_error=fail))
    if fail:
        with pytest.raises(RuntimeError):
            deliver(rows, Batch("s", "t", 0))
    else:
        assert deliver(rows, Batch("s", "t", 0)) is outcome


def test_empty_batches_are_skipped(spark, rows, folder):
    target = Flaky(table(folder), 0)
    each = MicroBatch(Delivery(target), stream="s", table="t", skip_empty=True)
    each(rows.where("false"), 0)
    assert target.calls == 0
    each(rows, 1)
    assert target.calls == 1


def test_rows_are_released_when_the_write_raises(spark, rows, folder):
    each = MicroBatch(
        Delivery(Flaky(None, 9), SinkSettings(fail_on_error=True)),
        stream="s", table="t", skip_empty=True,
    )
    held = rows.withColumn("n", F.lit(1))
    with pytest.raises(RuntimeError):
        each(held, 0)
    assert not held.is_cached


def test_partitions_without_counting(spark):
    df = spark.range(100, numPartitions=6)
    assert partitioned(df, None) is df
    assert partitioned(df, 2).rdd.getNumPartitions() == 2
    assert partitioned(df, 9).rdd.getNumPartitions() == 6
    assert partitioned(df, 9, allow_more=True).rdd.getNumPartitions() == 9
    assert partitioned(df, 4, allow_more=True, current=6).rdd.getNumPartitions() == 4


# --- rollup store -----------------------------------------------------------------------------
def test_rollup_store_replay_compaction_and_late_batches(spark, folder):
    log = tb.event_log(tb.broker_rows(tb.events(spark, SF_DIR))).cache()
    parts = [log.where(F.col("kafka_partition") == p) for p in range(3)]
    store = RollupStore(f"{folder}/rollups", EVENT_ROLLUPS)
    store(parts[0], Batch("s", "t", 0, "q"))
    store(parts[1], Batch("s", "t", 1, "q"))
    store(parts[1], Batch("s", "t", 1, "q"))  # replay
    seen = parts[0].unionByName(parts[1])

    def check(rows):
        for r in EVENT_ROLLUPS:
            plain = [c for c in r.columns if c == "max_ingest" or not c.endswith("_ms")]
            kept = store.rollup(spark, r.name)
            assert bag(kept, plain) == bag(r.states(rows), plain), r.name

    check(seen)
    for day in (date(2023, 12, 31), date(2024, 1, 1)):
        store.compact(spark, day)
    check(seen)
    merged = store.states(spark)
    assert merged.count() == merged.select(*store.shared.keys).distinct().count()
    store(parts[2], Batch("s", "t", 2, "q"))  # late: the day is already compacted
    check(log)
    store.compact(spark, date(2024, 1, 1))
    store.compact(spark, date(2024, 1, 1))
    check(log)
    # Times are cut to folders and row groups.
    since = datetime(2024, 1, 1, 0, 20)
    late = store.rollup(spark, "traffic_1m", since=since)
    assert bag(late, TRAFFIC_1M.columns) == bag(
        TRAFFIC_1M.states(log).where(F.col("bucket") >= F.lit(since)), TRAFFIC_1M.columns
    )
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = late._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(bucket_date" in plan
    assert "GreaterThanOrEqual(bucket_of__kafka_received_at" in plan
    created = store.rollup(spark, "created_stored_1m", since=since)
    assert created.count() == store.rollup(spark, "created_stored_1m").where(
        F.col("bucket") >= F.lit(since)
    ).count()
    # A range of days reads those folders only.
    assert store.states(spark, since=date(2024, 1, 2)).count() == 0


def test_rollups_can_be_switched_off(spark, folder):
    log = tb.event_log(tb.broker_rows(tb.events(spark, SF_DIR)))
    store = RollupStore(f"{folder}/rollups", [r for r in EVENT_ROLLUPS if r.name == "lag_1m"])
    store(log, Batch("s", "t", 0))
    assert store.rollup(spark, "lag_1m").count() > 0
    with pytest.raises(KeyError):
        store.rollup(spark, "traffic_1m")


def test_backfill_equals_the_stream(spark, topics, folder):
    raw = tb.broker_rows(tb.events(spark, SF_DIR)).select(*names(BROKER_ROW))
    backfill(raw, folder, "first-half")
    backfill(raw, folder, "first-half")
    stored = read_table(spark, f"{folder}/event_log")
    expected = normalize_events(good_events(parse_events(raw)))
    assert bag(stored, CONTENT) == bag(expected, CONTENT)
    dead = read_table(spark, f"{folder}/event_log_dlq")
    columns = ["kafka_received_at", "event_id", "source_offset", "error_type", "raw_json"]
    assert bag(dead, columns) == bag(tb.dead_letters(raw.withColumns(
        {c: F.lit(0) for c in tb.STAMPS})), columns)
    store = RollupStore(f"{folder}/rollups/event_log", EVENT_ROLLUPS)
    assert store.rollup(spark, "lag_1m").agg(F.sum("cnt")).first()[0] == expected.count()
    # No dead letters at all leaves empty tables, not errors.
    clean = raw.where(F.length("value") > 20)
    backfill(clean, f"{folder}/clean", "all")
    assert read_table(spark, f"{folder}/clean/event_log").count() == expected.count()


def test_a_backfill_uses_all_cores_and_may_find_no_event(spark, folder):
    raw = tb.broker_rows(tb.events(spark, SF_DIR)).select(*names(BROKER_ROW))
    # One small file, which one task reads: its texts are made and parsed by many.
    tasks = raw.select(F.spark_partition_id()).distinct().count()
    assert tasks >= spark.sparkContext.defaultParallelism
    backfill(raw.where(F.length("value") < 20), folder, "bad-rows", dead_letters=False)
    store = RollupStore(f"{folder}/rollups/event_log", EVENT_ROLLUPS)
    with pytest.raises(FileNotFoundError):
        store.rollup(spark, "lag_1m")
    backfill(raw, folder, "all", dead_letters=False)
    good = good_events(parse_events(raw)).count()
    assert store.rollup(spark, "lag_1m").agg(F.sum("cnt")).first()[0] == good


# --- stateful alerts --------------------------------------------------------------------------
@pytest.mark.parametrize(
    "rule",
    [
        AlertRule(grace_seconds=20, cooldown_seconds=60),
        LevelRule(up_streak=2, down_streak=2, cooldown_seconds=40),
    ],
    ids=["alerts", "levels"],
)
def test_rules_keep_their_state_across_batches(spark, folder, rule):
    readings = spark.range(0, 120).selectExpr(
        "concat('k', id % 2) key", "timestamp_seconds(id * 7) at", "pmod(hash(id), 4) > 0 breached",
        "CAST(pmod(hash(id), 4000) AS DOUBLE) lag_ms", "id",
    )
    for n in range(3):  # three files, three batches, in order of time
        readings.where(f"id BETWEEN {n * 40} AND {n * 40 + 39}").drop("id").coalesce(1).write.parquet(
            f"{folder}/in/{n}"
        )
        time.sleep(0.05)
    stream = (
        spark.readStream.schema(readings.drop("id").schema)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", "1")
        .parquet(f"{folder}/in")
    )

    def keep(df, batch_id):
        df.write.mode("append").parquet(f"{folder}/out")

    start(in_stream(stream, rule), keep, f"{folder}/checkpoint", once=True).awaitTermination()
    got = spark.read.parquet(f"{folder}/out")
    expected = in_order(readings, rule)
    assert bag(got, expected.columns) == bag(expected, expected.columns)
    assert got.select(*rule.columns).distinct().count() > 2


def silent_expected(readings, rule, idle, until):
    """Second by second: readings first, then whatever is due at that second."""
    out = []
    for key in {r[0] for r in readings}:
        own = sorted(r for r in readings if r[0] == key)
        since = fired = last = None
        for now in range(own[0][1], until + 1):
            for _, _, breached in [r for r in own if r[1] == now]:
                ready = breached and since is not None and now - since >= rule.grace_seconds
                fires = ready and (fired is None or now - fired >= rule.cooldown_seconds)
                since = None if not breached else now if since is None else since
                fired, last = now if fires else fired, now
                out.append((key, now, breached, ready, fires, False))
            waited = since is not None and now - since >= rule.grace_seconds and (fired is None or fired < since)
            if waited and (fired is None or now - fired >= rule.cooldown_seconds):
                fired = now
                out.append((key, now, True, True, True, True))
            if last is not None and idle is not None and now - last >= idle:
                since = fired = last = None
    return sorted(out)


@pytest.mark.parametrize("idle", [None, 45, 90])
def test_alerts_fall_due_without_a_reading_and_state_ends(spark, folder, idle):
    rule = AlertRule(grace_seconds=20, cooldown_seconds=60)
    rows = [("a", 0, True), ("b", 5, True), ("b", 25, False), ("c", 3, True), ("c", 9, False), ("c", 10, True),
            ("b", 31, True), ("b", 58, True), ("c", 70, False), ("c", 71, True), ("d", 80, False), ("b", 140, True),
            ("c", 149, True), ("d", 400, False), ("e", 900, False)]
    # Seconds of a later hour: the watermark of a new stream is the epoch.
    frame = spark.createDataFrame(rows, "key STRING, s INT, breached BOOLEAN").selectExpr(
        "key", "timestamp_seconds(3600 + s) AS at", "breached"
    )
    expected = silent_expected(rows, rule, idle, 900)
    assert any(r[5] for r in expected)

    def found(df):
        return sorted(map(tuple, df.selectExpr(
            "key", "CAST(unix_seconds(at) AS INT) - 3600", "breached", "ready", "fired", "silent").collect()))

    watch = Watch(rule, idle)
    until = frame.agg(F.max("at")).first()[0]
    assert found(watched(frame, watch, until)) == expected
    for first, last in ((0, 25), (31, 80), (140, 900)):  # batches in the order of the readings' times
        frame.where(f"unix_seconds(at) - 3600 BETWEEN {first} AND {last}").coalesce(1).write.parquet(f"{folder}/in/{last}")
        time.sleep(0.05)
    stream = (
        spark.readStream.schema(frame.schema)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", "1")
        .parquet(f"{folder}/in")
    )

    def keep(df, batch_id):
        df.write.mode("append").parquet(f"{folder}/out")

    query = start(watched_stream(stream, watch, "0 seconds"), keep, f"{folder}/checkpoint", once=True)
    query.awaitTermination()
    assert found(spark.read.parquet(f"{folder}/out")) == expected
    left = query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    assert (left == 0) == (idle is not None)  # without an idle time the open breaches of a, b and c stay


# --- maintenance ------------------------------------------------------------------------------
def test_settling_a_day_keeps_the_latest_and_merges_files(spark, folder):
    log = tb.event_log(tb.broker_rows(tb.events(spark, SF_DIR))).cache()
    table = ParquetTable(f"{folder}/t", "kafka_received_at", ("service", "event_id"))
    for n in range(3):
        part = log.where(F.col("kafka_partition") == n)
        table.write(part, Batch("s", "t", n, "q"))
    day = date(2024, 1, 1)
    expected = keep_latest(log, scope="partition").where(F.to_date("kafka_received_at") == F.lit(day))
    settled = settle_day(spark, table, day)
    assert bag(settled, EVENT_LOG_COLUMNS) == bag(expected, EVENT_LOG_COLUMNS)
    assert settled.select("batch_key").distinct().count() == 1
    # A replay of a settled batch only brings back repeats.
    table.write(log.where("kafka_partition = 0"), Batch("s", "t", 0, "q"))
    again = keep_latest(read_table(spark, table.path, since=day, until=day), scope="partition")
    assert bag(again, EVENT_LOG_COLUMNS) == bag(expected, EVENT_LOG_COLUMNS)


def test_closing_a_rollup_day_and_expiry(spark, folder):
    log = tb.event_log(tb.broker_rows(tb.events(spark, SF_DIR))).cache()
    store = RollupStore(f"{folder}/rollups/event_log", EVENT_ROLLUPS)
    for n in range(3):
        store(log.where(F.col("kafka_partition") == n), Batch("s", "t", n, "q"))
    day = date(2024, 1, 1)
    before = bag(store.rollup(spark, "lag_1m"), ["bucket", "cnt", "sum_lag"])
    close_rollup_day(spark, store, day)
    assert len(store.merged_batches(spark, day)) == 3
    assert storage.subfolders(spark, f"{store.path}/open/bucket_date=2024-01-01") == []
    assert bag(store.rollup(spark, "lag_1m"), ["bucket", "cnt", "sum_lag"]) == before
    ParquetTable(f"{folder}/event_log", "kafka_received_at").write(log, Batch("s", "t", 0))
    expected = {"event_log/ingest_date=2024-01-01"}
    assert set(expire(spark, folder, date(2024, 1, 4), dry_run=True)) == expected
    gone = expire(spark, folder, date(2024, 1, 8))
    assert expected <= set(gone) and any("rollups/event_log/closed" in name for name in gone)
    assert storage.subfolders(spark, f"{folder}/event_log") == []


def test_a_time_range_in_sql_reads_the_days_of_the_range(spark, folder):
    later = F.expr("kafka_received_at + make_dt_interval(kafka_offset % 5)")
    log = tb.event_log(tb.broker_rows(tb.events(spark, SF_DIR))).withColumn("kafka_received_at", later)
    store = RollupStore(f"{folder}/rollups/event_log", EVENT_ROLLUPS)
    store(log.where("kafka_partition = 0"), Batch("s", "t", 0, "q"))
    close_rollup_day(spark, store, date(2024, 1, 2))
    store(log.where("kafka_partition > 0"), Batch("s", "t", 1, "q"))
    register_views(spark, folder, prefix="ranged_")
    since, until = datetime(2024, 1, 2, 0, 10), datetime(2024, 1, 3, 0, 20)
    for r in EVENT_ROLLUPS:
        columns = [c for c in r.columns if not c.endswith("_ms")]
        ranged = spark.sql(f"SELECT * FROM ranged_{r.name}_between(TIMESTAMP '{since}', TIMESTAMP '{until}')")
        assert ranged.columns == r.columns
        assert bag(ranged, columns) == bag(store.rollup(spark, r.name, since=since, until=until), columns)
    sql = "SELECT sum(total) AS n FROM ranged_traffic_1m"
    for ask, wanted in (
        (f"{sql}_between(TIMESTAMP '{since}', TIMESTAMP '{until}')", "2024-01-03"),
        (f"{sql}_between(now() - INTERVAL 5 MINUTES, now())", f"{date.today():%Y}"),
        (f"{sql} WHERE bucket_date = DATE '2024-01-04' AND bucket > TIMESTAMP '{since}'", "2024-01-04"),
    ):
        frame = spark.sql(ask)
        frame.collect()
        lines = frame._jdf.queryExecution().executedPlan().toString().splitlines()
        filters = [x.partition("PartitionFilters: [")[2].partition("]")[0] for x in lines if "PartitionFilters" in x]
        assert filters and all("bucket_date" in f and wanted in f for f in filters), filters


def test_a_stored_batch_is_read_from_its_own_folders(spark, folder):
    rows = tb.event_log(tb.broker_rows(tb.events(spark, SF_DIR)), ["kafka_received_at", "kafka_offset", "kafka_partition"])
    table = ParquetTable(folder, "kafka_received_at")
    for n, query in enumerate(["q", "a b:c"]):
        table.write(rows.where(F.col("kafka_partition") == n), Batch("s", "t", n, query))
        own = table.stored(spark, Batch("s", "t", n, query))
        assert own.count() == rows.where(F.col("kafka_partition") == n).count()
    files = table.stored(spark, Batch("s", "t", 0, "q")).inputFiles()
    assert files and all("batch_key=q-0" in f for f in files)
    assert table.stored(spark, Batch("s", "t", 7, "q")).count() == 0


def test_days_are_kept_in_wider_buckets_once_fine_rollups_expired(spark, folder):
    log = tb.event_log(tb.broker_rows(tb.events(spark, SF_DIR))).cache()
    store, day = RollupStore(f"{folder}/rollups/event_log", EVENT_ROLLUPS), date(2024, 1, 1)
    store(log.where("kafka_partition < 2"), Batch("s", "t", 0, "q"))
    fine, closed = store.rollup(spark, "traffic_10s").count(), f"{store.path}/closed/bucket_date=2024-01-01"
    close_rollup_day(spark, store, day)
    narrow = spark.read.parquet(closed).count()
    assert fine > 0 and downsample(spark, store, day) == []  # still that day
    expire(spark, folder, date(2024, 1, 2))
    assert store.rollup(spark, "traffic_10s").count() == 0
    assert spark.read.parquet(closed).count() < narrow
    assert downsample(spark, store, date(2024, 1, 3)) == []  # nothing new
    # A late batch is counted, first as it came and then merged; ten seconds stay gone.
    store(log.where("kafka_partition = 2"), Batch("s", "t", 1, "q"))
    expected = bag(EVENT_STATES.rollup(EVENT_STATES.states(log), "lag_1m"), ["bucket", "cnt", "sum_lag"])
    assert bag(store.rollup(spark, "lag_1m"), ["bucket", "cnt", "sum_lag"]) == expected
    assert downsample(spark, store, date(2024, 1, 3)) == [day]
    assert bag(store.rollup(spark, "lag_1m"), ["bucket", "cnt", "sum_lag"]) == expected
    assert store.rollup(spark, "latency_stage_10s").count() == 0
    store.compact(spark, day)  # a plain compaction keeps the width
    assert store.width(spark, "bucket_date=2024-01-01") == 60
    assert bag(store.rollup(spark, "lag_1m"), ["bucket", "cnt", "sum_lag"]) == expected
    gone = expire(spark, folder, date(2024, 1, 8))
    assert any("closed" in name for name in gone)


def test_expiry_includes_the_guard(spark, folder):
    log = FileCommitLog(f"{folder}/stream_batch_guard")
    log.create(spark)
    log.mark(spark, Batch("s", "t", 1, "q"))
    tomorrow = date.today()
    expire(spark, folder, tomorrow)
    assert log.seen(spark, Batch("s", "t", 1, "q"))
    expire(spark, folder, date(tomorrow.year + 1, 12, 31))
    assert not log.seen(spark, Batch("s", "t", 1, "q"))


def test_compaction_that_dies_half_way_is_harmless(spark, folder, monkeypatch):
    log = tb.event_log(tb.broker_rows(tb.events(spark, SF_DIR))).cache()
    store, day = RollupStore(f"{folder}/rollups", EVENT_ROLLUPS), date(2024, 1, 1)
    for n in range(2):
        store(log.where(F.col("kafka_partition") == n), Batch("s", "t", n, "q"))
    store.compact(spark, day)
    before = bag(store.rollup(spark, "lag_1m"), ["bucket", "cnt", "sum_lag"])

    def dies(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(storage, "delete", dies)  # between publishing and tidying up
        with pytest.raises(RuntimeError):
            store.compact(spark, day)
    assert bag(store.rollup(spark, "lag_1m"), ["bucket", "cnt", "sum_lag"]) == before
    versions = f"{store.path}/closed/bucket_date=2024-01-01"
    assert len(storage.subfolders(spark, versions)) == 2
    unfinished = f"{versions}/version=99991231"  # no _SUCCESS
    spark.range(5).write.parquet(unfinished)
    storage.delete(spark, f"{unfinished}/_SUCCESS")
    assert bag(store.rollup(spark, "lag_1m"), ["bucket", "cnt", "sum_lag"]) == before
    days = [p for p in store.rollup(spark, "lag_1m", since=datetime(2030, 1, 1)).inputFiles()]
    assert days == []  # no folder of another day is listed


def test_guarded_replay_hands_on_the_stored_stamps(rows, folder, spark):
    guard = FileCommitLog(f"{folder}/guard")
    guard.create(spark)
    target = ParquetTable(f"{folder}/t", "kafka_received_at")
    stamps = []
    each = MicroBatch(
        Delivery(target, guard=guard), stream="s", table="t",
        then=[lambda df, batch: stamps.append(df.agg(F.min("stored_at"), F.count("*")).first())],
    )
    for _ in range(2):
        each(rows, 0)
    assert each.outcome is Outcome.SKIPPED and stamps[0] == stamps[1] and stamps[0][1] == 2
    assert expire_guard(spark, guard, date.today()) == 0
    assert expire_guard(spark, guard, date(2999, 1, 1)) == 1
    assert not guard.seen(spark, Batch("s", "t", 0))


def test_rollups_need_a_place(spark, folder):
    with pytest.raises(ValueError, match="SPARK_SINK_ROOT"):
        Ingest(spark, folder, sink=SinkSettings(url="jdbc:derby:memory:x"), dlq=DlqSettings(), stream=StreamSettings(enable_dlq=False))


def test_derived_tables_of_a_large_batch_are_read_back(spark, folder):
    events = tb.event_log(tb.broker_rows(tb.events(spark, SF_DIR)))
    table, given = ParquetTable(f"{folder}/t", "kafka_received_at"), []

    def follow(df, batch):
        plan = df._jdf.queryExecution().withCachedData().toString()
        given.append((df.count(), df.columns, "InMemoryRelation" in plan, len(df.inputFiles())))

    each = MicroBatch(Delivery(table), stream="s", table="t", stamps=False, then=[follow], reread=True)
    each(events.limit(0), 0)
    each(events, 1)
    assert [g[0] for g in given] == [0, events.count()]
    assert all(g[1] == events.columns and not g[2] for g in given) and given[1][3] > 0


def test_messages_sent_again_are_made_of_text_read_once(spark, monkeypatch):
    held = []

    class Topic(registry.DeadLetterTopic):
        def write(self, df, batch):
            held.append("InMemoryRelation" in df._jdf.queryExecution().withCachedData().toString())
            super().write(df, batch)

    monkeypatch.setattr(registry, "DeadLetterTopic", Topic)
    registry.QUERIES["k3_k4_doubled_messages"](spark, SF_DIR)
    assert held == [True] * 4
