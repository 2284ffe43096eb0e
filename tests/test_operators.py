"""Operators on small literal frames: the corner cases."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logpulse import testbed as tb
from logpulse.functions.ids import stable_event_id
from logpulse.functions.latency import STAGES
from logpulse.functions.quantiles import exact_quantiles, sketch_quantile
from logpulse.functions.timebuckets import bucket_of, lag_seconds, to_millis
from logpulse.operators import dedup, observe, quarantine, routing
from logpulse.operators.normalize import normalize_events, payload_fields
from logpulse.operators.parse import good_events, parse_events, split_events
from logpulse.plans import catalog, retention, serve, thresholds
from logpulse.plans.rollups import SharedStates
from logpulse.schema import BROKER_ROW, EVENT_LOG_COLUMNS
from logpulse.sources import telemetry
from logpulse.streaming.alerts import AlertRule, LevelRule, in_order, sustained_breaches

from conftest import SF_DIR

T0 = datetime(2024, 1, 1, 12, 0, 0)


def raw(spark, *values, topic="logs.auth", partition=1, offset=5, at=T0):
    rows = [
        (b"k", None if v is None else v.encode(), topic, partition, offset, at) for v in values
    ]
    return spark.createDataFrame(rows, BROKER_ROW)


def normalized(spark, value, mode="strict", **broker):
    good = good_events(parse_events(raw(spark, value, **broker), mode=mode))
    return normalize_events(good).collect()


# --- parsing ----------------------------------------------------------------------------------
MALFORMED = ["garbage", '{"a":1', "null", '"str"', "[]", "12", '[{"event_id":"x"}]']
EMPTY = [None, "", "   "]
OBJECTS = ["{}", '{"other":1}', '{"event_id":"x"}', '{"amount":12.0}', '{"ts_ms":"x"}']


@pytest.mark.parametrize(
    "mode, bad", [("strict", MALFORMED + EMPTY), ("permissive", EMPTY)], ids=["strict", "permissive"]
)
def test_split(spark, mode, bad):
    values = MALFORMED + EMPTY + OBJECTS
    good_rows, bad_rows = split_events(parse_events(raw(spark, *values), mode=mode))
    wrong = [r.raw_json for r in bad_rows.collect()]
    right = [r.raw_json for r in good_rows.collect()]
    if mode == "permissive":
        # An array of objects parses as its first element's row or as an empty one.
        assert set(EMPTY) == set(wrong)
    else:
        assert sorted(map(str, wrong)) == sorted(map(str, bad))
    assert len(wrong) + len(right) == len(values)
    first = bad_rows.first()
    assert first.error_type == "json_parse_failed"
    assert first.error_message == "value is not valid JSON"


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="mode"):
        parse_events(raw(spark, "{}"), mode="lenient")


def test_mistyped_field_is_null_and_others_stay(spark):
    (row,) = normalized(spark, '{"amount":12.5,"event_id":"x","ts_ms":"soon","user_id":7}')
    assert (row.amount, row.event_id, row.user_id) == (None, "x", 7)
    assert row.event_timestamp == T0  # falls back to the broker's time


def test_malformed_row_in_permissive_mode_gets_all_defaults(spark):
    (row,) = normalized(spark, "garbage", "permissive")
    assert (row.service, row.event_name, row.result, row.status_code) == (
        "unknown", "unknown", "unknown", 0,
    )
    assert row.event_id == "logs.auth-1-5"


def test_pruned_parsing_agrees_with_full(spark):
    values = MALFORMED + EMPTY + OBJECTS + ['{"service":"a","status_code":503}']
    columns = ["service", "status_code", "result"]
    fields = payload_fields(columns)
    assert set(fields) == {"service", "status_code", "result"}
    whole = normalize_events(good_events(parse_events(raw(spark, *values)))).select(*columns)
    narrow = normalize_events(
        good_events(parse_events(raw(spark, *values), fields=fields)), columns=columns
    )
    assert sorted(map(str, whole.collect())) == sorted(map(str, narrow.collect()))


# --- normalisation ----------------------------------------------------------------------------
@pytest.mark.parametrize(
    "payload, result, status",
    [
        ('{"status_code":399}', "success", 399),
        ('{"status_code":400}', "fail", 400),
        ("{}", "unknown", 0),
        ('{"result":"fail"}', "fail", 500),
        ('{"result":"success"}', "success", 200),
        ('{"result":"odd"}', "odd", 0),
        ('{"result":"success","status_code":503}', "success", 503),
    ],
)
def test_result_and_status_infer_each_other(spark, payload, result, status):
    (row,) = normalized(spark, payload)
    assert (row.result, row.status_code) == (result, status)


@pytest.mark.parametrize(
    "broker, event_id",
    [
        ({}, "logs.auth-1-5"),
        ({"topic": None}, "unknown"),
        ({"partition": None}, "unknown"),
        ({"offset": None}, "unknown"),
    ],
)
def test_event_id_falls_back_to_coordinates(spark, broker, event_id):
    (row,) = normalized(spark, "{}", **broker)
    assert row.event_id == event_id


def test_defaults_and_contract(spark):
    (row,) = normalized(spark, '{"path":"/p","timestamp_ms":1704110400123}')
    assert list(row.asDict()) == list(EVENT_LOG_COLUMNS)
    assert (row.route_template, row.path, row.level, row.method) == ("/p", "/p", "INFO", "")
    assert (row.service, row.api_group, row.request_id) == ("unknown",) * 3
    assert row.event_timestamp == datetime(2024, 1, 1, 12, 0, 0, 123000)
    assert row.spark_processed_at is None and row.raw_json == "" and row.kafka_offset == 5
    stored = normalize_events(
        good_events(parse_events(raw(spark, '{"a":1}'))), store_raw_json=True
    ).first()
    assert stored.raw_json == '{"a":1}'


def test_event_times_that_do_not_fit_count_as_missing(spark):
    texts = ['{"ts_ms":9223372036854775807}', '{"ts_ms":-9223372036854775808,"timestamp_ms":5}']
    rows = normalize_events(good_events(parse_events(raw(spark, *texts))))
    found = [r[0] for r in rows.selectExpr("unix_millis(event_timestamp) - if(kafka_offset = 5, 0, 0)").collect()]
    broker = rows.selectExpr("unix_millis(kafka_received_at)").first()[0]
    assert sorted(found) == sorted([broker, 5])


TEXTS = st.recursive(
    st.sampled_from(['"a"', "1", "NaN", "'x'", "null", "tru", "1e400", "", "{}", "-"]),
    lambda inner: st.one_of(
        st.lists(st.tuples(st.sampled_from(['"service"', "'service'", '"ts_ms"', "service", '"status_code"']), inner), max_size=3)
        .map(lambda pairs: "{" + ",".join(f"{k}:{v}" for k, v in pairs) + "}"),
        st.lists(inner, max_size=2).map(lambda items: "[" + ",".join(items) + "]"),
    ),
    max_leaves=4,
)


@settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(TEXTS, st.sampled_from(["", " x", "}", ","])).map("".join), min_size=40, max_size=60))
def test_verdict_does_not_depend_on_the_fields_parsed(spark, texts):
    rows = raw(spark, *texts)
    kept = [
        sorted(r[0] for r in good_events(parse_events(rows, fields=f)).select("raw_json").collect())
        for f in (None, ["status_code"], ["ts_ms", "service"])
    ]
    assert kept[0] == kept[1] == kept[2]


@pytest.mark.parametrize("fields", [None, ["service"], ()], ids=["all", "one", "none"])
def test_a_computed_text_is_built_and_parsed_once(spark, fields):
    made = "CAST(to_json(named_struct('service', concat('s', id))) AS BINARY)"
    rows = spark.range(9).selectExpr("CAST(CAST(id AS STRING) AS BINARY) AS key", f"{made} AS value", "'t' AS topic", "0 AS partition", "id AS offset", "current_timestamp() AS timestamp")
    good, bad = split_events(parse_events(rows, fields=fields))
    columns = ["service"] if fields else None if fields is None else ["topic"]
    for frame in (normalize_events(good, columns=columns or EVENT_LOG_COLUMNS), bad.select("raw_json", "error_type")):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert (plan.count("parseJson("), plan.count("concat(s, "), plan.count("from_json")) == (1, 1, 0), plan
    assert (good.count(), bad.count()) == (9, 0)


def test_whole_numbers_and_text_are_read_as_they_are_written(spark):
    texts = ['{"status_code":"200"}', '{"status_code":200.5}', '{"status_code":true}', '{"status_code":2e2}', '{"status_code":3000000000}', '{"user_id":3000000000}', '{"user_id":99999999999999999999}']
    rows = normalize_events(good_events(parse_events(raw(spark, *texts)))).select("status_code", "user_id").collect()
    assert [(r.status_code, r.user_id) for r in rows] == [(0, None)] * 5 + [(0, 3_000_000_000), (0, None)]
    (row,) = normalized(spark, '{"order_id":12,"reason_code":true,"payment_id":{"a":[1,null]},"path":null}')
    assert (row.order_id, row.reason_code, row.payment_id, row.path) == ("12", "true", '{"a":[1,null]}', "")


# --- dead letters -----------------------------------------------------------------------------
def test_envelope_ids(spark):
    def ids(**broker):
        _, bad = split_events(parse_events(raw(spark, "garbage", **broker)))
        return quarantine.envelope_bad_rows(bad).first()

    assert ids().event_id == "logs.auth-1-5"
    hashed = ids(offset=None)
    assert len(hashed.event_id) == 64 and hashed.source_offset is None
    _, empty = split_events(parse_events(raw(spark, None, topic=None)))
    assert quarantine.envelope_bad_rows(empty).first().event_id == "unknown"


def test_dead_letter_loop_and_fallbacks(spark):
    rows = quarantine.parse_dlq(
        raw(
            spark,
            '{"error_type":"X","source_topic":"t","source_partition":3,"source_offset":9,'
            '"source_key":"s","created_ms":1704110400500,"raw_json":"r","service":"auth"}',
            "{}",
            "nonsense",
            None,
            topic="logs.dlq",
        )
    )
    full, bare, odd = sorted(rows.collect(), key=lambda r: (r.error_type, len(r.raw_json)))
    assert (odd.raw_json, odd.error_type, odd.source_topic) == ("nonsense", "unknown", "logs.dlq")
    assert (full.source_topic, full.source_partition, full.source_offset) == ("t", 3, 9)
    assert full.event_timestamp == datetime(2024, 1, 1, 12, 0, 0, 500000)
    assert (bare.source_topic, bare.source_partition, bare.source_offset) == ("logs.dlq", 1, 5)
    assert (bare.source_key, bare.error_type, bare.error_message) == ("k", "unknown", "")
    assert bare.raw_json == "{}" and bare.event_timestamp is None


def test_failed_batch_envelope_takes_any_schema(spark):
    batch = spark.createDataFrame([(1, "x")], "n INT, `odd name` STRING")
    row = quarantine.envelope_failed_batch(batch, "it's broken").first()
    assert row.error_message == "it's broken" and row.error_type == "sink_write_failed"
    assert (row.service, row.event_id, row.source_offset) == (None, None, None)
    assert row.raw_json == '{"n":1,"odd name":"x"}' and row.created_ms > 1_700_000_000_000


def test_failed_publish_is_keyed_by_request(spark):
    failed = spark.createDataFrame(
        [
            ("auth", '{"event_id":"e","request_id":"r"}'),
            ("auth", '{"event_id":"e"}'),
            ("auth", "not json"),
        ],
        "service STRING, raw_json STRING",
    ).selectExpr("*", "'E' error_type", "'m' error_message", "'t' topic", "now() failed_at")
    keys = [r.source_key for r in quarantine.envelope_failed_publish(failed).collect()]
    assert keys == ["r", "e", None]


# --- routing and ids --------------------------------------------------------------------------
def test_routing(spark):
    df = spark.createDataFrame([("auth",), ("new",), ("",), (None,), ("dlq",)], "service STRING")
    got = [r[0] for r in df.select(routing.topic_of("service")).collect()]
    assert got == ["logs.auth", "logs.new", "logs.unknown", "logs.unknown", "logs.dlq"]


@pytest.mark.parametrize(
    "result, status, topics",
    [
        ("fail", 200, 2), ("success", 500, 1), (None, 500, 2), (None, 499, 1), (None, None, 1),
    ],
)
def test_error_fan_out(spark, result, status, topics):
    df = spark.createDataFrame(
        [("auth", result, status)], "service STRING, result STRING, status_code INT"
    )
    assert routing.fan_out_errors(df).count() == topics
    on_error_topic = df.withColumn("service", F.lit("error"))
    assert [r.topic for r in routing.fan_out_errors(on_error_topic).collect()] == ["logs.error"]


def test_stable_ids(spark):
    def of(**fields):
        df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in fields.items()])
        return df.select(stable_event_id(df.schema)).first()[0]

    base = of(service="a", amount=12)
    assert base.startswith("evt_v1_") and len(base) == 39
    assert of(amount=12, service="a") == base  # order of columns does not matter
    assert of(service="a", amount=12.0) == base  # 12.0 is 12
    assert of(service="a", amount=12, other="x") == base  # not an identity field
    assert of(service="a", amount=13) != base
    # Lengths keep values from running into each other.
    assert of(service="a|event_name:1:b") != of(service="a", event_name="b")


# --- time -------------------------------------------------------------------------------------
def test_lag_counts_boundaries_not_elapsed_time(spark):
    df = spark.sql(
        "SELECT TIMESTAMP'2024-01-01 00:00:00.9' a, TIMESTAMP'2024-01-01 00:00:01.1' b"
    )
    assert df.selectExpr(lag_seconds("a", "b")).first()[0] == 1


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.datetimes(datetime(1960, 1, 1), datetime(2100, 1, 1)), min_size=1, max_size=20))
def test_buckets_match_window_and_date_trunc(spark, stamps):
    df = spark.createDataFrame([(s,) for s in stamps], "ts TIMESTAMP")
    ten = df.select("ts", F.window("ts", "10 seconds").start.alias("w"))
    assert ten.where(F.col("w") != bucket_of("ts", 10)).count() == 0
    assert df.where(F.date_trunc("minute", "ts") != bucket_of("ts", 60)).count() == 0


def test_millis(spark):
    at = spark.sql("SELECT TIMESTAMP'2024-01-01 00:00:00.123987' t").select(to_millis(F.col("t")))
    assert at.first()[0] == datetime(2024, 1, 1, 0, 0, 0, 123000)


# --- deduplication ----------------------------------------------------------------------------
VERSIONS = (
    "service STRING, event_id STRING, kafka_received_at TIMESTAMP, spark_processed_at TIMESTAMP, "
    "topic STRING, kafka_partition INT, kafka_offset BIGINT"
)


def test_keep_latest_scopes_and_ties(spark):
    late = datetime(2024, 1, 1, 23, 59, 59)
    rows = [
        ("a", "1", late, T0, "t", 0, 1),
        ("a", "1", late + timedelta(seconds=2), T0 + timedelta(seconds=1), "t", 0, 2),
        ("a", "2", late, T0, "t", 0, 3),
        ("a", "2", late, T0, "t", 0, 4),  # same version: the later offset wins
        ("b", "1", late, T0, "t", 0, 5),
    ]
    df = spark.createDataFrame(rows, VERSIONS)
    table = {(r.service, r.event_id): r.kafka_offset for r in dedup.keep_latest(df).collect()}
    assert table == {("a", "1"): 2, ("a", "2"): 4, ("b", "1"): 5}
    per_day = dedup.keep_latest(df, scope="partition")
    assert sorted(r.kafka_offset for r in per_day.collect()) == [1, 2, 4, 5]
    with pytest.raises(ValueError, match="scope"):
        dedup.keep_latest(df, scope="day")


def test_hot_key_is_cut_before_the_shuffle(spark):
    hot = spark.range(0, 50_000, numPartitions=8).selectExpr(
        "'a' service", "if(id % 3 = 0, 'hot', cast(id as string)) event_id",
        "timestamp_seconds(id) kafka_received_at", "timestamp_seconds(id) spark_processed_at",
        "'t' topic", "0 kafka_partition", "id kafka_offset",
    )
    latest = dedup.keep_latest(hot)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert latest.where("event_id = 'hot'").first().kafka_offset == 49_998
    assert latest.count() == 50_000 - 16_667 + 1


def test_drop_repeats(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k INT, v STRING")
    assert dedup.drop_repeats(df, None) is df
    assert dedup.drop_repeats(df, ["k"]).count() == 2
    sent = df.withColumns({"kafka_offset": F.when(F.col("v") == "a", 9).otherwise(3)})
    kept = {r.k: r.v for r in dedup.drop_repeats(sent, ["k"]).collect()}
    assert kept == {1: "b", 2: "c"}  # the earlier delivery
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="kafka_received_at"):
        dedup.drop_repeats(stream, ["value"], watermark="1 minute")
    with pytest.raises(ValueError, match="nope"):
        dedup.drop_repeats(stream, ["nope"], watermark="1 minute", event_time="timestamp")
    with pytest.raises(ValueError, match="per micro-batch"):
        dedup.drop_repeats(stream, ["value"])


# --- rollups ----------------------------------------------------------------------------------
TIMES = (
    "event_timestamp TIMESTAMP, kafka_received_at TIMESTAMP, spark_received_at TIMESTAMP, "
    "spark_processed_at TIMESTAMP, stored_at TIMESTAMP, service STRING, event_id STRING, "
    "status_code INT"
)


def timeline(spark, *rows):
    """Rows of (event, kafka, received, processed, stored) offsets in ms, service, status."""

    def at(ms):
        return None if ms is None else T0 + timedelta(milliseconds=ms)

    return spark.createDataFrame(
        [(*map(at, r[:5]), r[5], str(i), r[6]) for i, r in enumerate(rows)], TIMES
    )


def test_lag_clamps_and_counts_skew(spark):
    df = timeline(
        spark,
        (900, 1100, 1, 1, 1, "a", 200),  # one boundary
        (5000, 3000, 1, 1, 1, "a", 200),  # broker before event: skew
        (None, 3000, 1, 1, 1, "a", 200),  # no event time: not counted
    )
    row = catalog.LAG_1M.states(df).first()
    assert (row.sum_lag, row.cnt, row.skew_cnt) == (1, 2, 1)


def test_latency_needs_the_whole_timeline_and_is_never_negative(spark):
    df = timeline(
        spark,
        (0, 100, 200, 300, 400, "a", 200),
        (500, 100, 200, 300, 400, "a", 200),  # skewed producer
        (0, 100, None, 300, 400, "a", 200),
    )
    r = catalog.LATENCY_1M
    row = r.answers(r.states(df), q=0.0).first()
    assert row.producer_to_kafka_ms == 0 and row.e2e_ms == 300
    assert r.answers(r.states(df), q=1.0).first().producer_to_kafka_ms == 100
    assert row.max_ingest == T0 + timedelta(milliseconds=100)


def test_created_stored(spark):
    df = timeline(
        spark,
        (0, 1, 1, 1, 59_000, "a", 200),
        (0, 1, 1, 1, 61_000, "a", 200),
        (None, 1, 1, 1, 1, "a", 200),
    )
    assert [(r.created, r.stored) for r in catalog.CREATED_STORED_1M.states(df).collect()] == [(2, 1)]
    backfill = {r.bucket: (r.created, r.stored) for r in catalog.created_stored_backfill(df).collect()}
    assert backfill == {T0: (2, 2), T0 + timedelta(minutes=1): (0, 1)}
    assert sorted(catalog.created_stored_by_union(df).collect()) == sorted(
        catalog.created_stored_backfill(df).collect()
    )


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(split=st.integers(1, 1000), parts=st.integers(2, 4))
def test_merge_law(spark, sample_log, split, parts):
    """Merged states of any split equal the states of the whole."""
    piece = F.abs(F.hash("event_id", F.lit(split))) % parts
    for r in catalog.EVENT_ROLLUPS:
        exact = [m.name for m in r.measures if m.kind != "quantile"]
        merged = r.merge(
            r.states(sample_log.where(piece == 0)).unionByName(r.states(sample_log.where(piece > 0)))
        )
        columns = [*r.keys, *exact]
        assert sorted(map(str, merged.select(columns).collect())) == sorted(
            map(str, r.states(sample_log).select(columns).collect())
        ), r.name


@pytest.fixture(scope="module")
def sample_log(spark):
    return tb.event_log(tb.broker_rows(tb.events(spark, SF_DIR))).cache()


def test_shared_states_agree_with_each_rollup(spark, sample_log):
    shared = SharedStates(catalog.EVENT_ROLLUPS)
    states = shared.states(sample_log).cache()
    for r in catalog.EVENT_ROLLUPS:
        columns = [*r.keys, *[m.name for m in r.measures if m.kind != "quantile"]]
        assert sorted(map(str, shared.rollup(states, r.name).select(columns).collect())) == sorted(
            map(str, r.states(sample_log).select(columns).collect())
        ), r.name
    # Equal measures are kept once: five sketches, not ten.
    assert sum(c.startswith("quantile_") for c in states.columns) == len(STAGES)


def test_sketches_are_within_their_rank_error(spark, sample_log):
    r = catalog.LATENCY_10S
    merged = r.merge(r.states(sample_log), by=[])
    for stage in STAGES:
        value = merged.select(sketch_quantile(f"{stage}_ms", 0.95)).first()[0]
        ms = F.expr(f"greatest({catalog.stage_ms(stage)}, 0)")
        below, upto, n = sample_log.agg(
            F.count_if(ms < value), F.count_if(ms <= value), F.count("*")
        ).first()
        assert below / n - 0.02 <= 0.95 <= upto / n + 0.02, stage


def test_exact_quantiles_with_a_hot_group(spark):
    df = spark.range(0, 30_000).selectExpr(
        "if(id < 10000, 'hot', cast(id % 50 as string)) g", "id % 997 v", "cast(null as bigint) w"
    )
    got = {r.g: (r.v, r.w) for r in exact_quantiles(df, ["g"], {"v": "v", "w": "w"}).collect()}
    disc = df.groupBy("g").agg(F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY v)").alias("v"))
    assert got == {r.g: (int(r.v), None) for r in disc.collect()}


# --- serving ----------------------------------------------------------------------------------
def test_nothing_recent_reads_as_zero_and_epoch(spark, sample_log):
    """A silent pipeline is a finding, not a NULL."""
    now = F.lit("2030-01-01 00:00:00").cast("timestamp")

    def recent(df, at="bucket"):
        return serve.last_minutes(df, now, 5, at=at)

    traffic = recent(catalog.TRAFFIC_1M.states(sample_log))
    latency = serve.latest_bucket(
        serve.stage_p95(recent(catalog.LATENCY_1M.states(sample_log)), catalog.LATENCY_1M)
    )
    dlq = recent(catalog.DLQ_1M.states(tb.dead_letters(tb.broker_rows(tb.events(spark, SF_DIR)))))
    health = serve.health(
        serve.latest_traffic(traffic),
        latency,
        serve.freshness(recent(sample_log, "kafka_received_at"), now),
        serve.dlq_rate(dlq, traffic),
    )
    (row,) = health.collect()
    assert (row.eps, row.error_rate_pct, row.dlq_rate_pct, row.e2e_p95_ms) == (0, 0, 0, 0)
    assert row.eps_bucket == datetime(1970, 1, 1) == row.latency_bucket
    assert row.freshness_ms == 1_893_456_000_000
    breached = {r.metric for r in thresholds.check(health).where("breached").collect()}
    assert breached == {"eps_low", "freshness"}
    assert serve.mean_lag_ms(recent(catalog.LAG_1M.states(sample_log))).first()[0] == 0


def test_top_services_breaks_ties_by_name(spark):
    p95 = spark.createDataFrame(
        [(s, 10) for s in "gfedcba"], "service STRING, producer_to_kafka_p95_ms BIGINT"
    )
    assert [r.service for r in serve.top_services(p95).collect()] == list("abcde")


# --- observability ----------------------------------------------------------------------------
def test_offsets(spark):
    latest = telemetry.latest_offsets(
        spark.createDataFrame([("a:0:10",), (" a:1:4 ",), ("b:0:7",), ("noise",)], "value STRING")
    )
    committed = telemetry.committed_offsets(
        spark.createDataFrame(
            [("v1",), ('{"batchWatermarkMs":0,"conf":{"x":"y"}}',), ('{"a":{"0":3,"1":9}}',)],
            "value STRING",
        )
    )
    lag = {(r.topic, r.partition): r.lag for r in observe.offset_lag(latest, committed).collect()}
    assert lag == {("a", 0): 7, ("a", 1): 0, ("b", 0): None}
    zero = observe.offset_lag(latest, committed, absent="zero")
    assert zero.where("topic = 'b'").first().lag == 7
    totals = {
        r.topic: (r.lag_sum, r.lag_max, r.missing_partitions)
        for r in observe.lag_totals(observe.offset_lag(latest, committed)).collect()
    }
    assert totals == {"a": (7, 7, 0), "b": (0, 0, 1), None: (7, 7, 1)}


def test_checkpoint_offsets_of_the_newest_batch(spark, tmp_path):
    offsets = tmp_path / "offsets"
    offsets.mkdir()
    for batch, at in ((9, 5), (10, 8)):
        (offsets / str(batch)).write_text(f'v1\n{{"batchWatermarkMs":0}}\n{{"t":{{"0":{at}}}}}\n')
    rows = telemetry.checkpoint_offsets(spark, str(tmp_path)).collect()
    assert [(r.topic, r.partition, r.committed) for r in rows] == [("t", 0, 8)]


def test_offsets_from_progress_lines(spark):
    def line(batch, offset, query="q"):
        return (
            f'{{"queryName":"{query}","progress":{{"batchId":{batch},"sources":[{{"description":"d",'
            f'"endOffset":{{"t":{{"0":{offset},"1":7}}}}}},{{"endOffset":null}}]}}}}',
        )

    lines = spark.createDataFrame(
        [line(9, 5), line(10, 8), line(11, 99, "other"), ('{"event":"started"}',)], "value STRING"
    )
    rows = telemetry.progress_offsets(lines, "q").orderBy("partition").collect()
    assert [(r.topic, r.partition, r.committed) for r in rows] == [("t", 0, 8), ("t", 1, 7)]


def test_timing_summary(spark):
    lines = [
        "2024-01-01T00:00:00Z [spark batch] stream=s table=t query=q batch_id=0 stage=transform duration=1.000s",
        "2024-01-01T00:00:01Z [spark batch] stream=s table=t query=q batch_id=0 stage=write duration=4.000s",
        "2024-01-01T00:00:02Z [spark batch] stream=s table=t batch_id=1 stage=transform empty=true duration=0.500s",
        "2024-01-01T00:00:02Z [spark batch] stream=s table=t batch_id=1 stage=write empty=true duration=0.000s",
        "unrelated",
    ]
    parsed = telemetry.timing_lines(spark.createDataFrame([(x,) for x in lines], "value STRING"))
    assert parsed.count() == 4 and parsed.where("empty").count() == 2
    row = observe.timing_summary(parsed, 4.0).first()
    assert (row.batches, row.mean_transform, row.mean_write) == (2, 0.75, 2.0)
    assert (row.mean_total, row.max_total, row.over_trigger_pct) == (2.75, 5.0, 50.0)


def test_log_patterns(spark):
    lines = spark.createDataFrame(
        [
            ("kafka", "x outofmemoryERROR"), ("spark-driver", "outofmemoryerror"),
            ("spark-driver", "Code:\t241, MEMORY_LIMIT_EXCEEDED"), ("grafana", "LEVEL=ERROR"),
            ("clickhouse", "db::exception"), ("other", "panic:"),
        ],
        "component STRING, line STRING",
    )
    got = {(r.component, r.pattern) for r in observe.alerting_lines(lines).collect()}
    assert got == {
        ("kafka", "(?i)OutOfMemoryError"), ("spark-driver", r"Code:\s*241"),
        ("grafana", "(?i)level=error"),
    }


# --- alerts -----------------------------------------------------------------------------------
def walk(rule, readings):
    state, out = rule.start, []
    for at, *read in readings:
        state, row = rule.step(state, at, *read)
        out.append(row)
    return out


def test_grace_and_cooldown():
    rule = AlertRule(grace_seconds=10, cooldown_seconds=20)
    got = walk(rule, [(t, t not in (15,)) for t in range(0, 65, 5)])
    fired = [t for t, (_, f) in zip(range(0, 65, 5), got, strict=True) if f]
    # First breach at 0, ready at 10; recovery at 15; breach again at 20, ready at 30.
    assert fired == [10, 30, 50]
    assert [r for r, _ in got[:4]] == [False, False, True, False]


def test_level_hysteresis():
    rule = LevelRule()
    minute = 60
    lags = [3000, 3000, 3000, 1900, 1900, 1900, *[1900] * 8, 1000, 1000, 1000]
    got = walk(rule, [(i * minute, lag) for i, lag in enumerate(lags)])
    assert [a for *_, a in got[:3]] == ["pending", "switch", "keep"]
    # Asked down for three readings, but the last change is too recent.
    assert [a for *_, a in got[3:6]] == ["pending", "pending", "cooldown"]
    assert got[11] == ("mid", "mid", "switch")
    assert got[12][2] == "keep"
    # Exactly at a limit is not beyond it.
    assert walk(rule, [(0, 2500)] * 3)[-1][2] == "keep"


def test_in_order_streams_keys_of_any_length(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        readings = spark.range(0, 2000).selectExpr(
            "if(id % 3 = 0, 'hot', concat('k', id % 5)) key", "timestamp_seconds(id * 7) at",
            "pmod(hash(id), 4) > 0 breached",
        )
        rule = AlertRule(grace_seconds=20, cooldown_seconds=60)
        got = in_order(readings, rule).orderBy("key", "at").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 2000
    by_key = {}
    for r in readings.orderBy("key", "at").collect():
        by_key.setdefault(r.key, []).append((r.at.replace(tzinfo=UTC).timestamp(), r.breached))
    expected = [row for key in sorted(by_key) for row in walk(rule, by_key[key])]
    assert [(r.ready, r.fired) for r in got] == expected
    windows = sustained_breaches(readings, 20).orderBy("key", "at").collect()
    assert [r.ready for r in windows] == [ready for ready, _ in expected]


# --- retention --------------------------------------------------------------------------------
def test_retention_edges(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 23, 59),)], "kafka_received_at TIMESTAMP")

    def alive(table, at):
        return retention.live(df, table, F.lit(at).cast("timestamp")).count() == 1

    assert alive("event_log", "2024-01-03 23:59:59") and not alive("event_log", "2024-01-04 00:00:00")
    assert alive("event_log_dlq", "2024-01-08 23:58:59")
    assert not alive("event_log_dlq", "2024-01-08 23:59:00")


def test_expired_day_folders(spark, folder):
    days = ["ingest_date=2024-01-01", "ingest_date=2024-01-02", "_SUCCESS", "ingest_date=__HIVE__"]
    assert retention.expired_days(days, 3, date(2024, 1, 4)) == days[:1]
    assert retention.expired_days(days, 7, date(2024, 1, 8), whole_days=False) == []
    assert retention.expired_days(days, 7, date(2024, 1, 9), whole_days=False) == days[:1]
    df = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-05')) ingest_date, 1 n")
    df.write.partitionBy("ingest_date").parquet(folder)
    as_of = date(2024, 1, 6)
    listed = retention.drop_expired(spark, folder, retention.Keep("t", 3), as_of, dry_run=True)
    assert len(listed) == 3 and spark.read.parquet(folder).count() == 5
    retention.drop_expired(spark, folder, retention.Keep("t", 3), as_of)
    assert spark.read.parquet(folder).count() == 2


def test_messages_about_the_same_row_are_settled_by_where_it_came_from(spark):
    told = '{"error_type":"%s","source_topic":"t","source_partition":0,"source_offset":%d,"raw_json":"x"}'
    values = [told % ("a", 1), told % ("a", 1), told % ("b", 1), told % ("a", 2), "no envelope", "no envelope", '{"error_type":"a"}', '{"error_type":"a"}', None]
    messages = raw(spark, *values, topic="logs.dlq").withColumn("offset", F.monotonically_increasing_id())
    once = quarantine.parse_dlq(messages, once_within="1 hour")
    assert once.columns == quarantine.parse_dlq(messages).columns
    assert quarantine.parse_dlq(messages).count() == 8
    found = [(r.error_type, r.source_offset if r.source_topic == "t" else None) for r in once.collect()]
    assert sorted(found, key=str) == sorted([("a", 1), ("b", 1), ("a", 2), ("unknown", None), ("unknown", None), ("a", None), ("a", None)], key=str)


def test_a_filter_on_dead_letters_is_not_run_over_all_rows(spark):
    bad = tb.dead_letters(tb.broker_rows(tb.events(spark, SF_DIR)))
    plan = bad._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("StructsToJson" in f or "sha2" in f for f in filters)


def test_texts_of_one_row_group_are_made_by_many_tasks(spark):
    raw = tb.broker_rows(tb.events(spark, SF_DIR))
    assert raw.select(F.spark_partition_id()).distinct().count() > 4
    assert raw.groupBy("topic", "partition", "offset").count().count() == 1000
