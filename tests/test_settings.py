"""Settings: keys, watermarks, intervals, rates, connection options."""

from __future__ import annotations

import pytest

from logpulse import schema
from logpulse.config import (
    FactSettings,
    SessionSettings,
    SinkSettings,
    StreamSettings,
    interval_seconds,
)
from logpulse.plans.thresholds import load_limits
from logpulse.sources.broker import kafka_options
from logpulse.streaming.alerts import AlertRule, LevelRule


@pytest.mark.parametrize(
    "text, keys",
    [
        (None, None),
        ("", None),
        (",", None),
        ("event_id", ("event_id",)),
        ("event_id,user_id", ("event_id", "user_id")),
        ("event_id, user_id", ("event_id", "user_id")),
    ],
)
def test_dedup_keys(text, keys):
    env = {} if text is None else {"SPARK_FACT_DEDUP_KEYS": text}
    assert FactSettings.load(env).dedup_keys == keys


@pytest.mark.parametrize(
    "text, watermark",
    [("10 minutes", "10 minutes"), ("1 hour", "1 hour"), (None, None), ("", None), ("  ", None)],
)
def test_dedup_watermark(text, watermark):
    env = {} if text is None else {"SPARK_FACT_DEDUP_WATERMARK": text}
    assert FactSettings.load(env).dedup_watermark == watermark


def test_keys_and_watermark_together():
    both = FactSettings.load(
        {"SPARK_FACT_DEDUP_KEYS": "event_id", "SPARK_FACT_DEDUP_WATERMARK": "10 minutes"}
    )
    assert (both.dedup_keys, both.dedup_watermark) == (("event_id",), "10 minutes")
    keys_only = FactSettings.load({"SPARK_FACT_DEDUP_KEYS": "event_id"})
    assert (keys_only.dedup_keys, keys_only.dedup_watermark) == (("event_id",), None)


def test_defaults():
    stream = StreamSettings.load({})
    assert stream.enable_dlq and not stream.reset_checkpoint
    assert not FactSettings.load({}).skip_empty
    sink = SinkSettings.load({})
    assert sink.retry_max == 0 and sink.bypass_to_dlq and not sink.guard


def test_errors_name_the_key():
    with pytest.raises(ValueError, match="SPARK_TARGET_EPS: expected an integer, got 'many'"):
        StreamSettings.load({"SPARK_TARGET_EPS": "many"})
    with pytest.raises(ValueError, match="SPARK_MAX_OFFSETS_SAFETY: expected a number"):
        StreamSettings.load({"SPARK_MAX_OFFSETS_SAFETY": "x"})


@pytest.mark.parametrize("text", ["1", "true", "YES", "y"])
def test_flags(text):
    assert FactSettings.load({"SPARK_SKIP_EMPTY_BATCH": text}).skip_empty
    assert not FactSettings.load({"SPARK_SKIP_EMPTY_BATCH": "no"}).skip_empty


@pytest.mark.parametrize(
    "text, seconds",
    [
        ("3 seconds", 3), ("5s", 5), ("1500ms", 1.5), ("2 minutes", 120), ("1.5 hours", 5400),
        ("7", 7), (None, None), ("", None), ("soon", None), ("3 weeks", None),
    ],
)
def test_intervals(text, seconds):
    assert interval_seconds(text) == (None if seconds is None else pytest.approx(seconds))


@pytest.mark.parametrize(
    "given, trigger, rows",
    [
        ({"max_per_trigger": 700}, "4 seconds", 700),
        ({"target_eps": 5000}, "4 seconds", 20000),
        ({"target_eps": 5000, "rate_safety": 1.1}, "4 seconds", 22000),
        ({"target_eps": 5000, "max_per_trigger_cap": 9000}, "4 seconds", 9000),
        ({"max_per_trigger": 700, "max_per_trigger_cap": 0}, None, 700),
        ({"max_per_trigger_cap": 5}, "4 seconds", None),
        ({"target_eps": 1}, "100ms", 1),
        ({"target_eps": 5000}, None, None),
        ({}, "4 seconds", None),
    ],
)
def test_rows_per_trigger(given, trigger, rows):
    assert StreamSettings(**given).rows_per_trigger(trigger) == rows


def test_rate_from_profile(tmp_path):
    profile = tmp_path / "profile.yml"
    profile.write_text("name: x\neps: 250.0\n")
    settings = StreamSettings(target_eps_profile=str(profile))
    assert settings.rows_per_trigger("2 seconds") == 500
    assert StreamSettings(target_eps_profile="/nowhere").eps() is None


def test_read_partitions():
    assert StreamSettings(min_partitions=9).read_partitions(7) == 9
    assert StreamSettings(min_partitions_multiplier=1.5).read_partitions(7) == 10
    assert StreamSettings(min_partitions_multiplier=1.5).read_partitions(None) is None
    assert StreamSettings().read_partitions(7) is None
    given = {"SPARK_KAFKA_TOPIC_PARTITIONS": "6", "SPARK_KAFKA_MIN_PARTITIONS_MULTIPLIER": "2"}
    settings = StreamSettings.load({**given, "KAFKA_BOOTSTRAP": "b:1"})
    assert kafka_options(settings, "t")["minPartitions"] == "12"


def test_kafka_options():
    settings = StreamSettings(
        bootstrap="b:9092", starting_offsets="latest", target_eps=100, min_partitions=4
    )
    assert kafka_options(settings, " a, b ,", trigger="5s") == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "a,b",
        "failOnDataLoss": "true",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "500",
        "minPartitions": "4",
    }
    with pytest.raises(ValueError, match="no topics"):
        kafka_options(settings, " ")
    with pytest.raises(ValueError, match="no broker"):
        kafka_options(StreamSettings(), "a")


def test_jdbc_options():
    sink = SinkSettings.load(
        {
            "SPARK_SINK_JDBC_URL": "jdbc:x://h/db",
            "SPARK_SINK_JDBC_USER": "u",
            "SPARK_SINK_JDBC_BATCHSIZE": "10000",
        }
    )
    assert sink.jdbc_options("t") == {
        "url": "jdbc:x://h/db", "user": "u", "dbtable": "t", "isolationLevel": "NONE",
        "batchsize": "10000",
    }
    assert sink.jdbc_options() == {"url": "jdbc:x://h/db", "user": "u"}
    with pytest.raises(ValueError, match="SPARK_SINK_JDBC_URL"):
        SinkSettings().jdbc_options("t")


def test_session_shuffle_partitions_only_with_dedup():
    conf = SessionSettings.load(
        {"SPARK_STREAM_SHUFFLE_PARTITIONS": "6", "SPARK_STREAM_EXECUTOR_MEMORY": "1g"}
    ).spark_conf()
    assert conf == {"spark.executor.memory": "1g"}
    conf = SessionSettings.load(
        {"SPARK_STREAM_SHUFFLE_PARTITIONS": "6", "SPARK_FACT_DEDUP_KEYS": "event_id"}
    ).spark_conf()
    assert conf["spark.sql.shuffle.partitions"] == "6"


# --- column contracts -------------------------------------------------------------------------
LINEAGE = {"event_timestamp", "kafka_received_at", "spark_received_at", "spark_processed_at"}
RETIRED = {
    "event_ts", "kafka_ingest_ts", "kafka_ts", "spark_ts", "processed_ts", "stored_ts",
    "producer_ts", "created_ts",
}


def test_timestamp_columns():
    assert LINEAGE <= set(schema.EVENT_LOG_COLUMNS)
    assert {"kafka_received_at", "spark_processed_at", "event_timestamp"} <= set(
        schema.EVENT_LOG_DLQ_COLUMNS
    )
    for columns in (schema.EVENT_LOG_COLUMNS, schema.EVENT_LOG_DLQ_COLUMNS):
        assert not RETIRED & set(columns)
    assert len(schema.EVENT_LOG_COLUMNS) == 26 and len(schema.EVENT_LOG_DLQ_COLUMNS) == 13
    assert len(schema.EVENT_FIELDS) == 20


def test_limits_and_rules_from_settings():
    limits = load_limits({"EPS_MIN": "5", "P95_E2E_MS_MAX": "1000", "DLQ_RATE_PCT_MAX": ""})
    assert limits["eps_low"].limit == 5 and limits["eps_low"].below
    assert limits["e2e_p95"].limit == 1000 and limits["dlq_rate"].limit == 1
    assert AlertRule.load({"ALERT_COOLDOWN_SEC": "60"}) == AlertRule(cooldown_seconds=60)
    rule = LevelRule.load({"SCALE_UP_STREAK": "4"})
    assert (rule.up_streak, rule.down_streak, rule.mid_to_high) == (4, 3, 2500)
