"""Settings: frozen dataclasses read from a plain mapping (``os.environ`` by default).

Each field names its key and kind, so reading, defaulting and error reporting are shared.
"""

from __future__ import annotations

import math
import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any, Self

import pandas as pd


def _flag(text: str) -> bool:
    # Texts that mean yes.
    return text.lower() in {"1", "true", "yes", "y"}


def _keys(text: str) -> tuple[str, ...] | None:
    return tuple(k for k in (part.strip() for part in text.split(",")) if k) or None


_KINDS: dict[str, tuple[Any, str]] = {
    "text": (str, "text"),
    "int": (int, "an integer"),
    "float": (float, "a number"),
    "flag": (_flag, "a flag"),
    "keys": (_keys, "a comma-separated list"),
}


def option(key: str, kind: str = "text", default: Any = None) -> Any:
    return field(default=default, metadata={"key": key, "kind": kind})


class Settings:
    """Mixin giving a dataclass of ``option`` fields a ``load`` constructor."""

    @classmethod
    def load(cls, env: Mapping[str, str] | None = None) -> Self:
        env = os.environ if env is None else env
        found = {}
        for f in fields(cls):  # type: ignore[arg-type]
            text = (env.get(f.metadata["key"]) or "").strip()
            if not text:
                continue
            parse, wanted = _KINDS[f.metadata["kind"]]
            try:
                found[f.name] = parse(text)
            except ValueError as exc:
                raise ValueError(f"{f.metadata['key']}: expected {wanted}, got {text!r}") from exc
        return cls(**found)


def interval_seconds(text: str | None) -> float | None:
    """Length of an interval such as ``"3 seconds"`` or ``"1500ms"``; ``None`` if it is none.

    A bare number is seconds.
    """
    text = (text or "").strip()
    try:
        found = pd.Timedelta(f"{text} s" if text.isdigit() else text)
    except ValueError:
        return None
    return None if found is pd.NaT or found < pd.Timedelta(0) else found.total_seconds()


@dataclass(frozen=True)
class StreamSettings(Settings):
    """Where events come from and how fast they are taken."""

    bootstrap: str = option("KAFKA_BOOTSTRAP", default="")
    fact_topics: str = option("SPARK_FACT_TOPICS", default="")
    dlq_topic: str | None = option("SPARK_DLQ_TOPIC")
    starting_offsets: str | None = option("SPARK_STARTING_OFFSETS")
    max_per_trigger: int | None = option("SPARK_MAX_OFFSETS_PER_TRIGGER", "int")
    max_per_trigger_cap: int | None = option("SPARK_MAX_OFFSETS_CAP", "int")
    target_eps: int | None = option("SPARK_TARGET_EPS", "int")
    target_eps_profile: str | None = option("SPARK_TARGET_EPS_PROFILE_PATH")
    rate_safety: float | None = option("SPARK_MAX_OFFSETS_SAFETY", "float")
    # Offsets that the broker has dropped before they were read stop the query.
    fail_on_data_loss: bool = option("SPARK_KAFKA_FAIL_ON_DATA_LOSS", "flag", True)
    min_partitions: int | None = option("SPARK_KAFKA_MIN_PARTITIONS", "int")
    # Partitions of the topics read, for the multiplier.
    topic_partitions: int | None = option("SPARK_KAFKA_TOPIC_PARTITIONS", "int")
    min_partitions_multiplier: float | None = option(
        "SPARK_KAFKA_MIN_PARTITIONS_MULTIPLIER", "float"
    )
    enable_dlq: bool = option("SPARK_ENABLE_DLQ_STREAM", "flag", True)
    reset_checkpoint: bool = option("SPARK_RESET_CHECKPOINT_ON_START", "flag", False)
    # Stand-in source: a folder of Parquet files in broker-row layout, one folder per topic.
    files_root: str | None = option("SPARK_SOURCE_FILES_ROOT")

    def eps(self) -> int | None:
        if self.target_eps:
            return self.target_eps
        if not self.target_eps_profile:
            return None
        try:
            with open(self.target_eps_profile, encoding="utf-8") as handle:
                found = re.search(r"^eps:\s*([0-9.]+)", handle.read(), re.MULTILINE)
            return int(float(found.group(1))) if found else None
        except (FileNotFoundError, ValueError):
            return None

    def rows_per_trigger(self, trigger: str | None) -> int | None:
        """The least of the limits on a trigger's rows that are set; ``None`` without a rate.

        The given number stands before the one computed from rate and trigger length.
        """
        rate, length = self.eps() or 0, interval_seconds(trigger) or 0
        computed = math.floor(rate * length * (self.rate_safety or 1.0))
        wanted = self.max_per_trigger or (max(1, computed) if rate and length else None)
        limits = [n for n in (wanted, self.max_per_trigger_cap) if n and n > 0]
        return min(limits) if wanted else None

    def read_partitions(self, topic_partitions: int | None = None) -> int | None:
        """Partitions to read with: as given, else in proportion to those the topics have."""
        known = topic_partitions or self.topic_partitions
        share = (self.min_partitions_multiplier or 0) * (known or 0)
        return self.min_partitions or (max(1, math.floor(share)) if share else None)


@dataclass(frozen=True)
class FactSettings(Settings):
    """Event table stream."""

    trigger: str | None = option("SPARK_FACT_TRIGGER_INTERVAL")
    store_raw_json: bool = option("SPARK_STORE_RAW_JSON", "flag", False)
    pre_coalesce: int | None = option("SPARK_FACT_PRE_COALESCE_PARTITIONS", "int")
    skip_empty: bool = option("SPARK_SKIP_EMPTY_BATCH", "flag", False)
    dedup_keys: tuple[str, ...] | None = option("SPARK_FACT_DEDUP_KEYS", "keys")
    dedup_watermark: str | None = option("SPARK_FACT_DEDUP_WATERMARK")
    parse_mode: str = option("SPARK_PARSE_MODE", default="strict")


@dataclass(frozen=True)
class DlqSettings(Settings):
    """Dead-letter streams: producer (bad rows to topic) and consumer (topic to table)."""

    table_trigger: str | None = option("SPARK_DLQ_TRIGGER_INTERVAL")
    topic_trigger: str | None = option("SPARK_DLQ_KAFKA_TRIGGER_INTERVAL")
    log_empty: bool = option("SPARK_DLQ_KAFKA_LOG_EMPTY", "flag", False)
    # Messages about the same failed row within this time are stored once.
    once_within: str | None = option("SPARK_DLQ_DEDUP_WATERMARK")


@dataclass(frozen=True)
class SinkSettings(Settings):
    """Delivery of micro-batches to tables."""

    root: str | None = option("SPARK_SINK_ROOT")
    url: str = option("SPARK_SINK_JDBC_URL", default="")
    driver: str | None = option("SPARK_SINK_JDBC_DRIVER")
    user: str | None = option("SPARK_SINK_JDBC_USER")
    password: str | None = option("SPARK_SINK_JDBC_PASSWORD")
    batchsize: int | None = option("SPARK_SINK_JDBC_BATCHSIZE", "int")
    fetchsize: int | None = option("SPARK_SINK_JDBC_FETCHSIZE", "int")
    write_partitions: int | None = option("SPARK_SINK_WRITE_PARTITIONS", "int")
    allow_repartition: bool = option("SPARK_SINK_ALLOW_REPARTITION", "flag", False)
    retry_max: int = option("SPARK_SINK_RETRY_MAX", "int", 0)
    fail_on_error: bool = option("SPARK_SINK_FAIL_ON_ERROR", "flag", True)
    bypass_to_dlq: bool = option("SPARK_SINK_DLQ_ON_FINAL_FAILURE", "flag", True)
    guard: bool = option("SPARK_SINK_BATCH_GUARD_ENABLED", "flag", False)
    guard_table: str | None = option("SPARK_SINK_BATCH_GUARD_TABLE")
    # Database batches go through a staging table and one transaction.
    staged: bool = option("SPARK_SINK_JDBC_STAGED", "flag", False)

    def jdbc_options(self, table: str | None = None) -> dict[str, str]:
        """Connection options; with ``table`` also the options of a write to it."""
        if not self.url:
            raise ValueError("SPARK_SINK_JDBC_URL is required")
        found = {
            "url": self.url,
            "driver": self.driver,
            "user": self.user,
            "password": self.password,
            "fetchsize": self.fetchsize,
        }
        if table is not None:
            # No transaction per partition: replays are handled by the batch guard.
            found |= {"dbtable": table, "isolationLevel": "NONE", "batchsize": self.batchsize}
        return {key: str(value) for key, value in found.items() if value not in (None, "")}


@dataclass(frozen=True)
class TelemetrySettings(Settings):
    progress_log: str | None = option("SPARK_PROGRESS_LOG_PATH")
    timing_log: str | None = option("SPARK_BATCH_TIMING_LOG_PATH")
    # Table of batch vital signs, on shared storage.
    vitals_table: str | None = option("SPARK_BATCH_VITALS_PATH")


@dataclass(frozen=True)
class SessionSettings(Settings):
    app_name: str = option("SPARK_APP_NAME", default="logpulse")
    master: str | None = option("SPARK_MASTER_URL")
    driver_memory: str | None = option("SPARK_STREAM_DRIVER_MEMORY")
    driver_memory_overhead: str | None = option("SPARK_STREAM_DRIVER_MEMORY_OVERHEAD")
    executor_memory: str | None = option("SPARK_STREAM_EXECUTOR_MEMORY")
    executor_memory_overhead: str | None = option("SPARK_STREAM_EXECUTOR_MEMORY_OVERHEAD")
    shuffle_partitions: int | None = option("SPARK_STREAM_SHUFFLE_PARTITIONS", "int")
    # Size of a task's share of a file scan: the read parallelism of batches.
    max_partition_bytes: str | None = option("SPARK_MAX_PARTITION_BYTES")
    dedup_keys: tuple[str, ...] | None = option("SPARK_FACT_DEDUP_KEYS", "keys")
    event_log_dir: str | None = option("SPARK_EVENT_LOG_DIR")

    def spark_conf(self) -> dict[str, str]:
        conf = {
            "spark.driver.memory": self.driver_memory,
            "spark.driver.memoryOverhead": self.driver_memory_overhead,
            "spark.executor.memory": self.executor_memory,
            "spark.executor.memoryOverhead": self.executor_memory_overhead,
            "spark.sql.files.maxPartitionBytes": self.max_partition_bytes,
        }
        # The stream only shuffles when it deduplicates; otherwise leave Spark's default.
        if self.dedup_keys:
            conf["spark.sql.shuffle.partitions"] = self.shuffle_partitions
        if self.event_log_dir:
            conf |= {"spark.eventLog.enabled": "true", "spark.eventLog.dir": self.event_log_dir}
        return {key: str(value) for key, value in conf.items() if value is not None}
