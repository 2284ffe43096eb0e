"""Spark session with the settings the engine relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from logpulse.config import SessionSettings

# Settings that change results or plans, applied to whatever session is handed in.
ENGINE_CONF = {
    # Bucketing and time-zone-less inputs are read as UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# State of streaming deduplication and of the alert operators goes to RocksDB, off heap.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tune(spark: SparkSession, *, streaming: bool = False) -> SparkSession:
    """Apply the engine's runtime settings to an existing session."""
    for key, value in {**ENGINE_CONF, **(STREAM_CONF if streaming else {})}.items():
        spark.conf.set(key, value)
    return spark


def build_session(settings: SessionSettings | None = None) -> SparkSession:
    settings = settings or SessionSettings.load()
    builder = SparkSession.builder.appName(settings.app_name)
    if settings.master:
        builder = builder.master(settings.master)
    for key, value in settings.spark_conf().items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.parquet.compression.codec", "zstd")
    return tune(builder.getOrCreate(), streaming=True)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Only when the session names none and runs in one process (tests) is a temporary folder
    used: on a cluster each executor would write to its own disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{shared.rstrip('/')}/logpulse/{purpose}-{uuid.uuid4().hex[:12]}"
