"""Vital signs of batches, gathered while they are written and kept as a shared table.

Counts and times are observed on the rows on their way to the sink, so no pass of their own is
made. One small row for each batch goes to a day-partitioned table, whose folders a replay
overwrites; ``telemetry.batch_vitals`` reads it on any machine.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logpulse.sources.telemetry import BATCH_VITALS
from logpulse.streaming.batch import Batch
from logpulse.streaming.targets import ParquetTable


class BatchVitals:
    """Rows, late rows and the range of receive times of every batch written.

    A row is late if its broker time is more than ``late_after`` seconds after the event's own.
    """

    def __init__(self, path: str, late_after: float = 60.0):
        self.table = ParquetTable(path, "logged_at")
        self.late_after = late_after

    def watch(self, df: DataFrame) -> tuple[DataFrame, Observation]:
        """The frame with an observation that the first action on it completes."""
        have = set(df.columns)
        received = F.col("kafka_received_at") if "kafka_received_at" in have else F.lit(None).cast("timestamp")
        late = F.lit(None).cast("bigint")
        if {"kafka_received_at", "event_timestamp"} <= have:
            behind = F.unix_millis("kafka_received_at") - F.unix_millis("event_timestamp")
            late = F.count_if(behind > F.lit(int(self.late_after * 1000)))
        seen = Observation()
        measures = {"rows": F.count(F.lit(1)), "late_rows": late, "oldest": F.min(received), "newest": F.max(received)}
        return df.observe(seen, *[m.alias(name) for name, m in measures.items()]), seen

    def record(
        self,
        spark: SparkSession,
        batch: Batch,
        seen: Observation,
        *,
        outcome: str,
        transform_seconds: float,
        write_seconds: float,
    ) -> None:
        found = seen.get
        row = (
            batch.stream, batch.table, batch.query_id, batch.batch_id, outcome,
            found["rows"], found["late_rows"], found["oldest"], found["newest"],
            transform_seconds, write_seconds, datetime.now(UTC),
        )
        # Several batch functions may run for one batch of a query.
        own = replace(batch, query_id=f"{batch.stream}-{batch.query_id}")
        self.table.write(spark.createDataFrame([row], BATCH_VITALS).coalesce(1), own)
