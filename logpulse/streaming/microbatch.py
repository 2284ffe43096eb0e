"""The function a stream runs for each micro-batch."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logpulse.functions.timebuckets import to_millis
from logpulse.operators.dedup import drop_repeats
from logpulse.schema import STORED_AT
from logpulse.streaming.batch import Batch
from logpulse.streaming.delivery import Delivery, Outcome, partitioned
from logpulse.streaming.timing import TimingLog
from logpulse.streaming.vitals import BatchVitals

AfterWrite = Callable[[DataFrame, Batch], None]


class MicroBatch:
    """Prepare, stamp, deliver, and pass on to whoever maintains derived tables.

    ``then`` functions get the batch as stored (same stamps). They must be idempotent per
    batch, because a failure after the write replays the batch. With ``reread`` they read it
    back from the target (which has ``stored``) and it is not held for them: for large batches.
    """

    def __init__(
        self,
        delivery: Delivery,
        *,
        stream: str,
        table: str,
        query: str | None = None,
        pre_coalesce: int | None = None,
        skip_empty: bool = False,
        dedup_keys: Sequence[str] | None = None,
        stamps: bool = True,
        then: Sequence[AfterWrite] = (),
        hold: bool | None = None,
        reread: bool = False,
        timings: TimingLog | None = None,
        vitals: BatchVitals | None = None,
    ):
        self.delivery = delivery
        self.stream, self.table, self.query = stream, table, query
        self.pre_coalesce, self.skip_empty = pre_coalesce, skip_empty
        self.dedup_keys = dedup_keys
        self.stamps = stamps
        self.then = tuple(then)
        self.reread = reread
        # Read more than once (emptiness, derived tables): keep the rows for the batch, unless
        # the caller already does.
        self.hold = (skip_empty or bool(then) and not reread) if hold is None else hold
        self.timings = timings or TimingLog()
        self.vitals = vitals
        self.outcome: Outcome | None = None  # of the latest batch

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        batch = Batch(self.stream, self.table, batch_id, Batch.query_id_of(df), self.query)
        began = time.perf_counter()
        rows = partitioned(df, self.pre_coalesce)
        if self.hold:
            rows = rows.persist()
        try:
            if self.skip_empty and rows.isEmpty():
                self.timings.record(
                    batch, time.perf_counter() - began, stage="transform", empty=True
                )
                self.timings.record(batch, 0.0, stage="write", empty=True)
                return
            out = drop_repeats(rows, self.dedup_keys)
            if self.stamps and "spark_processed_at" in out.columns:
                out = _stamp(out, "spark_processed_at")
            # Derived tables are computed from the frame without the observation.
            watched, seen = self.vitals.watch(out) if self.vitals else (out, None)
            wrote = time.perf_counter()
            self.timings.record(batch, wrote - began, stage="transform")
            # One literal per batch, so that the table and what is derived from it agree.
            stored = datetime.now(UTC)

            def stamp(frame: DataFrame) -> DataFrame:
                return _stamp(frame, STORED_AT, stored) if self.stamps else frame

            self.outcome = self.delivery(watched, batch, stamp=stamp)
            if self.outcome not in (Outcome.BYPASSED, Outcome.LOST):
                kept = stamp(out)
                if self.outcome is Outcome.SKIPPED and hasattr(self.delivery.target, "stored"):
                    # Written before, with stamps of its own: derived tables must agree.
                    kept = self.delivery.target.stored(df.sparkSession, batch)
                elif self.reread and self.then:
                    kept = self.delivery.target.stored(df.sparkSession, batch, kept.schema)
                for follow in self.then:
                    follow(kept, batch)
            written = time.perf_counter() - wrote
            self.timings.record(batch, written, stage="write")
            if seen is not None and self.outcome in (Outcome.WRITTEN, Outcome.UNMARKED):
                self.vitals.record(
                    df.sparkSession,
                    batch,
                    seen,
                    outcome=self.outcome.name.lower(),
                    transform_seconds=wrote - began,
                    write_seconds=written,
                )
        finally:
            if self.hold:
                rows.unpersist()


def _stamp(df: DataFrame, column: str, at: datetime | None = None) -> DataFrame:
    at = at or datetime.now(UTC)
    return df.withColumn(column, to_millis(F.lit(at)))


def start(
    df: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    query: str | None = None,
    trigger: str | None = None,
    once: bool = False,
    output_mode: str = "append",
) -> StreamingQuery:
    """Start a stream. ``once`` takes what is there in rate-limited batches and stops."""
    writer = (
        df.writeStream.outputMode(output_mode)
        .foreachBatch(each)
        .option("checkpointLocation", checkpoint)
    )
    if once:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    if query:
        writer = writer.queryName(query)
    return writer.start()
