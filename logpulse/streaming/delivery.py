"""Getting one batch into one target: guard, retries, and what happens when all fail."""

from __future__ import annotations

import logging
from collections.abc import Callable
from enum import StrEnum
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from logpulse.config import SinkSettings
from logpulse.operators.quarantine import envelope_failed_batch, to_messages
from logpulse.streaming.batch import Batch
from logpulse.streaming.guard import GuardMissing

logger = logging.getLogger(__name__)


class Target(Protocol):
    def write(self, df: DataFrame, batch: Batch) -> None: ...


class CommitLog(Protocol):
    def seen(self, spark: SparkSession, batch: Batch) -> bool: ...
    def mark(self, spark: SparkSession, batch: Batch) -> None: ...


class Outcome(StrEnum):
    WRITTEN = "written"
    SKIPPED = "skipped"  # the guard knows the batch
    UNMARKED = "unmarked"  # written, but the guard could not be told
    BYPASSED = "bypassed"  # refused by the target, sent to the dead-letter topic
    LOST = "lost"  # refused, and told not to fail


def partitioned(
    df: DataFrame, target: int | None, *, allow_more: bool = False, current: int | None = None
) -> DataFrame:
    """Frame with at most (or, if allowed, exactly) ``target`` partitions.

    ``coalesce`` never adds partitions, so no count is needed to use it. Counting would run a
    shuffled plan's stages just to learn the number; with ``allow_more`` a caller that knows
    ``current`` saves the shuffle when there are already too many.
    """
    if not target or target <= 0:
        return df
    if not allow_more or (current is not None and current >= target):
        return df.coalesce(target)
    return df.repartition(target)


class Delivery:
    """Delivers batches of one stream to one target.

    * A batch the guard knows is skipped; a guard that does not exist is reported once and
      left alone from then on.
    * Failed writes are repeated at once: a ``foreachBatch`` function runs on the driver's
      stream thread and must not sleep.
    * A batch that was written is never written again, even if marking it fails.
    * A batch that cannot be written goes to ``bypass`` if there is one.
    """

    def __init__(
        self,
        target: Target,
        settings: SinkSettings | None = None,
        *,
        guard: CommitLog | None = None,
        bypass: Target | None = None,
    ):
        self.target = target
        self.settings = settings or SinkSettings()
        self.guard = guard
        self.bypass = bypass

    def _known(self, spark: SparkSession, batch: Batch) -> bool:
        if self.guard is None:
            return False
        try:
            return self.guard.seen(spark, batch)
        except GuardMissing as exc:
            logger.warning("batch guard switched off: %s does not exist", exc)
            self.guard = None
            return False

    def __call__(
        self, df: DataFrame, batch: Batch, *, stamp: Callable[[DataFrame], DataFrame] | None = None
    ) -> Outcome:
        """``stamp`` is applied anew for each attempt (times of writing)."""
        spark, settings = df.sparkSession, self.settings
        if self._known(spark, batch):
            return Outcome.SKIPPED
        shaped = partitioned(
            df, settings.write_partitions, allow_more=settings.allow_repartition
        )
        attempts = max(1, settings.retry_max + 1)
        for attempt in range(1, attempts + 1):
            try:
                self.target.write(stamp(shaped) if stamp else shaped, batch)
                break
            except Exception as exc:
                logger.error("write of %s failed (%d of %d): %s", batch, attempt, attempts, exc)
                if attempt == attempts:
                    return self._give_up(df, batch, exc)
        return self._mark(spark, batch)

    def _mark(self, spark: SparkSession, batch: Batch) -> Outcome:
        if self.guard is None:
            return Outcome.WRITTEN
        try:
            self.guard.mark(spark, batch)
        except Exception:
            logger.exception("%s is written but could not be marked", batch)
            if self.settings.fail_on_error:
                raise
            return Outcome.UNMARKED
        return Outcome.WRITTEN

    def _give_up(self, df: DataFrame, batch: Batch, error: Exception) -> Outcome:
        if self.bypass is not None and self.settings.bypass_to_dlq:
            try:
                self.bypass.write(to_messages(envelope_failed_batch(df, str(error))), batch)
                return Outcome.BYPASSED
            except Exception:
                logger.exception("bypass of %s failed too", batch)
        if self.settings.fail_on_error:
            raise error
        return Outcome.LOST
