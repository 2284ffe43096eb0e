"""Rollup states on disk: one partial state per batch, merged when read.

``open/`` holds what each batch added, in folders a replay overwrites. ``closed/`` holds days
compacted into one state per key, together with the list of batches that went in. Each
compaction of a day writes a version folder of its own, and readers take the newest that is
complete and ignore the open folders of the batches it lists; older versions and merged open
folders are deleted afterwards. A job that dies in between leaves a version that nobody reads
or folders that nobody counts, so no batch counts twice or not at all. One compaction of a day
may run at a time.

Days of an age at which the finest rollups have expired are kept in wider buckets: the version's
name says how wide (``…-w60``), and rollups with narrower buckets no longer have that day.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Container, Iterable
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logpulse.plans.catalog import DLQ_ROLLUPS, EVENT_ROLLUPS
from logpulse.plans.rollups import Rollup, SharedStates
from logpulse.sources import storage
from logpulse.sources.tables import day_folders
from logpulse.streaming.batch import Batch

DAY, BATCH = "bucket_date", "batch_key"
WIDTH = re.compile(r"-w(\d+)$")


def _utc_day(at: datetime) -> date:
    return (at.astimezone(UTC) if at.tzinfo else at).date()


class RollupStore:
    def __init__(self, path: str, rollups: Iterable[Rollup], *, backfill: bool = False):
        """``rollups`` are the ones maintained; leave one out to switch it off.

        ``backfill`` gathers each day's states before writing, for batches of many days; a
        micro-batch leaves so few states that the shuffle would only cost time.
        """
        self.path = path
        self.backfill = backfill
        rollups = tuple(rollups)
        whole = next((c for c in (EVENT_ROLLUPS, DLQ_ROLLUPS) if set(rollups) <= set(c)), rollups)
        self.shared = SharedStates(rollups, grain=whole)
        # What is stored may hold more than the rollups maintained now.
        self._whole = SharedStates(whole)
        # States are filed under the day of the ingest bucket, where there is one.
        times = self.shared.keys[: len(self.shared.times)]
        self._day_of = min(times, key=lambda name: not name.endswith("kafka_received_at"))

    def __call__(self, df: DataFrame, batch: Batch) -> None:
        """Add a batch (also on replay)."""
        states = self.shared.states(df).withColumn(BATCH, F.lit(batch.key))
        self._save(states, "open", (DAY, BATCH), gather=self.backfill)

    def _save(
        self, states: DataFrame, part: str, by: tuple[str, ...], *, gather: bool
    ) -> None:
        day = F.coalesce(F.to_date(self._day_of), F.lit(date(1970, 1, 1)))
        if DAY not in states.columns:
            states = states.withColumn(DAY, day)
        if gather:
            states = states.hint("rebalance", DAY)  # AQE sizes the files
        (
            states.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*by)
            .parquet(f"{self.path}/{part}")
        )

    def _part(
        self,
        spark: SparkSession,
        part: str,
        since: date | None = None,
        until: date | None = None,
        without: Container[str] = (),
    ) -> DataFrame | None:
        """States of the wanted days: only their folders are listed, no schema is inferred."""
        folders = day_folders(spark, f"{self.path}/{part}", DAY, since, until)
        folders = [f for f in folders if f.rpartition("/")[2] not in without]
        if part == "closed":
            folders = [v[-1] for day in folders if (v := self._versions(spark, day))]
        if not folders:
            return None
        reader = spark.read.schema(f"{self._whole.ddl}, {DAY} DATE, {BATCH} STRING")
        rows = reader.option("basePath", f"{self.path}/{part}").parquet(*folders)
        return rows.drop("version")

    def _versions(self, spark: SparkSession, day: str) -> list[str]:
        """Complete versions of a compacted day, oldest first."""
        found = [f"{day}/{name}" for name in storage.subfolders(spark, day)]
        return [v for v in found if storage.exists(spark, f"{v}/_SUCCESS")]

    def width(self, spark: SparkSession, day: str) -> int:
        """Seconds of the filing time's buckets that a day (``bucket_date=…``) is kept in."""
        versions = self._versions(spark, f"{self.path}/closed/{day}")
        found = WIDTH.search(versions[-1]) if versions else None
        return int(found[1]) if found else self._whole.times[self._filed_by]

    @property
    def _filed_by(self) -> str:
        return next(t for t in self._whole.times if self._whole.bucket(t) == self._day_of)

    def _too_wide(self, spark: SparkSession, seconds: int) -> set[str]:
        """Days kept in buckets wider than that."""
        days = storage.subfolders(spark, f"{self.path}/closed")
        return {day for day in days if self.width(spark, day) > seconds}

    def states(
        self,
        spark: SparkSession,
        *,
        since: date | None = None,
        until: date | None = None,
        seconds: int | None = None,
    ) -> DataFrame:
        """Unmerged states of a range of days, without days kept in buckets wider than ``seconds``."""
        without = self._too_wide(spark, seconds) if seconds else set()
        fresh = self._part(spark, "open", since, until, without)
        closed = self._part(spark, "closed", since, until, without)
        found = []
        if closed is not None:
            found.append(closed.where(F.col(BATCH).isNull()))
            if fresh is not None:
                listed = closed.where(F.col(BATCH).isNotNull()).select(DAY, BATCH)
                fresh = fresh.join(listed, [DAY, BATCH], "left_anti")
        if fresh is not None:
            found.append(fresh)
        if not found and since is None and until is None and not without:
            raise FileNotFoundError(f"no rollup states under {self.path}")
        if not found:
            return spark.createDataFrame([], f"{self._whole.ddl}, {DAY} DATE, {BATCH} STRING")
        return found[0] if len(found) == 1 else found[0].unionByName(found[1])

    def filed(self, name: str) -> bool:
        """Is a rollup bucketed by the time its states are filed under?"""
        return self.shared.bucket(self.shared[name].at) == self._day_of

    def rollup(
        self,
        spark: SparkSession,
        name: str,
        *,
        since: datetime | None = None,
        until: datetime | None = None,
        with_day: bool = False,
    ) -> DataFrame:
        """Merged states of one rollup, buckets from ``since`` on and before ``until``.

        ``with_day`` adds the day of the bucket, ``bucket_date``, where states are filed under it:
        a filter on it reaches the scan as a partition filter. Where the rollup is bucketed by the time the states are filed under, only the day
        folders of that range are listed and, within files, row groups are cut by the stored
        bucket. Times without a zone are UTC.
        """
        r = self.shared[name]
        filed = self.filed(name)
        states = self.states(
            spark,
            since=_utc_day(since) if filed and since else None,
            until=_utc_day(until) if filed and until else None,
            seconds=r.seconds if filed else None,
        )
        for column, sign in ((self._day_of, filed), ("bucket", True)):
            if column == "bucket":
                states = self.shared.rollup(states, name, [DAY] if with_day and filed else [])
            if sign and since is not None:
                states = states.where(F.col(column) >= F.lit(since))
            if sign and until is not None:
                states = states.where(F.col(column) < F.lit(until))
        return states

    def compact(self, spark: SparkSession, day: date, alive: Iterable[Rollup] | None = None) -> None:
        """Merge a day's states into one per key. Safe to repeat; late batches stay readable.

        ``alive`` are the rollups still kept of a day of its age: buckets become as wide as they
        allow, and never narrower again.
        """
        folder = f"{self.path}/closed/{DAY}={day.isoformat()}"
        before = self._versions(spark, folder)
        filed_by, width = self._filed_by, self.width(spark, folder.rpartition("/")[2])
        wider = self._whole.coarser(alive) if alive is not None else {}
        width = max(width, wider.get(filed_by, 0))
        if width > self._whole.times[filed_by]:
            wider[filed_by] = width
        states = self.states(spark, since=day, until=day)
        merged = self._whole.merge(states, wider).withColumns(
            {BATCH: F.lit(None).cast("string")}
        )
        listed = states.where(F.col(BATCH).isNotNull()).select(BATCH)
        closed = self._part(spark, "closed", day, day)
        if closed is not None:
            listed = listed.unionByName(closed.where(F.col(BATCH).isNotNull()).select(BATCH))
        whole = merged.unionByName(listed.distinct(), allowMissingColumns=True)
        version = f"version={datetime.now(UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        if wider:
            version += f"-w{width}"
        whole.hint("rebalance").write.parquet(f"{folder}/{version}")
        for old in before:
            storage.delete(spark, old)

    def merged_batches(self, spark: SparkSession, day: date) -> list[str]:
        """Keys of the batches a compacted day is made of (names, not rows of data)."""
        closed = self._part(spark, "closed", day, day)
        if closed is None:
            return []
        listed = closed.where((F.col(DAY) == F.lit(day)) & F.col(BATCH).isNotNull())
        return [row[0] for row in listed.select(BATCH).collect()]
