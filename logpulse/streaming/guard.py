"""Log of delivered batches, for targets that cannot overwrite a replayed batch."""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logpulse.config import SinkSettings
from logpulse.schema import BATCH_GUARD, only
from logpulse.sources import storage
from logpulse.sources.database import absent, identifier
from logpulse.streaming.batch import Batch

_ROW = only(BATCH_GUARD, ["stream_name", "target_table", "query_id", "batch_id"])


class GuardMissing(Exception):
    """The log itself does not exist."""


def _marker(spark: SparkSession, batch: Batch) -> DataFrame:
    row = (batch.stream, batch.table, batch.query_id, batch.batch_id)
    return spark.createDataFrame([row], _ROW).withColumn("committed_at", F.current_timestamp())


@dataclass(frozen=True)
class FileCommitLog:
    """One folder per batch, so that looking one up touches nothing else in the log.

    Read as a table, the folder names are its columns.
    """

    path: str

    def entry(self, batch: Batch) -> str:
        keys = {
            "stream_name": batch.stream,
            "target_table": batch.table,
            "query_id": batch.query_id,
            "batch_id": str(batch.batch_id),
        }
        return "/".join([self.path, *[f"{k}={quote(v, safe='')}" for k, v in keys.items()]])

    def create(self, spark: SparkSession) -> None:
        storage.create(spark, self.path)

    def seen(self, spark: SparkSession, batch: Batch) -> bool:
        if storage.exists(spark, f"{self.entry(batch)}/_SUCCESS"):
            return True
        if not storage.exists(spark, self.path):
            raise GuardMissing(self.path)
        return False

    def mark(self, spark: SparkSession, batch: Batch) -> None:
        row = _marker(spark, batch).select("committed_at").coalesce(1)
        row.write.mode("overwrite").parquet(self.entry(batch))


@dataclass(frozen=True)
class JdbcCommitLog:
    settings: SinkSettings
    table: str

    def seen(self, spark: SparkSession, batch: Batch) -> bool:
        try:
            log = (
                spark.read.format("jdbc")
                .options(**self.settings.jdbc_options())
                .option("dbtable", identifier(self.table))
                .load()
            )
            # The filter is evaluated by the database, in its own dialect.
            return not log.where(
                (F.col("batch_id") == batch.batch_id)
                & (F.col("stream_name") == batch.stream)
                & (F.col("target_table") == batch.table)
                & (F.col("query_id") == batch.query_id)
            ).isEmpty()
        except Exception as exc:
            if absent(exc, self.table):
                raise GuardMissing(self.table) from exc
            raise

    def mark(self, spark: SparkSession, batch: Batch) -> None:
        marker = _marker(spark, batch)
        marker.write.format("jdbc").options(**self.settings.jdbc_options(self.table)).mode(
            "append"
        ).save()


def not_committed(batches: DataFrame, commits: DataFrame) -> DataFrame:
    """Batches without an entry in the log, for recovery over many batches at once."""
    keys = ["stream_name", "target_table", "query_id", "batch_id"]
    return batches.join(commits.select(*keys), keys, "left_anti")
