"""Identity of a micro-batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Batch:
    stream: str
    table: str
    batch_id: int
    query_id: str = "batch"
    query: str | None = None

    @property
    def key(self) -> str:
        """Partition value under which the batch is stored, the same on every replay.

        Batch ids restart at zero when a checkpoint is discarded; the query id is then new as
        well, so old data is never taken for a replay of new data.
        """
        return f"{self.query_id}-{self.batch_id}"

    @staticmethod
    def query_id_of(df: DataFrame) -> str:
        """Id of the streaming query a ``foreachBatch`` function is running for."""
        found = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        return found or "batch"
