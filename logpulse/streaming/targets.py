"""Places a batch can be written to. Each has ``write(df, batch)``."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logpulse.config import SinkSettings
from logpulse.schema import BROKER_ROW, names
from logpulse.sources import storage
from logpulse.sources.database import absent, execute, identifier, literal, quoted
from logpulse.sources.tables import BATCH, DAY, read_table
from logpulse.streaming.batch import Batch


#: Batch keys that are folder names as they are.
PLAIN = re.compile(r"[\w.-]+", re.ASCII)


@dataclass(frozen=True)
class ParquetTable:
    """Day-partitioned Parquet, clustered within files.

    Each batch owns the ``ingest_date=…/batch_key=…`` folders it writes and a replay overwrites
    exactly those, so writing twice is writing once.
    """

    path: str
    day_of: str
    cluster_by: Sequence[str] = ()
    rebalance: bool = False

    def write(self, df: DataFrame, batch: Batch) -> None:
        rows = df.withColumns({DAY: F.to_date(self.day_of), BATCH: F.lit(batch.key)})
        if self.rebalance:
            # Backfills span many days: gather each day's rows, and let AQE split the large
            # ones, instead of every task writing a file into every day.
            rows = rows.hint("rebalance", DAY)
        if self.cluster_by:
            rows = rows.sortWithinPartitions(DAY, *self.cluster_by)
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(DAY, BATCH)
            .parquet(self.path)
        )

    def stored(self, spark: SparkSession, batch: Batch, schema: T.StructType | None = None) -> DataFrame:
        """The rows of a batch as they were written; only its own folders are listed.

        With the ``schema`` that was written none is inferred, and a batch may have had no rows.
        """
        name = f"{BATCH}={batch.key}"
        plain = PLAIN.fullmatch(batch.key)
        days = storage.subfolders(spark, self.path) if plain else []
        own = [f for day in days if storage.exists(spark, f := f"{self.path}/{day}/{name}")]
        if own:
            reader = spark.read if schema is None else spark.read.schema(schema)
            rows = reader.option("basePath", self.path).parquet(*own)
        elif plain and schema is not None:
            return spark.createDataFrame([], schema)
        else:  # nothing written, or a name that folders do not show as it is
            rows = read_table(spark, self.path).where(F.col(BATCH) == batch.key)
        return rows.drop(DAY, BATCH)


@dataclass(frozen=True)
class JdbcTable:
    settings: SinkSettings
    table: str

    def write(self, df: DataFrame, batch: Batch) -> None:
        df.write.format("jdbc").options(**self.settings.jdbc_options(self.table)).mode(
            "append"
        ).save()


@dataclass(frozen=True)
class StagedJdbcTable:
    """A table in a database that receives each batch once and whole.

    Tasks append to a staging table, under the name of this attempt. Only when all of them are
    done, one transaction of the database moves the attempt's rows over, notes the batch as moved,
    and clears what it and earlier attempts staged. A write that dies half-way leaves staged rows
    that nobody reads; a task that is run twice violates the staging table's key, and the attempt
    fails; a batch that was moved before is left alone.
    """

    settings: SinkSettings
    table: str

    @property
    def staging(self) -> str:
        return f"{identifier(self.table)}_staging"

    @property
    def moved(self) -> str:
        return f"{identifier(self.table)}_moved"

    def write(self, df: DataFrame, batch: Batch) -> None:
        spark = df.sparkSession
        self._prepare(df)
        if self.is_moved(spark, batch):
            return
        attempt = uuid.uuid4().hex
        staged = df.withColumns(
            {
                "staged_batch": F.lit(f"{batch.stream}/{batch.key}"),
                "staged_attempt": F.lit(attempt),
                "staged_row": F.monotonically_increasing_id(),
            }
        )
        self._append(staged, self.staging)
        name = {c: quoted(spark, self.settings, c) for c in staged.columns}
        columns = ", ".join(name[c] for c in df.columns)
        key = literal(f"{batch.stream}/{batch.key}")
        execute(
            spark,
            self.settings,
            f"INSERT INTO {self.moved} ({name['staged_batch']}) VALUES ({key})",
            f"INSERT INTO {self.table} ({columns}) SELECT {columns} FROM {self.staging} "
            f"WHERE {name['staged_attempt']} = {literal(attempt)}",
            f"DELETE FROM {self.staging} WHERE {name['staged_batch']} = {key}",
        )

    def is_moved(self, spark: SparkSession, batch: Batch) -> bool:
        moved = spark.read.format("jdbc").options(**self.settings.jdbc_options()).option("dbtable", self.moved)
        return not moved.load().where(F.col("staged_batch") == f"{batch.stream}/{batch.key}").isEmpty()

    def _append(self, df: DataFrame, table: str) -> None:
        keys = "staged_batch VARCHAR(255), staged_attempt VARCHAR(64)"
        names = [k for k in keys.split(", ") if k.split()[0] in df.columns]
        writer = df.write.format("jdbc").options(**self.settings.jdbc_options(table))
        if names:
            writer = writer.option("createTableColumnTypes", ", ".join(names))
        writer.mode("append").save()

    def _prepare(self, df: DataFrame) -> None:
        """The three tables, as far as they do not exist; keys come with the tables."""
        spark = df.sparkSession
        if self._exists(spark, self.moved):
            return
        none = df.limit(0)
        extra = {"staged_batch": F.lit(""), "staged_attempt": F.lit(""), "staged_row": F.lit(0).cast("bigint")}
        self._append(none, self.table)
        self._append(none.withColumns(extra), self.staging)
        self._append(none.select(F.lit("").alias("staged_batch")), self.moved)
        key = {c: quoted(spark, self.settings, c) for c in extra}
        for table, columns in ((self.staging, ["staged_attempt", "staged_row"]), (self.moved, ["staged_batch"])):
            columns = ", ".join(key[c] for c in columns)
            execute(spark, self.settings, f"CREATE UNIQUE INDEX {table.replace('.', '_')}_key ON {table} ({columns})")

    def _exists(self, spark: SparkSession, table: str) -> bool:
        try:
            spark.read.format("jdbc").options(**self.settings.jdbc_options()).option("dbtable", table).load()
        except Exception as exc:
            if absent(exc, table):
                return False
            raise
        return True


@dataclass(frozen=True)
class KafkaTopic:
    """Messages are rows with ``key`` and ``value``."""

    bootstrap: str
    topic: str

    def write(self, df: DataFrame, batch: Batch) -> None:
        (
            df.write.format("kafka")
            .option("kafka.bootstrap.servers", self.bootstrap)
            .option("topic", self.topic)
            .save()
        )


@dataclass(frozen=True)
class FileTopic:
    """A topic as a folder of files in broker-row layout; ``sources.broker`` reads it back.

    A batch that is there already is left as it is: a stream reading the folder would take
    files written anew for new messages. Offsets are distinct over all batches of a query.
    """

    root: str
    topic: str

    def write(self, df: DataFrame, batch: Batch) -> None:
        folder = f"{self.root}/{self.topic}/batch_{batch.key}"
        if storage.exists(df.sparkSession, f"{folder}/_SUCCESS"):
            return
        within = F.monotonically_increasing_id()
        rows = df.select(
            F.col("key").cast("binary"),
            F.col("value").cast("binary"),
            F.lit(self.topic).alias("topic"),
            F.shiftright(within, 33).cast("int").alias("partition"),
            (F.lit(batch.batch_id << 33) + F.pmod(within, F.lit(1 << 33))).alias("offset"),
            F.current_timestamp().alias("timestamp"),
        )
        rows.select(*names(BROKER_ROW)).write.mode("overwrite").parquet(folder)
