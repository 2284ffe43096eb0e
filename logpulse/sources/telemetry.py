"""The engine's own traces as tables: progress lines, batch timings, offsets."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logpulse.sources.tables import BATCH, DAY, read_table

BATCH_VITALS = (
    "stream STRING, table_name STRING, query_id STRING, batch_id BIGINT, outcome STRING, "
    "rows BIGINT, late_rows BIGINT, oldest TIMESTAMP, newest TIMESTAMP, "
    "transform_seconds DOUBLE, write_seconds DOUBLE, logged_at TIMESTAMP"
)


def batch_vitals(
    spark: SparkSession, path: str, *, since: date | None = None, until: date | None = None
) -> DataFrame:
    """What ``streaming.vitals`` kept of each batch, by days of logging."""
    return read_table(spark, path, BATCH_VITALS, since=since, until=until).drop(DAY, BATCH)


PROGRESS = (
    "ts STRING, event STRING, queryName STRING, name STRING, id STRING, runId STRING, "
    "exception STRING, progress STRUCT<batchId: BIGINT, numInputRows: BIGINT, "
    "inputRowsPerSecond: DOUBLE, processedRowsPerSecond: DOUBLE, timestamp: STRING, "
    "durationMs: MAP<STRING, BIGINT>>"
)


def progress(spark: SparkSession, path: str) -> DataFrame:
    """Streaming progress, one row per started, progressed or terminated event."""
    lines = spark.read.schema(PROGRESS).json(path)
    return lines.select(
        F.to_timestamp("ts").alias("at"),
        F.coalesce("event", F.lit("progress")).alias("event"),
        F.coalesce("queryName", "name").alias("query"),
        "id",
        F.col("runId").alias("run_id"),
        "progress.batchId",
        "progress.numInputRows",
        "progress.inputRowsPerSecond",
        "progress.processedRowsPerSecond",
        F.col("progress.durationMs.triggerExecution").alias("trigger_ms"),
        "exception",
    )


# Fixed value: layout of a timing line.
TIMING_LINE = (
    r"^(\S+) \[spark batch\] stream=(\S+) table=(\S+)(?: query=(\S+))? batch_id=(\d+)"
    r"(?: stage=(transform|write))?( empty=true)? duration=([0-9.]+)s$"
)


def timing_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Timing lines to columns; other lines are left out."""

    def part(n: int):
        return F.regexp_extract(column, TIMING_LINE, n)

    return lines.where(F.col(column).rlike(TIMING_LINE)).select(
        F.to_timestamp(part(1)).alias("at"),
        part(2).alias("stream"),
        part(3).alias("table"),
        F.nullif(part(4), F.lit("")).alias("query"),
        part(5).cast("bigint").alias("batch_id"),
        F.nullif(part(6), F.lit("")).alias("stage"),
        (part(7) != "").alias("empty"),
        part(8).cast("double").alias("seconds"),
    )


def timings(spark: SparkSession, path: str) -> DataFrame:
    return timing_lines(spark.read.text(path))


def latest_offsets(lines: DataFrame, column: str = "value") -> DataFrame:
    """``topic:partition:offset`` lines, as broker tools print them."""
    line = r"^([^:]+):([0-9]+):([0-9]+)$"
    text = F.trim(column)
    return lines.where(text.rlike(line)).select(
        F.regexp_extract(text, line, 1).alias("topic"),
        F.regexp_extract(text, line, 2).cast("int").alias("partition"),
        F.regexp_extract(text, line, 3).cast("bigint").alias("latest"),
    )


TOPIC_OFFSETS = "MAP<STRING, MAP<STRING, BIGINT>>"  # {"topic": {"0": offset}}


def _by_partition(topics: DataFrame) -> DataFrame:
    """Rows of ``_topics`` maps to ``topic, partition, committed``."""
    return (
        topics.select(F.explode("_topics").alias("topic", "_partitions"))
        .select("topic", F.explode("_partitions").alias("_partition", "committed"))
        .select("topic", F.expr("try_cast(_partition AS INT)").alias("partition"), "committed")
        .where("partition IS NOT NULL AND committed IS NOT NULL")
    )


def committed_offsets(lines: DataFrame, column: str = "value") -> DataFrame:
    """Offset lines as a source writes them to its checkpoint."""
    found = lines.where(F.col(column).startswith("{"))
    return _by_partition(found.select(F.from_json(column, TOPIC_OFFSETS).alias("_topics")))


def progress_offsets(lines: DataFrame, query: str, column: str = "value") -> DataFrame:
    """End offsets of a query's sources in its newest progress line."""
    told = lines.select(
        F.from_json(
            column,
            "queryName STRING, progress STRUCT<batchId: BIGINT, sources: ARRAY<STRUCT<"
            "endOffset: STRING>>>",
        ).alias("_line")
    ).where(F.col("_line.queryName") == query)
    newest = told.agg(F.max_by("_line.progress.sources", "_line.progress.batchId").alias("_s"))
    ends = newest.select(F.explode("_s.endOffset").alias("_end"))
    return _by_partition(ends.select(F.from_json("_end", TOPIC_OFFSETS).alias("_topics")))


def checkpoint_offsets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Offsets of the newest batch of a checkpoint."""
    files = spark.read.text(f"{checkpoint}/offsets").select(
        "value",
        F.expr("try_cast(substring_index(_metadata.file_name, '/', -1) AS BIGINT)").alias("batch"),
    )
    newest = files.select(F.max("batch")).scalar()
    # Header and metadata lines carry no topic maps and drop out in parsing.
    return committed_offsets(files.where(F.col("batch") == newest))
