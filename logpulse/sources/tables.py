"""Scans of stored tables: partition columns are dates, so time filters prune folders."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logpulse.sources import storage

DAY, BATCH = "ingest_date", "batch_key"


def read_table(
    spark: SparkSession,
    path: str,
    ddl: str | None = None,
    *,
    since: date | None = None,
    until: date | None = None,
) -> DataFrame:
    """Rows of a day-partitioned table, with ``ingest_date`` and ``batch_key``."""
    reader = spark.read
    if ddl:
        reader = reader.schema(f"{ddl}, {DAY} DATE, {BATCH} STRING")
    if since is not None or until is not None:
        folders = day_folders(spark, path, DAY, since, until)
        if folders:
            return reader.option("basePath", path).parquet(*folders)
    rows = reader.parquet(path)
    if since is not None:
        rows = rows.where(F.col(DAY) >= F.lit(since))
    if until is not None:
        rows = rows.where(F.col(DAY) <= F.lit(until))
    return rows


def day_folders(
    spark: SparkSession, path: str, day: str, since: date | None, until: date | None
) -> list[str]:
    """Paths of a table's day folders within a range: one listing of the days, none below.

    The folder of rows without a day is only in an unlimited range.
    """
    found = []
    for name in storage.subfolders(spark, path):
        key, _, value = name.partition("=")
        if key != day:
            continue
        try:
            at = date.fromisoformat(value)
        except ValueError:
            at = None
        wanted = since is None and until is None
        if at is not None:
            wanted = (since is None or at >= since) and (until is None or at <= until)
        if wanted:
            found.append(f"{path}/{name}")
    return found
