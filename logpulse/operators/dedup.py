"""Removing repeated deliveries, in the three places it can be done, and at read time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What makes an event, which of its versions is newest, and what decides between equal ones.
EVENT_KEYS = ("service", "event_id")
VERSION = "spark_processed_at"
TIES = ("kafka_offset", "topic", "kafka_partition")

DELIVERY_ORDER = ("kafka_received_at", "topic", "kafka_partition", "kafka_offset")


def drop_repeats(
    df: DataFrame,
    keys: Sequence[str] | None,
    *,
    watermark: str | None = None,
    event_time: str = "kafka_received_at",
) -> DataFrame:
    """First delivery per key.

    * no keys: pass through (repeats are settled at read time by ``keep_latest``);
    * stream with keys and watermark: stateful, for repeats at most ``watermark`` apart. The
      watermark follows the broker's clock: one event with a wrong time of its own would else
      move it past all that is yet to come, and later events would be dropped as late;
    * otherwise: within the frame handed in, which for a stream is done per micro-batch.

    Within a frame the earliest delivery by broker coordinates is kept, as far as the frame has
    them: a batch that is evaluated twice (for a table and a rollup, or after losing an
    executor) must not choose differently.
    """
    if not keys:
        return df
    keys = list(keys)
    if df.isStreaming and watermark:
        if event_time not in df.columns:
            raise ValueError(f"deduplication within a watermark needs column {event_time}")
        absent = [key for key in keys if key not in df.columns]
        if absent:
            raise ValueError(f"deduplication keys not in the stream: {', '.join(absent)}")
        return df.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(keys)
    if df.isStreaming:
        raise ValueError("a stream without a watermark is deduplicated per micro-batch")
    order = [c for c in DELIVERY_ORDER if c in df.columns and c not in keys]
    if not order:
        return df.dropDuplicates(keys)
    return _first(df, [F.col(k) for k in keys], [F.col(c).asc_nulls_last() for c in order])


def _first(df: DataFrame, by: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """First row of each group.

    Ranking with a limit of one is cut before the shuffle (WindowGroupLimit), so a key that
    holds a large share of the rows leaves each task as a single row.
    """
    ranked = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", ranked).where("_rank = 1").drop("_rank")


def keep_latest(
    df: DataFrame,
    *,
    keys: Sequence[str] = EVENT_KEYS,
    version: str = VERSION,
    ties: Sequence[str] = TIES,
    scope: str = "table",
    day_of: str = "kafka_received_at",
) -> DataFrame:
    """Newest version of each key; ties are broken, so the answer does not depend on order.

    ``scope="partition"`` keeps one per ingest day, which is what a day-partitioned table
    settles by itself; ``scope="table"`` keeps one overall.
    """
    if scope not in ("table", "partition"):
        raise ValueError(f"scope must be 'table' or 'partition', got {scope!r}")
    by = [F.col(k) for k in keys] + ([F.to_date(day_of)] if scope == "partition" else [])
    order = [F.col(version).desc_nulls_last(), *[F.col(t).desc_nulls_last() for t in ties]]
    return _first(df, by, order)
