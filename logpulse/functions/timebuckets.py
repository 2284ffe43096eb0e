"""Time buckets and boundary-counting differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_of(ts: Column | str, seconds: int) -> Column:
    """Start of the ``seconds``-wide bucket holding ``ts`` (buckets are aligned to the epoch).

    Plain arithmetic, so several widths can be computed in one projection, which
    ``F.window`` does not allow.
    """
    whole = F.unix_seconds(F.col(ts) if isinstance(ts, str) else ts)
    return F.timestamp_seconds(whole - F.pmod(whole, F.lit(seconds)))


def lag_seconds(start: str, end: str) -> str:
    """SQL for the number of second boundaries between two instants (not elapsed time)."""
    return f"(unix_seconds({end}) - unix_seconds({start}))"


def to_millis(ts: Column) -> Column:
    """Cut a timestamp to the millisecond precision of the stored tables."""
    return F.date_trunc("MILLISECOND", ts)
