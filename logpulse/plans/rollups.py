"""Rollups as data: one spec drives batch, backfill, per-batch maintenance and streaming.

A rollup holds *partial states* (counts, sums, maxima, sketches). States of disjoint inputs can
be merged in any order, so late rows need no special treatment: they arrive as one more state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logpulse.functions.quantiles import SKETCH_K, sketch_quantile
from logpulse.functions.timebuckets import bucket_of


@dataclass(frozen=True)
class Measure:
    """An aggregate with a mergeable state. ``expr`` and ``where`` are SQL."""

    name: str
    kind: str  # count | sum | max | quantile
    expr: str = "1"
    where: str | None = None

    def state(self, rows: str | None = None) -> Column:
        """State over input rows; ``rows`` is a further row filter."""
        tests = [t for t in (rows, self.where) if t]
        call = {
            "count": f"count({self.expr})",
            "sum": f"sum(CAST({self.expr} AS BIGINT))",
            "max": f"max({self.expr})",
            "quantile": f"kll_sketch_agg_double(CAST({self.expr} AS DOUBLE), {SKETCH_K})",
        }[self.kind]
        if tests:
            call += " FILTER (WHERE " + " AND ".join(f"({t})" for t in tests) + ")"
        if self.kind == "sum":
            call = f"coalesce({call}, 0L)"
        return F.expr(call)

    def merged(self, state: str | None = None) -> Column:
        """State over states."""
        state = state or self.name
        return {
            "count": F.sum(state),
            "sum": F.sum(state),
            "max": F.max(state),
            "quantile": F.expr(f"kll_merge_agg_double({state})"),
        }[self.kind]


@dataclass(frozen=True)
class Rollup:
    """``GROUP BY bucket(at, seconds), dims`` over the rows that satisfy ``where``."""

    name: str
    at: str
    seconds: int
    measures: tuple[Measure, ...]
    dims: tuple[tuple[str, str], ...] = ()  # (name, SQL)
    where: str | None = None
    keep_days: int = 7

    @property
    def keys(self) -> list[str]:
        return ["bucket", *[name for name, _ in self.dims]]

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *[m.name for m in self.measures]]

    def _grouped(self, df: DataFrame, bucket: Column) -> DataFrame:
        rows = df.where(self.where) if self.where else df
        keys = [bucket.alias("bucket"), *[F.expr(sql).alias(name) for name, sql in self.dims]]
        return rows.groupBy(*keys).agg(*[m.state().alias(m.name) for m in self.measures])

    def states(self, df: DataFrame) -> DataFrame:
        """Partial states of a batch frame."""
        return self._grouped(df, bucket_of(self.at, self.seconds))

    def stream_states(self, df: DataFrame, watermark: str) -> DataFrame:
        """Native streaming aggregation: states are emitted once a bucket is closed.

        Rows later than the watermark are dropped, unlike in per-batch maintenance. Only for
        rollups by the broker's time: a time that payloads bring could close every bucket.
        """
        if self.at != "kafka_received_at":
            raise ValueError(f"{self.name} is bucketed by {self.at}, which payloads set")
        windowed = self._grouped(
            df.withWatermark(self.at, watermark), F.window(self.at, f"{self.seconds} seconds")
        )
        return windowed.withColumn("bucket", F.col("bucket.start"))

    def merge(self, states: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
        """Merge states with equal keys; ``by`` merges over the dimensions it leaves out."""
        by = self.keys if by is None else list(by)
        return states.groupBy(*by).agg(*[m.merged().alias(m.name) for m in self.measures])

    def answers(self, merged: DataFrame, q: float = 0.95) -> DataFrame:
        """Replace sketches by the quantile they hold; other states are already answers."""
        return merged.select(
            *[c for c in merged.columns if c not in {m.name for m in self.measures}],
            *[
                sketch_quantile(m.name, q).alias(m.name) if m.kind == "quantile" else F.col(m.name)
                for m in self.measures
            ],
        )


def _stored_name(kind: str, *parts: str | None) -> str:
    """Name of a stored state, from what it is alone: the same in every subset of rollups."""
    text = "\0".join(p or "" for p in parts)
    return f"{kind}_{hashlib.sha256(text.encode()).hexdigest()[:16]}"


class SharedStates:
    """Several rollups over one input, computed in a single aggregation.

    The input is grouped once, at the coarsest grain every rollup can be merged up from: the
    finest bucket of each time column plus all dimensions. Equal measures are computed once.
    At scale this is what matters: the input is scanned and parsed once however many rollups
    it feeds, and only states (a few rows per bucket) are shuffled after that.
    """

    def __init__(self, rollups: Iterable[Rollup], grain: Iterable[Rollup] | None = None):
        """``grain`` are the rollups whose common grain is kept, if more than ``rollups``.

        Stored names and grain then stay the same whichever of them are switched on.
        """
        self.rollups = tuple(rollups)
        self.times: dict[str, int] = {}
        self.dims: dict[str, str] = {}
        self._measures: dict[tuple, tuple[str, Measure, str | None]] = {}
        self._presence: dict[str | None, str] = {}
        for r in self.rollups if grain is None else grain:
            self.times[r.at] = gcd(self.times.get(r.at, 0), r.seconds)
            self.dims.update(r.dims)
        for r in self.rollups:
            self._presence.setdefault(r.where, _stored_name("rows", r.where))
            for m in r.measures:
                identity = self._identity(r, m)
                self._measures.setdefault(identity, (_stored_name(*identity), m, r.where))

    @staticmethod
    def _identity(r: Rollup, m: Measure) -> tuple:
        return (m.kind, m.expr, m.where, r.where)

    @staticmethod
    def bucket(time: str) -> str:
        """Name of the stored bucket of a time column."""
        return f"bucket_of__{time}"

    def __getitem__(self, name: str) -> Rollup:
        return {r.name: r for r in self.rollups}[name]

    @property
    def keys(self) -> list[str]:
        return [*map(self.bucket, self.times), *self.dims]

    def coarser(self, alive: Iterable[Rollup]) -> dict[str, int]:
        """Time columns whose buckets may become wider when only ``alive`` rollups are read."""
        needed: dict[str, int] = {}
        for r in alive:
            needed[r.at] = gcd(needed.get(r.at, 0), r.seconds)
        return {t: needed[t] for t, s in self.times.items() if needed.get(t, s) > s}

    @property
    def ddl(self) -> str:
        """Declared schema of stored states."""
        kinds = {"count": "BIGINT", "sum": "BIGINT", "quantile": "BINARY", "max": "TIMESTAMP"}
        columns = [f"{self.bucket(t)} TIMESTAMP" for t in self.times]
        columns += [f"{name} STRING" for name in self.dims]
        columns += [f"{name} BIGINT" for name in self._presence.values()]
        columns += [f"{name} {kinds[m.kind]}" for name, m, _ in self._measures.values()]
        return ", ".join(columns)

    def states(self, df: DataFrame) -> DataFrame:
        keys = [bucket_of(t, s).alias(self.bucket(t)) for t, s in self.times.items()]
        keys += [F.expr(sql).alias(name) for name, sql in self.dims.items()]
        present = [
            F.expr(f"count_if({where})" if where else "count(1)").alias(name)
            for where, name in self._presence.items()
        ]
        held = [m.state(where).alias(name) for name, m, where in self._measures.values()]
        return df.groupBy(*keys).agg(*present, *held)

    def merge(self, states: DataFrame, seconds: dict[str, int] | None = None) -> DataFrame:
        """Merge shared states of several batches (compaction), at coarser buckets if told so.

        ``seconds`` are the buckets of each time column, multiples of those the states have.
        """
        widths = {self.bucket(t): s for t, s in (seconds or {}).items()}
        keys = [bucket_of(k, widths[k]).alias(k) if k in widths else F.col(k) for k in self.keys]
        return states.groupBy(*keys).agg(
            *[F.sum(name).alias(name) for name in self._presence.values()],
            *[m.merged(name).alias(name) for name, m, _ in self._measures.values()],
        )

    def rollup(self, states: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
        """One rollup's merged states out of the shared ones.

        ``by`` are further columns to group by, such as the day that states are filed under.
        """
        r = self[name]
        present = states.where(F.col(self._presence[r.where]) > 0)
        keys = [
            *by,
            bucket_of(self.bucket(r.at), r.seconds).alias("bucket"),
            *[F.col(dim) for dim, _ in r.dims],
        ]
        return present.groupBy(*keys).agg(
            *[m.merged(self._measures[self._identity(r, m)][0]).alias(m.name) for m in r.measures]
        )


def union_states(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
