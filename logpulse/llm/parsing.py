"""Document fingerprints by locally consistent parsing.

A text is a sequence of names, one for each code point. At each level runs of equal names become one
name; deterministic coin tossing turns each name, compared with the one before it, into a label of a
few values; phrases start where labels are locally greatest and get a name made of their parts. Labels
depend on a bounded neighbourhood only, so equal substrings are cut alike but near their ends,
wherever they stand. The fingerprint of a text is a minhash signature of its phrase names.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logpulse.llm.common import add_columns

#: Minima that make up a fingerprint, and the bits kept of each.
MINIMA, KEPT_BITS = 64, 16
#: The lowest level whose phrases count; of shorter texts, the highest that they have.
LEVEL = 2
#: Rounds of coin tossing: 64 bits become 7, 4, 3 and then one of six labels.
ROUNDS = 4
#: Code points parsed side by side.
BLOCK = 1 << 18

_A, _B, _C = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_SHIFTS = tuple(np.uint64(s) for s in (30, 27, 31))
_MULTIPLIERS = (np.random.default_rng(64).integers(0, 1 << 63, MINIMA, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _SHIFTS[0])) * _A
    x = (x ^ (x >> _SHIFTS[1])) * _B
    return x ^ (x >> _SHIFTS[2])


def labels(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Coin tossing: labels under six of names that differ from the one before; `first` starts a text."""
    x = names
    for _ in range(ROUNDS):
        before = np.empty_like(x)
        before[1:] = x[:-1]
        before[first] = x[first] ^ x.dtype.type(1)
        differ = x ^ before
        place = np.bitwise_count((differ & -differ) - x.dtype.type(1))
        x = (place << np.uint8(1)) | ((x >> place.astype(x.dtype)) & x.dtype.type(1)).astype(np.uint8)
    return x


def parse_level(names: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of the next level, and the texts that they are of."""
    start = np.flatnonzero(np.concatenate([[True], (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])]))
    run = np.diff(np.append(start, len(names))).astype(np.uint64)
    names, owner = names[start], owner[start]
    names = np.where(run > 1, _mix(names ^ (run * _C)), names)
    # Two unequal names may be made equal by a run's name with negligible probability (2**-64).
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    label = labels(names, first).astype(np.int16)
    begins = np.zeros(len(names), bool)
    begins[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    last = np.append(first[1:] - 1, len(names) - 1)
    begins[last] = False
    begins[first[first + 1 < len(names)] + 1] = False  # no phrase of one name at a text's start
    begins[first] = True
    at = np.flatnonzero(begins)
    size = np.diff(np.append(at, len(names)))
    position = (np.arange(len(names)) - np.repeat(at, size)).astype(np.uint64)
    parts = _mix(names + position * _C + _A)
    return _mix(np.add.reduceat(parts, at) ^ (size.astype(np.uint64) * _B)), owner[at]


def phrases(codes: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(name, text) of the phrases that make up fingerprints, of all levels from LEVEL up."""
    with np.errstate(over="ignore"):
        names, level = _mix(codes.astype(np.uint64) + _C), 0
        kept_names, kept_owner = [], []
        while len(names):
            final = np.bincount(owner, minlength=texts)[owner] == 1
            use = final if level < LEVEL else np.ones(len(names), bool)
            kept_names.append(names[use])
            kept_owner.append(owner[use])
            names, owner = names[~final], owner[~final]
            if len(names):
                names, owner = parse_level(names, owner)
                level += 1
    return np.concatenate(kept_names or [np.zeros(0, np.uint64)]), np.concatenate(kept_owner or [np.zeros(0, np.int64)])


def signatures(texts: list[str]) -> np.ndarray:
    """(texts, MINIMA) least values of the phrase names under each multiplier; empty texts have the greatest."""
    out = np.full((len(texts), MINIMA), np.uint64(0xFFFFFFFFFFFFFFFF))
    sizes = [len(t) for t in texts]
    start = 0
    while start < len(texts):
        stop, total = start + 1, sizes[start]
        while stop < len(texts) and total + sizes[stop] <= BLOCK:
            total += sizes[stop]
            stop += 1
        codes = np.frombuffer("".join(texts[start:stop]).encode("utf-32-le", "surrogatepass"), np.uint32)
        names, owner = phrases(codes, np.repeat(np.arange(stop - start), sizes[start:stop]), stop - start)
        if len(names):
            order = np.argsort(owner, kind="stable")
            names, owner = names[order], owner[order]
            cuts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            with np.errstate(over="ignore"):
                for k in range(MINIMA):
                    out[start + owner[cuts], k] = np.minimum.reduceat(_mix(names * _MULTIPLIERS[k]), cuts)
        start = stop
    return out


def fingerprints(texts: list[str]) -> np.ndarray:
    """(texts, MINIMA) of KEPT_BITS bits."""
    return (signatures(texts) >> np.uint64(64 - KEPT_BITS)).astype(">u2")


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal minima, which estimates that of phrases in common. Empty texts are like one another only."""
    return (a == b).mean(axis=1)


def with_fingerprints(df: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds `fingerprint` (lowercase hex). Null and empty texts have the fingerprint of no phrases."""

    def make():
        return lambda texts: [[p.tobytes().hex() for p in fingerprints(texts)]]

    return add_columns(df, make, "fingerprint string", text=text, keep=keep)


EDITED = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _rank(key, place: int) -> tuple:
    """Order of rows: by key, null least, then by a hash of the text."""
    return (key is not None, key or 0, place)


def edited_fingerprints(df: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of the text whose last third is replaced by the start of the next.

    The next row is that of the next smaller key, null keys last and equal keys in the order of a hash
    of their texts; after the last row comes the first. Rows are dealt into ranges of keys; the
    greatest row of each range is also sent to the range that precedes it. The texts are shuffled
    once. The driver sees a bounded sample of keys and one row (key, hash) for each range.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("body")).withColumn("place", F.xxhash64("body"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n, scale = df.count(), 1 << 30
    sample = rows.where(F.pmod(F.xxhash64("id", "place"), F.lit(scale)) < -(-scale * 100 * parts // max(1, n))).select("id", "place").limit(200 * parts).collect()
    ranked = sorted(_rank(*r) for r in sample)
    bounds = sorted({ranked[len(ranked) * k // parts] for k in range(1, parts)}) if ranked else []

    def ranges(batches):
        for batch in batches:
            found = [bisect_right(bounds, _rank(i, p)) for i, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), batch.column(0), batch.column(1)], names=["part", "id", "place"])

    tops = rows.select("id", "place").mapInArrow(ranges, "part int, id long, place long")
    tops = tops.groupBy("part").agg(F.max(F.struct(F.col("id").isNotNull().alias("known"), "id", "place")).alias("top")).collect()
    filled = sorted(r["part"] for r in tops)
    # Where the greatest row of a range goes besides: to the range above it, and from the top round to the lowest.
    above = {part: filled[(k + 1) % len(filled)] for k, part in enumerate(filled)}
    tops = {(r["top"]["id"], r["top"]["place"]): r["part"] for r in tops}
    dealt_schema = "part int, copy boolean, id long, place long, body string"

    def deal(batches):
        sent = set()
        for batch in batches:
            ids, places = batch.column("id").to_pylist(), batch.column("place").to_pylist()
            own = [bisect_right(bounds, _rank(i, p)) for i, p in zip(ids, places)]
            take, part, copy = list(range(len(ids))), list(own), [False] * len(ids)
            for k, top in enumerate(zip(ids, places)):
                if top in tops and top not in sent:
                    sent.add(top)
                    take.append(k)
                    part.append(above[tops[top]])
                    copy.append(True)
            moved = batch.take(pa.array(take, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(copy), moved.column("id"), moved.column("place"), moved.column("body")], names=["part", "copy", "id", "place", "body"])

    dealt = rows.select("id", "place", "body").mapInArrow(deal, dealt_schema).repartition(parts, "part")
    dealt = dealt.sortWithinPartitions("part", "copy", F.desc_nulls_last("id"), F.desc("place"))

    def compare(batches) -> Iterator[pa.RecordBatch]:
        names = [key, *(f.split(" ")[0] for f in EDITED.split(", "))]
        held: list[tuple] = []  # rows (part, copy, id, text) whose successor may still come

        def finish(ready: list[tuple]) -> pa.RecordBatch | None:
            pairs = [(a, b) for a, b in zip(ready, ready[1:]) if not a[1] and a[0] == b[0]]
            if not pairs:
                return None
            texts = [r[3] for r in ready]
            edited = [a[3][: len(a[3]) - len(a[3]) // 3] + b[3][: len(a[3]) // 3] for a, b in pairs]
            prints = fingerprints(texts + edited)
            own = [k for k, (a, b) in enumerate(zip(ready, ready[1:])) if not a[1] and a[0] == b[0]]
            now, after, changed = prints[own], prints[[k + 1 for k in own]], prints[len(texts) :]
            columns = [
                pa.array([a[2] for a, _ in pairs], pa.int64()), pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited], [p.tobytes().hex() for p in now], [p.tobytes().hex() for p in changed],
                pa.array(likeness(now, changed), pa.float64()), pa.array(likeness(now, after), pa.float64()),
            ]
            return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.string()) for c in columns], names=names)

        chars = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("part", "copy", "id", "body"))):
                held.append((row[0], row[1], row[2], row[3] or ""))
                chars += len(held[-1][3])
                if chars > BLOCK and len(held) > 1:
                    if out := finish(held):
                        yield out
                    held, chars = held[-1:], len(held[-1][3])
        if out := finish(held):
            yield out

    return dealt.mapInArrow(compare, f"{key} bigint, {EDITED}")
