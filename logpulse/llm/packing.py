"""Best-fit packing: documents into sequences of a fixed number of tokens by best-two-fit.

A bin is filled greedily, with the longest piece that fits, again and again; then its shortest piece
is replaced by the two unpacked ones that fill the gap best, if they fill it better. Which bins come
out depends on nothing but the number of pieces of each length. So the bins are found from those
numbers, at most `limit` of them however many documents there are, as kinds of bins with a number of
times; and each piece finds its place from its length and its number among the pieces of that length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from logpulse.llm.common import add_columns, quoted, stored
from logpulse.llm.encoders import ByteLevelEncoder

PIECE = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint,task:int,number:bigint>>"


def best_pair(sizes: list[int], left, room: int, above: int) -> tuple[int, int] | None:
    """Two sizes of which pieces are left, their sum at most `room`, more than `above`, and greatest."""
    best, found = above, None
    low, high = 0, bisect_right(sizes, room) - 1
    while low <= high:
        a, b = sizes[low], sizes[high]
        if a + b > room or left(b) == 0:
            high -= 1
        elif left(a) == 0 or (low == high and left(a) < 2):
            low += 1
        else:
            if a + b > best:
                best, found = a + b, (b, a)
            low += 1
    return found


def best_two_fit(counts: dict[int, int], limit: int) -> Iterator[tuple[dict[int, int], int]]:
    """Kinds of bins, as pieces of each length, and how many bins in a row are of that kind.

    The next bin is like the last as long as the pieces for it are there, so a kind is used until a
    length runs short. A length runs short at most 1 + limit / length times, which bounds the kinds
    by the limit alone. The bins are those of the same method applied bin by bin.
    """
    counts = {n: c for n, c in counts.items() if c > 0}
    sizes = sorted(counts)
    while sizes:
        used: Counter[int] = Counter()
        gap, at = limit, len(sizes) - 1
        while at >= 0 and gap > 0:
            at = min(at, bisect_right(sizes, gap) - 1)
            if at < 0:
                break
            n = sizes[at]
            taken = min(gap // n, counts[n])
            used[n] += taken
            gap -= taken * n
            at -= 1
        shortest, needed = min(used), Counter(used)
        if gap > 0 and used.total() > 1:
            used[shortest] -= 1
            pair = best_pair(sizes, lambda n: counts[n] - used[n], gap + shortest, shortest)
            for n in pair or (shortest,):
                used[n] += 1
        kind, needed = {n: c for n, c in used.items() if c > 0}, needed | used
        times = min((counts[n] - needed[n]) // c + 1 for n, c in kind.items())
        yield kind, times
        for n, c in kind.items():
            counts[n] -= c * times
            if counts[n] == 0:
                del counts[n]
                sizes.remove(n)


class Places:
    """Where the pieces of each length go: runs of their numbers, each with a kind of bin."""

    def __init__(self, counts: dict[int, int], limit: int):
        self.bins, given = 0, Counter()
        rows = []
        for kind, times in best_two_fit(counts, limit):
            offset = 0
            for n in sorted(kind, reverse=True):
                rows.append((n, given[n], kind[n], self.bins, offset))
                given[n] += kind[n] * times
                offset += n * kind[n]
            self.bins += times
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.length, self.first, self.each, self.bin, self.offset = table.T.copy()

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of the pieces of these lengths with these numbers."""
        at = np.empty(len(length), np.int64)
        for n in np.unique(length):
            own = length == n
            low, high = np.searchsorted(self.length, [n, n + 1])
            at[own] = low + np.searchsorted(self.first[low:high], number[own], "right") - 1
        past = number - self.first[at]
        return self.bin[at] + past // self.each[at], self.offset[at] + past % self.each[at] * length


def pieces(df: DataFrame, tokenizer_json: str, *, limit: int, end: int, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds `pieces`, the cut documents: place, length and checksum of each piece, and its number among
    those of its length in the task that made it."""

    def make():
        encoder, context = ByteLevelEncoder(tokenizer_json), TaskContext.get()
        task, numbers = context.partitionId() if context else 0, Counter()

        def cut(text: str) -> list[tuple]:
            ids = np.array([*encoder.ids(text), end], "<u4")
            first = len(ids) % limit or limit
            out = []
            for k, start in enumerate([0, *range(first, len(ids), limit)]):
                part = ids[start : start + limit] if k else ids[:first]
                n = len(part)
                out.append((k, start, n, zlib.crc32(part), task, numbers[n]))
                numbers[n] += 1
            return out

        def work(texts: list[str]) -> list:
            cuts = [cut(t) for t in texts]
            ends = np.cumsum([0, *map(len, cuts)], dtype=np.int32)
            columns = np.array([p for c in cuts for p in c], np.int64).reshape(-1, 6).T
            kinds = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("task", pa.int32()), ("number", pa.int64())]
            flat = pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], [n for n, _ in kinds])
            return [pa.ListArray.from_arrays(pa.array(ends), flat)]

        return work

    return add_columns(df, make, f"pieces {PIECE}", text=text, keep=keep)


def pack(df: DataFrame, tokenizer_json: str, *, limit: int = 1024, end: int, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row for each piece of a document: the kept columns, `piece`, `start`, `length`, `ids_crc32`,
    and its place, `sequence_id` and `offset`. A document is its ids and then `end`.

    Documents of more than `limit` ids are cut into pieces of `limit`, of which only the first may be
    shorter. A null or empty text is one piece of one id. Sequences are numbered from 0, each is filled
    without gaps from offset 0. Repeated rows are packed one by one. An output column replaces an input
    column of the same name.

    Scale: one scan encodes and stores the pieces (not their ids). Pieces are numbered within each
    length by their number in a task plus those of earlier tasks, so no task sees all pieces of a
    length, however common. The driver is given one count for each length, at most `limit`.
    """
    out_names = ("piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    kept = [c for c in df.columns if c.lower() not in out_names and (keep is None or c in keep)]
    row = df.select(F.struct(*map(F.col, map(quoted, kept))).alias("row") if kept else F.lit(0).alias("row"), F.col(quoted(text)).alias("text"))
    cut = stored(pieces(row, tokenizer_json, limit=limit, end=end, keep=["row"]).select("row", F.explode("pieces").alias("p")).select("row", "p.*"), "pieces")
    held = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    earlier = held.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    places = Places({r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}, limit)
    numbered = cut.join(earlier, ["task", "length"]).select("row", "piece", "start", "length", "ids_crc32", (F.col("number") + F.col("earlier")).alias("number"))
    schema = T.StructType([*(f for f in numbered.schema if f.name != "number"), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    arrow = to_arrow_schema(schema)

    def place(batches):
        for batch in batches:
            found = places.find(*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number")))
            own = [batch.column(n) for n in arrow.names[:-2]]
            yield pa.RecordBatch.from_arrays([*(c.cast(arrow.field(i).type) if c.type != arrow.field(i).type else c for i, c in enumerate(own)), *map(pa.array, found)], schema=arrow)

    placed = numbered.mapInArrow(place, schema)
    return placed.select(*([F.col(f"row.{quoted(c)}") for c in kept]), *out_names)
