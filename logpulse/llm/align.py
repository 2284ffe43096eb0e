"""Cross-tokenizer alignment: which ids of two tokenizers stand for the same bytes, over a corpus.

Tokens of two tokenizers are linked where their byte ranges in a text overlap. Counting the links of
each pair of ids over a corpus is done by external counting. Pair-document records are sorted and
spilled as zstd runs, one for each radix partition of the B id. A partition merges the heads of its runs
(pairs, and how many links of a run each has) through a heap, B id by B id; when a B id is through, its
pairs' counts and their maximum are known, and each run is given back the counts of its pairs, in its
own order. The block that wrote the runs adds these up for its documents.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from logpulse.llm.common import quoted, slices, stored
from logpulse.llm.encoders import ByteLevelEncoder, PieceEncoder

#: Records of pairs and documents that a task sorts in memory before it spills them.
SPILL_RECORDS = 1_500_000

#: Documents in a block at most, and characters of text that one partition of pairs stands for.
BLOCK_DOCS = 1 << 20
PART_CHARS = 64 << 20

#: An id takes 21 bits of a record, a document's place in its block 20.
ID_BITS, DOC_BITS = 21, 20
_ID, _DOC = (1 << ID_BITS) - 1, (1 << DOC_BITS) - 1

FACTS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
FOUND = "n_best bigint, count_sum bigint"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers that are not negative, each in its least width, compressed."""
    out = [len(arrays).to_bytes(1, "little")]
    for a in arrays:
        width = next(w for w in (1, 2, 4, 8) if not len(a) or int(a.max()) < 1 << 8 * w)
        raw = np.ascontiguousarray(a, f"<u{width}").view(np.uint8).reshape(-1, width).T
        out += [width.to_bytes(1, "little"), len(a).to_bytes(8, "little"), raw.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(data: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(data), 1, []
    for _ in range(data[0]):
        width, n = data[at], int.from_bytes(data[at + 1 : at + 9], "little")
        raw = np.frombuffer(data, np.uint8, n * width, at + 9).reshape(width, n)
        out.append(np.ascontiguousarray(raw.T).view(f"<u{width}").reshape(n).astype(np.int64))
        at += 9 + n * width
    return out


def first_of_runs(x: np.ndarray) -> np.ndarray:
    """Where a new value begins in a sorted array."""
    return np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)


class Speller:
    """Decimal ids with a sign after each, for many ids at once."""

    def __init__(self, ids: int):
        names = [str(i).encode() for i in range(ids)]
        self.length = np.array([len(x) for x in names], np.int64)
        self.table = np.zeros((ids, int(self.length.max(initial=0)) + 1), np.uint8)
        for i, x in enumerate(names):
            self.table[i, : len(x)] = list(x)

    def spell(self, ids: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All characters, and how many belong to each id; sign 0 is none."""
        out, length = self.table[ids], self.length[ids]
        out[np.arange(len(ids)), length] = signs
        length = length + (signs > 0)
        return out[np.arange(out.shape[1]) < length[:, None]], length


class Aligner:
    """Links between the tokens that two tokenizers make of the same texts."""

    def __init__(self, byte_json: str, piece_model: bytes):
        self.a, self.b = ByteLevelEncoder(byte_json), PieceEncoder(piece_model)
        self.length_a, self.length_b = (np.array([len(x) for x in e.bytes_of], np.int64) for e in (self.a, self.b))
        self.speller = Speller(max(len(self.length_a), len(self.length_b)))

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        out = []
        for text, b in zip(texts, self.b.plain(texts)):
            a, whole = self.a.plain(" " + text) if text else [], (" " + text).encode("utf-8", "replace")
            same = text and all(b"".join(map(e.bytes_of.__getitem__, ids)) == whole for e, ids in ((self.a, a), (self.b, b)))
            out.append((a, b) if same else ([], []))
        return out

    def align(self, texts: list[str]) -> tuple[list, np.ndarray, np.ndarray]:
        """The columns FACTS, and all links as records and their documents' places in `texts`."""
        coded = self.encode(texts)
        n_a, n_b = (np.array([len(x[side]) for x in coded], np.int64) for side in (0, 1))
        a, b = (np.fromiter((i for x in coded for i in x[side]), np.int64, int(n.sum())) for side, n in ((0, n_a), (1, n_b)))
        del coded
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        owner_a, owner_b = (np.repeat(np.arange(len(texts)), n) for n in (n_a, n_b))
        cut_a, cut_b = (x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y if len(x) else np.zeros(0, bool) for x, y in ((end_b, end_a), (end_a, end_b)))
        ends = np.union1d(end_a, end_b)
        at_a, at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        doc = owner_a[at_a]
        n_groups = np.bincount(owner_a[cut_a], minlength=len(texts))
        n_links = np.bincount(doc, minlength=len(texts))
        names = self._groups(a, b, cut_a, cut_b, owner_a, owner_b, len(texts))
        return [n_a, n_b, n_groups, n_links, names], (b[at_b] << ID_BITS) | a[at_a], doc

    def _groups(self, a, b, cut_a, cut_b, owner_a, owner_b, n: int) -> list[str]:
        """The digest of each document's groups."""
        group_a, group_b = (np.cumsum(np.r_[0, x[:-1]]) if len(x) else np.zeros(0, np.int64) for x in (cut_a, cut_b))
        last = np.r_[owner_b[1:] != owner_b[:-1], True] if len(b) else np.zeros(0, bool)
        sign_a = np.where(cut_a, ord("|"), ord(","))
        sign_b = np.where(last, 0, np.where(cut_b, ord(";"), ord(",")))
        order = np.argsort(np.r_[group_a * 2, group_b * 2 + 1], kind="stable")
        flat, length = self.speller.spell(np.r_[a, b][order], np.r_[sign_a, sign_b][order].astype(np.uint8))
        chars = np.bincount(np.r_[owner_a, owner_b][order], length, n).astype(np.int64)
        data, ends = flat.tobytes(), np.cumsum(chars)
        return [hashlib.sha256(data[e - c : e]).hexdigest() if c else "" for e, c in zip(ends.tolist(), chars.tolist())]


class Block:
    """The records of some documents, spilled as one run for each radix partition."""

    def __init__(self, parts: int):
        self.parts, self.keys, self.counts, self.records, self.docs = parts, [], [], 0, 0

    def add(self, pair: np.ndarray, doc: np.ndarray, docs: int) -> None:
        key, n = np.unique((pair << DOC_BITS) | (doc + self.docs), return_counts=True)
        self.keys.append(key)
        self.counts.append(n)
        self.records += len(key)
        self.docs += docs

    def runs(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(partition, heads, documents) of each run; documents of a pair as differences."""
        key, count = np.concatenate(self.keys), np.concatenate(self.counts)
        part = radix(key >> ID_BITS + DOC_BITS, self.parts)
        order = np.lexsort((key, part)) if self.parts > 1 else np.argsort(key)
        key, count, part = key[order], count[order], part[order]
        edges = np.r_[first_of_runs(part), len(part)]
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
            pair, doc, n = key[low:high] >> DOC_BITS, key[low:high] & _DOC, count[low:high]
            first = first_of_runs(pair)
            uses, links = np.diff(np.r_[first, len(pair)]), np.add.reduceat(n, first)
            step = np.diff(doc, prepend=0)
            step[first] = doc[first]
            pair = pair[first]
            b = first_of_runs(pair >> ID_BITS)
            heads = pack((pair >> ID_BITS)[b], np.diff(np.r_[b, len(pair)]), pair & _ID, links)
            yield int(part[low]), heads, pack(uses, step, n)


def radix(b: np.ndarray, parts: int) -> np.ndarray:
    """Partitions of B ids, mixed so that common ids, which lie together, are spread."""
    return ((b.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) % parts


def merge(heads: list[bytes]) -> list[np.ndarray]:
    """The corpus-wide count of each pair of each run, twice that, plus one if it is its B id's highest.

    A heap holds the next B id of every run. All runs that have the least one give their pairs of it.
    """
    runs, heap, at, out = [], [], [], []
    for k, data in enumerate(heads):
        b, size, a, links = unpack(data)
        runs.append((b.tolist(), np.r_[0, np.cumsum(size)].tolist(), a, links))
        out.append(np.zeros(len(a), np.int64))
        at.append(0)
        if len(b):
            heap.append((int(b[0]), k))
    heapq.heapify(heap)
    while heap:
        least, taken = heap[0][0], []
        while heap and heap[0][0] == least:
            k = heap[0][1]
            b, edges, a, links = runs[k]
            i = at[k]
            taken.append((k, edges[i], edges[i + 1]))
            at[k] = i + 1
            if i + 1 < len(b):
                heapq.heapreplace(heap, (b[i + 1], k))
            else:
                heapq.heappop(heap)
        if len(taken) == 1:
            k, low, high = taken[0]
            count = runs[k][3][low:high]
            out[k][low:high] = 2 * count + (count == count.max())
            continue
        ids, inverse = np.unique(np.concatenate([runs[k][2][low:high] for k, low, high in taken]), return_inverse=True)
        count = np.bincount(inverse, np.concatenate([runs[k][3][low:high] for k, low, high in taken]), len(ids)).astype(np.int64)
        answer, done = (2 * count + (count == count.max()))[inverse], 0
        for k, low, high in taken:
            out[k][low:high] = answer[done : done + high - low]
            done += high - low
    return out


def contributions(runs: dict[int, bytes], answers: dict[int, bytes], docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of the highest count, and the sum of counts, of each document of a block."""
    best, total = np.zeros(docs, np.int64), np.zeros(docs, np.int64)
    for part, data in runs.items():
        uses, step, n = unpack(data)
        (answer,) = unpack(answers[part])
        first = np.cumsum(uses) - uses
        run = np.cumsum(step)
        doc = run - np.repeat(run[first] - step[first], uses)
        answer = np.repeat(answer, uses)
        np.add.at(best, doc, n * (answer & 1))
        np.add.at(total, doc, n * (answer >> 1))
    return best, total


def align(df: DataFrame, byte_json: str, piece_model: bytes, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds the columns FACTS and FOUND to the kept ones.

    A is a byte-level tokenizer file, B a SentencePiece model; A encodes a space and the text, B adds
    that space itself; strings of special tokens are plain text to both. A text that is null, empty, or
    changed by a tokenizer (the joined bytes of its tokens are not those of space and text) has no
    tokens: zeros and an empty digest. Links and groups are counted in each text: groups end where
    tokens of both end, `groups_sha256` digests them as `a1,a2|b1;a3|b2`. The count of a pair of ids is
    the number of its links in all rows, repeated ones too; `n_best` are links whose count is the highest
    of their B id, ties included, `count_sum` adds up the counts of all links.

    Scale: texts are encoded once; blocks with their runs are a stored table. The heads of runs are
    shuffled by partition, answers and blocks by block. A partition holds the distinct pairs of each
    block, so a common id weighs as much as it has partners in each block, not as it has uses. There is a
    partition for each PART_CHARS of text, at most one for each B id.
    """
    added = T.StructType.fromDDL(f"{FACTS}, {FOUND}")
    taken = {f.name.lower() for f in added}
    kept = T.StructType([f for f in df.schema if f.name.lower() not in taken and (keep is None or f.name in keep)])
    spark = df.sparkSession
    chars = df.agg(F.sum(F.length(F.col(quoted(text)).cast("string")))).first()[0] or 0
    parts = int(min(1 << 15, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // PART_CHARS))))
    names = kept.names
    facts = T.StructType.fromDDL(FACTS)
    doc = T.StructType([T.StructField("row", kept), *facts]) if names else facts
    schema = T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("docs", T.ArrayType(doc)), *T.StructType.fromDDL("runs array<struct<part:int,heads:binary>>, uses array<struct<part:int,docs:binary>>")]
    )
    arrow = to_arrow_schema(schema)

    def cut(batches):
        aligner, context = Aligner(byte_json, piece_model), TaskContext.get()
        first = (context.partitionId() if context else 0) << 32
        block, held = Block(parts), []

        def spill() -> pa.RecordBatch:
            nonlocal block, held, first
            runs = list(block.runs())
            rows = pa.concat_arrays(held).cast(arrow.field("docs").type.value_type)
            lists = [
                pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
                pa.array([[{"part": p, "heads": h} for p, h, _ in runs]], arrow.field("runs").type),
                pa.array([[{"part": p, "docs": d} for p, _, d in runs]], arrow.field("uses").type),
            ]
            out = pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), *(x.cast(arrow.field(i + 1).type) for i, x in enumerate(lists))], schema=arrow)
            block, held, first = Block(parts), [], first + 1
            return out

        for batch, texts in slices(batches, "text"):
            for at in range(0, len(texts), BLOCK_DOCS):
                part, some = batch.slice(at, BLOCK_DOCS), texts[at : at + BLOCK_DOCS]
                if held and block.docs + len(some) > BLOCK_DOCS:
                    yield spill()
                columns, pair, owner = aligner.align(some)
                block.add(pair, owner, len(some))
                values = [pa.array(c, to_arrow_schema(facts).field(i).type) for i, c in enumerate(columns)]
                if names:
                    values.insert(0, part.column("row"))
                held.append(pa.StructArray.from_arrays(values, doc.names))
                if block.records >= SPILL_RECORDS:
                    yield spill()
        if held:
            yield spill()

    row = F.struct(*map(F.col, map(quoted, names))) if names else F.lit(None)
    texts = df.select(row.alias("row"), F.col(quoted(text)).cast("string").alias("text"))
    blocks = stored(texts.mapInArrow(cut, schema), "aligned")

    def answer(batches):
        part, held = None, []
        for batch in batches:
            for p, block, heads in zip(*(batch.column(c).to_pylist() for c in ("part", "block", "heads"))):
                if p != part and held:
                    yield from answers(part, held)
                    held = []
                part = p
                held.append((block, heads))
        if held:
            yield from answers(part, held)

    def answers(part: int, held: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        for (block, _), found in zip(held, merge([h for _, h in held])):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([part], pa.int32()), pa.array([pack(found)], pa.binary())], ["block", "part", "counts"])

    heads = blocks.select("block", F.explode("runs").alias("run")).select("block", "run.*")
    counted = heads.repartition(parts, "part").sortWithinPartitions("part", "block").mapInArrow(answer, "block bigint, part int, counts binary")
    found = counted.groupBy("block").agg(F.collect_list(F.struct("part", "counts")).alias("found"))
    whole = blocks.select("block", "docs", "uses").join(found, "block", "left")
    out_schema = T.StructType([*schema["docs"].dataType.elementType, *T.StructType.fromDDL(FOUND)])
    out_arrow = to_arrow_schema(out_schema)

    def add_up(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                docs = batch.column("docs").slice(k, 1).flatten()
                runs, answered = ({x["part"]: x[c] for x in batch.column(n)[k].as_py() or []} for n, c in (("uses", "docs"), ("found", "counts")))
                sums = map(pa.array, contributions(runs, answered, len(docs)))
                yield pa.RecordBatch.from_arrays([*(c.cast(out_arrow.field(i).type) for i, c in enumerate(docs.flatten())), *sums], schema=out_arrow)

    out = whole.mapInArrow(add_up, out_schema)
    return out.select(*(F.col(f"row.{quoted(n)}") for n in names), *added.names)
