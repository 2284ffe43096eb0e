"""Ranked lexical search: an Aho-Corasick automaton of all items' terms reads the documents.

Terms are runs of ASCII letters and digits and of characters beyond ASCII, A-Z in lower case. A text
becomes its UTF-8 bytes with every other byte a space, one character each; the automaton holds each
term between two spaces, so that it finds whole terms alone, neighbours sharing the space. No index
of documents is made: term counts come directly from the texts.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logpulse.llm.common import add_columns, quoted, stored

#: Text of items that one pass over the documents looks for; more items take more passes.
PASS_BYTES = 16 << 20

#: Cells of documents x items that are added up at a time.
CELLS = 1 << 21

_KEEP = frozenset(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | frozenset(range(128, 256))
TERM_BYTES = bytes(ord(chr(b).lower()) if b < 128 and b in _KEEP else b if b in _KEEP else 32 for b in range(256))


def spaced(text: str) -> bytes:
    """The terms of a text in UTF-8, other characters as spaces."""
    return text.encode("utf-8", "replace").translate(TERM_BYTES)


class TermScanner:
    """Counts of given terms, and of all terms, in texts."""

    def __init__(self, terms: Iterable[bytes]):
        self.automaton = ahocorasick.Automaton()
        for i, term in enumerate(terms):
            self.automaton.add_word(f" {term.decode('latin-1')} ", i)
        if len(self.automaton):
            self.automaton.make_automaton()

    def scan(self, text: str) -> tuple[int, dict[int, int]]:
        """Terms of the text with repeats, and the uses of each given term that it holds."""
        plain = b" " + spaced(text) + b" "
        n = len(plain.split())
        if not n or not len(self.automaton):
            return n, {}
        return n, Counter(map(itemgetter(1), self.automaton.iter(plain.decode("latin-1"))))


class Items:
    """Items as their terms: which items hold each term."""

    def __init__(self, rows: Iterable[tuple[int | None, str | None]]):
        terms: dict[int | None, set[bytes]] = {}
        for item, text in rows:
            terms.setdefault(item, set()).update(spaced(text or "").split())
        self.ids = sorted(terms, key=lambda x: (x is None, x or 0))
        self.terms = sorted(set().union(*terms.values()))
        number = {t: i for i, t in enumerate(self.terms)}
        pairs = np.array(sorted((number[t], k) for k, i in enumerate(self.ids) for t in terms[i]), np.int64).reshape(-1, 2)
        self.start = np.searchsorted(pairs[:, 0], np.arange(len(self.terms) + 1))
        self.holders = pairs[:, 1].astype(np.int32)


def weights(df: dict[int, int], terms: int, documents: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2df + 1))) of each term."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df.get(t, 0) + 1))) for t in range(terms)], np.int64)


class Best:
    """The best `k` documents of each item so far: highest score, then smallest id, null ids last."""

    def __init__(self, items: int, k: int):
        self.k, self.heaps, self.floor = k, [[] for _ in range(items)], np.zeros(items, np.int64)

    def offer(self, scores: np.ndarray, ids: list[int | None]) -> None:
        """`scores`: a row for each document, a column for each item."""
        at, items = np.nonzero((scores >= self.floor) & (scores > 0))
        for d, i, score in zip(at.tolist(), items.tolist(), scores[at, items].tolist()):
            heap, entry = self.heaps[i], (score, ids[d] is not None, -(ids[d] or 0))
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            else:
                continue
            if len(heap) == self.k:
                self.floor[i] = heap[0][0]

    def rows(self) -> Iterator[tuple[int, int | None, int]]:
        for i, heap in enumerate(self.heaps):
            for score, known, negative in heap:
                yield i, -negative if known else None, score


class Scorer:
    """Scores of documents for all items."""

    def __init__(self, items: Items, weight: np.ndarray, documents: int, length: int):
        self.items, self.weight, self.documents, self.length = items, weight, documents, length

    def scores(self, n: np.ndarray, term: np.ndarray, tf: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
        """64-bit sums. Term counts come as (term, tf) of the document `owner`, of `rows` documents with
        `n` terms. High and low bits are added up apart, so that the sums are exact in doubles."""
        m = np.array([50 + (50 * x * self.documents) // self.length for x in n.tolist()], np.int64)
        value = self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[owner]))
        start = self.items.start[term]
        each = self.items.start[term + 1] - start
        within = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        holder = self.items.holders[np.repeat(start, each) + within]
        width = len(self.items.ids)
        cell = np.repeat(owner, each) * width + holder
        high, low = (np.bincount(cell, np.repeat(x, each), rows * width).astype(np.int64) for x in (value >> 18, value & 0x3FFFF))
        return ((high << 18) + low).reshape(rows, width)


def _best_of(counts: DataFrame, items: Items, weight: np.ndarray, documents: int, length: int, k: int) -> DataFrame:
    def score(batches):
        scorer, best = Scorer(items, weight, documents, length), Best(len(items.ids), k)
        step = max(1, CELLS // max(1, len(items.ids)))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                lists = part.column("term")
                owner = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
                flat = [part.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("term", "tf")]
                found = scorer.scores(part.column("n").to_numpy(), *flat, owner, part.num_rows)
                best.offer(found, part.column("doc").to_pylist())
        rows = list(best.rows())
        for at in range(0, len(rows), 1 << 16):
            item, doc, points = zip(*rows[at : at + (1 << 16)])
            yield pa.RecordBatch.from_arrays([pa.array([items.ids[i] for i in item], pa.int64()), pa.array(doc, pa.int64()), pa.array(points, pa.int64())], ["item_id", "doc_id", "score"])

    return counts.mapInArrow(score, "item_id bigint, doc_id bigint, score bigint")


def search(df: DataFrame, benchmark: DataFrame, *, k: int = 50, doc: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The `k` highest-scoring documents of each item: `item_id`, `rank`, `doc_id`, `score` (over 0).

    With N documents that hold a term, L terms in them all, n in one document, and m = 50 + (50 n N) div L,
    an item's score is the sum over its distinct terms of w * ((10^9 tf) div (1000 tf + 20 m)), where
    w = floor(1000 ln((2N + 2) / (2df + 1))). Equal scores rank by doc_id, null ids last. Null and empty
    texts hold no term; each row is a document by itself, also a repeated one. Items with equal ids are
    one item, null being an id too; an item without terms, or an empty table, gives no row.

    Scale: items are a query set, read in passes of at most PASS_BYTES of their text, which bounds the
    automaton and what is sent to the tasks; each pass reads the documents once and stores the counts of
    found terms. A task keeps `k` documents of an item, so `k` rows of each task and item are shuffled.
    """
    wanted = benchmark.select(F.col(quoted(item)).cast("long").alias("id"), F.col(quoted(item_text)).cast("string").alias("item"))
    passes = max(1, math.ceil((wanted.agg(F.sum(F.octet_length("item"))).first()[0] or 0) / PASS_BYTES))
    docs = df.select(F.col(quoted(doc)).cast("long").alias("doc"), F.col(quoted(text)).cast("string").alias("text"))
    found = None
    for p in range(passes):
        part = _one_pass(docs, Items((r["id"], r["item"]) for r in wanted.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == p).collect()), k)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _one_pass(docs: DataFrame, items: Items, k: int) -> DataFrame:
    def make():
        scanner = TermScanner(items.terms)

        def work(texts: list[str]) -> list:
            n, counts = zip(*map(scanner.scan, texts))
            ends = pa.array(np.cumsum([0, *map(len, counts)], dtype=np.int32))
            term = pa.array([t for c in counts for t in c], pa.int32())
            tf = pa.array([u for c in counts for u in c.values()], pa.int32())
            return [pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, term), pa.ListArray.from_arrays(ends, tf)]

        return work

    fields = T.StructType.fromDDL("n bigint, term array<int>, tf array<int>")
    counts = stored(add_columns(docs, make, fields, keep=["doc"]), "term-counts")
    total = counts.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    df = {r["term"]: r["df"] for r in counts.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()}
    weight = weights(df, len(items.terms), total["documents"])
    return _best_of(counts.where(F.size("term") > 0), items, weight, total["documents"], total["length"], k)
