"""Katz backoff language model: Good-Turing discounted counts, exactly normalised backoff weights.

P(w | h) is the discounted relative count of the pair h w where training texts have it, and else the
backoff weight of h times P(w); P(w) is the discounted relative count of w, or the mass that
discounting leaves, which belongs to all unknown words together. Words are lower-cased in A-Z; a text
ends with an end token and its first word follows a begin mark.

Counts never meet in one place. Documents are packed into blocks of token numbers, stored in a table
bucketed by block. Each block asks the word partitions (by hash of the word) for counts and numbers
of its distinct words, and then the pair partitions (by number of h) for its distinct pairs. A
partition adds up what all blocks have, is stored, and answers each block; asked and answered are
packed arrays, one row for each block and partition. The pairs of a history that is used more than
SPLIT_USES times are dealt by word over several partitions; what a pair partition knows of each history is
a partial sum, and the word partitions add these up and tell each block about its words as histories.
Blocks then evaluate their own tokens. The number of partitions grows with the tokens.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logpulse.llm.common import shared_folder, stored

#: Characters of text that a block holds (one longer text is a block of its own).
BLOCK_CHARS = 4 << 20
#: Counts up to this are discounted.
DISCOUNTED = 5
#: Stands for the end token among word hashes; as a history it is the begin mark, as nothing follows an end.
END = 1
#: Uses of a history, about, whose pairs meet in one partition, and tokens of all texts for each partition.
SPLIT_USES, PART_TOKENS = 1 << 17, 1 << 22


def pack(values: np.ndarray) -> bytes:
    """Compressed bytes of an array, all first bytes of its values first."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).reshape(-1)


def pack_rising(values: np.ndarray) -> bytes:
    """Of values that mostly rise: differences, which wrap around where they fall."""
    return pack(np.diff(values.astype(np.uint64), prepend=np.uint64(0)))


def unpack_rising(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def discounts(of_counts: list[int]) -> np.ndarray:
    """Factors of counts 0 to DISCOUNTED, from how many words (or pairs) have counts 1 to DISCOUNTED + 1.

    Katz's form of Good-Turing discounting; a factor outside (0, 1], as of scarce counts, becomes 1.
    """
    out, k = np.ones(DISCOUNTED + 1), DISCOUNTED
    n = [0, *of_counts]
    if n[1] and (k + 1) * n[k + 1] < n[1]:
        common = (k + 1) * n[k + 1] / n[1]
        for c in range(1, k + 1):
            if n[c]:
                d = ((c + 1) * n[c + 1] / (c * n[c]) - common) / (1 - common)
                out[c] = d if 0 < d <= 1 else 1.0
    return out


class Words:
    """P(w) from a word's count."""

    def __init__(self, tokens: int, types: int, of_counts: list[int]):
        self.tokens, self.types, self.factors = tokens, types, discounts(of_counts)
        lost = sum((1 - self.factors[c]) * c * of_counts[c - 1] for c in range(1, DISCOUNTED + 1))
        self.total = tokens if lost > 0 else tokens + 1
        self.unknown = lost / tokens if lost > 0 else 1 / self.total

    def probability(self, count: np.ndarray) -> np.ndarray:
        low = np.minimum(count, DISCOUNTED)
        factor = np.where(count <= DISCOUNTED, self.factors[low], 1.0)
        return np.where(count > 0, factor * count / self.total, self.unknown)

    def base(self, count: np.ndarray) -> np.ndarray:
        """log10 of the add-one estimate."""
        return np.log10((count + 1) / (self.tokens + self.types + 1))


class Histories:
    """P(w | h) from the counts of pair, history and word."""

    def __init__(self, words: Words, of_counts: list[int]):
        self.words, self.factors = words, discounts(of_counts)

    def probability(self, pair: np.ndarray, word: np.ndarray, total: np.ndarray, low: np.ndarray, unseen: np.ndarray) -> np.ndarray:
        """Of pairs; for their histories: `total` count, `low` (n, DISCOUNTED) pairs with counts 1 and up,
        and `unseen`, what the words that never follow have of P(w)."""
        c = np.arange(1, DISCOUNTED + 1)
        lost = low @ ((1 - self.factors[1:]) * c)
        all_of = np.where(lost > 0, total, total + 1).astype(float)
        mass = np.where(lost > 0, lost, 1.0) / all_of
        factor = np.where(pair <= DISCOUNTED, self.factors[np.minimum(pair, DISCOUNTED)], 1.0)
        own = self.words.probability(word)
        weight = np.where(total > 0, mass / unseen, 1.0)
        return np.where(pair > 0, factor * pair / all_of, weight * own)


def _blocks(batches) -> Iterator[pa.RecordBatch]:
    """Documents packed: token numbers within the block, hashes of its words, their training counts."""
    task, made = TaskContext.get().partitionId(), 0
    ids, held, sizes, numbers, known, chars = [], [], [], [], {}, 0

    def flush() -> pa.RecordBatch:
        nonlocal made
        words = np.array([END, *(xxhash.xxh64_intdigest(w) | 2 for w in list(known)[1:])], np.uint64)
        sequence = np.concatenate(numbers).astype(np.uint32)
        trained = np.repeat(~np.array(held), sizes)
        counts, uses = (np.bincount(x, minlength=len(words)).astype(np.uint32) for x in (sequence[trained], sequence))
        row = {"block": (task << 24) + made, "ids": list(ids), "held": list(held), "sizes": list(sizes), "sequence": pack(sequence), "words": pack(words), "counts": pack(counts), "uses": pack(uses)}
        made += 1
        return pa.RecordBatch.from_pylist([row], schema=_BLOCK)

    for batch in batches:
        for i, h, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
            text = text or ""
            if ids and chars + len(text) > BLOCK_CHARS:
                yield flush()
                ids, held, sizes, numbers, known, chars = [], [], [], [], {}, 0
            if not known:
                known[None] = 0  # the end token; no word is None
            own = [known.setdefault(w, len(known)) for w in text.encode("utf-8", "replace").lower().split()]
            own.append(0)
            ids.append(i)
            held.append(bool(h))
            sizes.append(len(own))
            numbers.append(np.array(own, np.uint32))
            chars += len(text)
    if ids:
        yield flush()


_BLOCK = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())), ("sequence", pa.binary()), ("words", pa.binary()), ("counts", pa.binary()), ("uses", pa.binary())])
_BLOCK_DDL = "block long, ids array<long>, held array<boolean>, sizes array<int>, sequence binary, words binary, counts binary, uses binary"


def _split(part: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal values in a sorted array."""
    cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, int)
    for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(part)]):
        yield int(part[s]), slice(s, e)


def _frame(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


_ASKED = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("d", pa.binary()), ("e", pa.binary())])
_ASKED_DDL = "part int, block long, a binary, b binary, c binary, d binary, e binary"
_ANSWER_DDL = "block long, part int, a binary, b binary, c binary, stats array<long>"
_ANSWER = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("stats", pa.list_(pa.int64()))])


def _word_order(words: np.ndarray, parts: int) -> np.ndarray:
    """A block's words by partition and hash: the order of what it asks and is answered."""
    return np.lexsort((words, words % np.uint64(parts)))


def _ask_words(batches, parts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, words, counts, uses in zip(*(batch.column(c).to_pylist() for c in ("block", "words", "counts", "uses"))):
            words, counts, uses = unpack(words, np.uint64), unpack(counts, np.uint32), unpack(uses, np.uint32)
            order = _word_order(words, parts)
            words, counts, uses = words[order], counts[order], uses[order]
            yield _frame([{"part": p, "block": block, "a": pack_rising(words[s]), "b": pack(counts[s]), "c": pack(uses[s])} for p, s in _split(words % np.uint64(parts))], _ASKED)


def _groups(batches) -> Iterator[tuple[int, list[dict]]]:
    """Rows of a partition together, from rows sorted by partition."""
    own, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != own and rows:
                yield own, rows
                rows = []
            own = row["part"]
            rows.append(row)
    if rows:
        yield own, rows


def _of_counts(total: np.ndarray) -> list[int]:
    return np.bincount(total[(total > 0) & (total <= DISCOUNTED + 1)], minlength=DISCOUNTED + 2)[1:].tolist()


def _answer_words(batches, parts: int, split_uses: int) -> Iterator[pa.RecordBatch]:
    """For each block its words' numbers, counts and, as histories, bits of the number of partitions that
    their pairs are dealt over; numbers rise as counts fall. One row of statistics."""
    for part, rows in _groups(batches):
        asked = [unpack_rising(r["a"]) for r in rows]
        words, place = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(place, np.concatenate([unpack(r["b"], np.uint32) for r in rows])).astype(np.int64)
        uses = np.bincount(place, np.concatenate([unpack(r["c"], np.uint32) for r in rows]))
        bits = np.ceil(np.log2(np.maximum(uses / split_uses, 1))).astype(np.uint8)
        rank = np.empty(len(words), np.int64)
        rank[np.argsort(-total, kind="stable")] = np.arange(len(words))
        number = (rank * parts + part + 1).astype(np.uint64)
        ends = np.cumsum([0, *map(len, asked)])
        for r, s, e in zip(rows, ends, ends[1:]):
            own = place[s:e]
            yield _frame([{"block": r["block"], "part": part, "a": pack(number[own]), "b": pack(total[own]), "c": pack(bits[own])}], _ANSWER)
        yield _frame([{"part": part, "a": pack_rising(words), "b": pack(number), "c": pack(total), "stats": [int(total.sum()), int((total > 0).sum()), *_of_counts(total)]}], _ANSWER)


def _joined(parts: list, column: str, dtype) -> np.ndarray:
    """What all partitions answered, in the order of partitions."""
    return np.concatenate([unpack(bytes(x[column]), dtype) for x in sorted(parts, key=lambda x: x["part"])])


class Block:
    """A block's tokens as pairs (history, word) of numbers, each distinct pair once, by number."""

    def __init__(self, row: dict, parts: int):
        words = unpack(row["words"], np.uint64)
        order = _word_order(words, parts)
        number, count, bits = np.empty(len(words), np.uint64), np.zeros(len(words), np.int64), np.zeros(len(words), np.uint8)
        for values, column in ((number, "a"), (count, "b"), (bits, "c")):
            values[order] = _joined(row["of_words"], column, values.dtype)
        sizes = np.array(row["sizes"], np.int64)
        sequence = unpack(row["sequence"], np.uint32).astype(np.int64)
        before = np.empty_like(sequence)
        before[1:] = sequence[:-1]
        before[np.cumsum(sizes) - sizes] = 0  # the end token's place, which as a history is the begin mark
        by_number = np.argsort(number, kind="stable")
        rank = np.empty(len(number), np.int64)
        rank[by_number] = np.arange(len(number))
        key, self.pair = np.unique(rank[before] * len(number) + rank[sequence], return_inverse=True)
        self.history_place, word = by_number[key // len(number)], by_number[key % len(number)]
        self.history, self.word, self.word_count = number[self.history_place], number[word], count[word]
        self.sizes, self.held, self.token_count, self.word_order = sizes, np.array(row["held"], bool), count[sequence], order
        part = pair_parts(self.history, self.word, bits[self.history_place], parts)
        self.order = np.argsort(part, kind="stable")
        self.part = part[self.order]


def pair_parts(history: np.ndarray, word: np.ndarray, bits: np.ndarray, parts: int) -> np.ndarray:
    """Partitions of pairs: that of the history and, of a frequent history, those after it, by word."""
    with np.errstate(over="ignore"):
        mixed = (word * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    salt = mixed & ((np.uint64(1) << bits.astype(np.uint64)) - np.uint64(1))
    return ((history + salt) % np.uint64(parts)).astype(np.int64)


def _ask_pairs(batches, parts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            b = Block(row, parts)
            trained = np.repeat(~b.held, b.sizes)
            count = np.bincount(b.pair[trained], minlength=len(b.history)).astype(np.uint32)
            rows = []
            for p, s in _split(b.part):
                own = b.order[s]
                h = b.history[own]
                start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
                size = np.diff(np.append(start, len(h))).astype(np.uint32)
                rows.append({"part": p, "block": row["block"], "a": pack_rising(h[start]), "b": pack(size), "c": pack_rising(b.word[own]), "d": pack(b.word_count[own].astype(np.uint64)), "e": pack(count[own])})
            yield _frame(rows, _ASKED)


def _answer_pairs(batches, words: Words, parts: int) -> Iterator[pa.RecordBatch]:
    """For each block its pairs' counts; for word partitions what is known here of their words as histories:
    total and low counts, and P(w) of the words seen. One row of statistics."""
    for part, rows in _groups(batches):
        heads, sizes = [unpack_rising(r["a"]) for r in rows], [unpack(r["b"], np.uint32) for r in rows]
        histories, head_place = np.unique(np.concatenate(heads), return_inverse=True)
        history = np.repeat(head_place, np.concatenate(sizes))
        word, word_place = np.unique(np.concatenate([unpack_rising(r["c"]) for r in rows]), return_inverse=True)
        key, place = np.unique(history.astype(np.int64) * len(word) + word_place, return_inverse=True)
        word_count = np.empty(len(key), np.int64)
        word_count[place] = np.concatenate([unpack(r["d"], np.uint64) for r in rows]).astype(np.int64)
        total = np.bincount(place, np.concatenate([unpack(r["e"], np.uint32) for r in rows]), len(key)).astype(np.int64)
        of, n, seen = key // len(word), len(histories), total > 0
        facts = np.zeros((n, DISCOUNTED + 1), np.int64)
        facts[:, 0] = np.bincount(of, total, n)
        for c in range(1, DISCOUNTED + 1):
            facts[:, c] = np.bincount(of[total == c], minlength=n)
        mass = np.bincount(of[seen], words.probability(word_count[seen]), n)
        pair_end = np.cumsum([0, *(int(s.sum()) for s in sizes)])
        for k, r in enumerate(rows):
            yield _frame([{"block": r["block"], "part": part, "a": pack(total[place[pair_end[k] : pair_end[k + 1]]])}], _ANSWER)
        to = ((histories - np.uint64(1)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        for p, s in _split(to[order]):
            own = order[s]
            yield _frame([{"part": p, "a": pack(histories[own]), "b": pack(facts[own].T.reshape(-1)), "c": pack(mass[own])}], _ANSWER)
        yield _frame([{"part": part, "stats": _of_counts(total)}], _ANSWER)


def _answer_histories(batches) -> Iterator[pa.RecordBatch]:
    """For each block what is known of its words as histories, from partial sums (rows without a block)."""
    for part, rows in _groups(batches):
        partial, asked = [r for r in rows if r["block"] is None], [r for r in rows if r["block"] is not None]
        known = [unpack(r["a"], np.uint64) for r in partial]
        number, place = np.unique(np.concatenate([*known, np.zeros(0, np.uint64)]), return_inverse=True)
        facts, mass = np.zeros((len(number) + 1, DISCOUNTED + 1), np.int64), np.zeros(len(number) + 1)
        ends = np.cumsum([0, *map(len, known)])
        for r, s, e in zip(partial, ends, ends[1:]):
            facts[place[s:e]] += unpack(r["b"], np.int64).reshape(DISCOUNTED + 1, -1).T
            mass[place[s:e]] += unpack(r["c"], np.float64)
        for r in asked:
            own = unpack(r["a"], np.uint64)
            at = np.searchsorted(number, own)
            at[np.append(number, np.uint64(0))[at] != own] = len(number)  # followed by nothing
            yield _frame([{"block": r["block"], "part": part, "b": pack(facts[at].T.reshape(-1)), "c": pack(1 - mass[at])}], _ANSWER)


def _evaluate(batches, parts: int, words: Words, histories: Histories) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            b = Block(row, parts)
            n = len(b.history)
            pair = np.empty(n, np.int64)
            answers = {x["part"]: x for x in row["of_pairs"]}
            for p, s in _split(b.part):
                pair[b.order[s]] = unpack(bytes(answers[p]["a"]), np.int64)
            told = sorted(row["of_histories"], key=lambda x: x["part"])
            facts, unseen = np.empty((len(b.word_order), DISCOUNTED + 1), np.int64), np.empty(len(b.word_order))
            facts[b.word_order] = np.concatenate([unpack(bytes(x["b"]), np.int64).reshape(DISCOUNTED + 1, -1).T for x in told])
            unseen[b.word_order] = _joined(told, "c", np.float64)
            total, low, unseen = facts[b.history_place, 0], facts[b.history_place, 1:], unseen[b.history_place]
            logs = np.log10(histories.probability(pair, b.word_count, total, low, unseen))
            starts = np.cumsum(b.sizes) - b.sizes
            of_docs = [np.add.reduceat(v, starts) for v in (logs[b.pair], words.base(b.token_count), (b.token_count > 0).astype(np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), pa.array(row["held"], pa.bool_()), pa.array(b.sizes), pa.array(of_docs[2]), pa.array(np.full(len(b.sizes), words.tokens)), pa.array(of_docs[1]), pa.array(of_docs[0])], names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def _sums(answers: DataFrame, size: int) -> list[int]:
    row = answers.where("block is null and stats is not null").agg(*(F.sum(F.col("stats")[k]).alias(f"s{k}") for k in range(size))).first()
    return [int(x or 0) for x in row]


def score(df: DataFrame, held_out: Column, *, key: str = "doc_id", text: str = "text", split_uses: int = SPLIT_USES) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score), one row for each input row.

    Rows where `held_out` is true are scored but not learned from (null: learned from). `score` is the
    log10 probability of the text under the Katz model of word pairs, `base_score` that under add-one
    estimates of words. A null or empty text is its end token alone. With nothing to learn from every
    word is unknown, with probability one.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"katz_blocks_{uuid.uuid4().hex[:12]}"
    packed = df.select(F.col(key).cast("long").alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(text).cast("string").alias("body")).mapInArrow(_blocks, _BLOCK_DDL)
    try:
        packed.write.bucketBy(buckets, "block").format("parquet").option("path", shared_folder(spark, "katz-blocks")).saveAsTable(name)
        return _scored(spark.table(name), buckets, key, split_uses)
    finally:  # the result is stored by then; the blocks stay in the shared folder
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _scored(blocks: DataFrame, buckets: int, key: str, split_uses: int) -> DataFrame:
    tokens = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    parts = max(buckets, -(-tokens // PART_TOKENS))

    def partitions(asked: DataFrame, answer, purpose: str) -> DataFrame:
        return stored(asked.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(answer, _ANSWER_DDL), purpose)

    def answered(answers: DataFrame, column: str) -> DataFrame:
        return answers.where("block is not null").groupBy("block").agg(F.collect_list(F.struct("part", "a", "b", "c")).alias(column))

    of_words = partitions(blocks.select("block", "words", "counts", "uses").mapInArrow(lambda x: _ask_words(x, parts), _ASKED_DDL), lambda x: _answer_words(x, parts, split_uses), "katz-words")
    sums = _sums(of_words, DISCOUNTED + 3)
    words = Words(sums[0], sums[1], sums[2:])
    known = blocks.select("block", "ids", "held", "sizes", "sequence", "words").join(answered(of_words, "of_words"), "block")
    of_pairs = partitions(known.mapInArrow(lambda x: _ask_pairs(x, parts), _ASKED_DDL), lambda x: _answer_pairs(x, words, parts), "katz-pairs")
    told = of_pairs.where("block is null and stats is null").select("part", "block", "a", "b", "c")
    asked = of_words.where("block is not null").select("part", "block", "a", F.lit(None).cast("binary").alias("b"), F.lit(None).cast("binary").alias("c"))
    of_histories = partitions(told.union(asked), _answer_histories, "katz-histories")
    histories = Histories(words, _sums(of_pairs, DISCOUNTED + 1))
    schema = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scores = known.join(answered(of_pairs, "of_pairs"), "block").join(answered(of_histories, "of_histories"), "block").mapInArrow(lambda x: _evaluate(x, parts, words, histories), schema)
    return stored(scores.withColumnRenamed("id", key), "katz-scores")
