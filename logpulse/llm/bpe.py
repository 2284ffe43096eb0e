"""BPE encoding and decoding: a priority queue of merge ranks over a doubly linked symbol list."""

from __future__ import annotations

import heapq
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from logpulse.llm.common import Memo, add_columns
from logpulse.llm.vocabulary import Vocabulary

#: Words whose ids a task remembers.
REMEMBERED = 150_000


def merge_word(symbols: list[int], rules: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merge a word's symbols, lowest rank first and leftmost among equals.

    Queue entries name the position, the two symbols and what they become. An entry is stale, and
    skipped, when the symbols at its position are no longer those it was made for.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    at, after, before = list(symbols), [*range(1, n), -1], [*range(-1, n - 1)]
    queue: list[tuple[int, int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j >= 0 and (rule := rules.get((at[i], at[j]))):
            heapq.heappush(queue, (rule[0], i, at[i], at[j], rule[1]))

    for i in range(n - 1):
        offer(i)
    while queue:
        _, i, a, b, merged = heapq.heappop(queue)
        j = after[i]
        if at[i] != a or j < 0 or at[j] != b:
            continue
        at[i], at[j] = merged, -1
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [s for s in at if s >= 0]


class Codec:
    """Encodes and decodes whole texts, remembering words."""

    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED):
        self.v = vocabulary
        self.memo = Memo(lambda w: tuple(merge_word(self.v.symbols(w), self.v.rules)), remembered)

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for special, piece in self.v.pieces(text):
            if special is not None:
                out.append(special)
            else:
                out.extend(chain.from_iterable(map(self.memo.__getitem__, self.v.words(piece))))
        return out


def encode_decode(df: DataFrame, tokenizer_json: str, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds `token_ids` (array<int>) and `decoded` (their decoded text).

    `tokenizer_json` is the content of a tokenizer file, of fixed size, shipped with the job. Special
    strings inside a text become their ids, as the library has it by default. A null or empty text
    has no ids and decodes to the empty text.
    """

    def make():
        codec = Codec(Vocabulary.parse(tokenizer_json))

        def work(texts: list[str]) -> list:
            ids = [codec.encode(t) for t in texts]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]))
            return [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), [codec.v.decode(x) for x in ids]]

        return work

    return add_columns(df, make, "token_ids array<int>, decoded string", text=text, keep=keep)
