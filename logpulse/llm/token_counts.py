"""Token counts: rank-synchronous merging of ragged arrays of pre-tokens."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from logpulse.llm.common import Memo, add_columns
from logpulse.llm.vocabulary import Vocabulary

NONE = np.iinfo(np.int32).max


class RaggedMerger:
    """Merges many pre-tokens at once. Each round applies every sequence's lowest-rank pair.

    All occurrences of the pair are merged in one round, left to right without overlap, unless an
    earlier rule uses the symbol that the pair makes: then only the leftmost one is, since the
    earlier rule may come first elsewhere in the sequence.
    """

    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        self.size = max(v.ids.values()) + 1
        self.byte_id = np.array([v.ids.get(c, -1) for c in v.letters], np.int64)
        pairs = np.array([a * self.size + b for a, b in v.rules], np.int64)
        rank, made = np.array(list(v.rules.values()), np.int64).reshape(-1, 2).T
        order = np.argsort(pairs)
        self.pairs, self.ranks = pairs[order], rank[order].astype(np.int32)
        self.made = np.zeros(rank.max(initial=-1) + 1, np.int64)
        self.made[rank] = made
        first_use = np.full(self.size, NONE, np.int64)
        for (a, b), (r, _) in v.rules.items():
            first_use[a], first_use[b] = min(first_use[a], r), min(first_use[b], r)
        self.alone = first_use[self.made] < np.arange(len(self.made))

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], NONE)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Symbols that remain of each word."""
        symbols = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        symbols, owner = symbols[symbols >= 0], owner[symbols >= 0]
        out = np.zeros(len(words), np.int64)
        while len(symbols):
            rank = np.full(len(symbols), NONE, np.int32)
            inside = np.flatnonzero(owner[1:] == owner[:-1])
            rank[inside] = self._rank(symbols[inside], symbols[inside + 1])
            start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            length = np.diff(np.r_[start, len(symbols)])
            lowest = np.minimum.reduceat(rank, start)
            done = lowest == NONE
            out[owner[start[done]]] = length[done]
            low = np.repeat(lowest, length)
            hit = np.flatnonzero((rank == low) & (low != NONE))
            run = np.r_[True, np.diff(hit) != 1] if len(hit) else np.zeros(0, bool)
            hit = hit[(hit - hit[np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))]) % 2 == 0]
            first = np.r_[True, owner[hit[1:]] != owner[hit[:-1]]] if len(hit) else np.zeros(0, bool)
            hit = hit[first | ~self.alone[rank[hit]]]
            symbols[hit] = self.made[rank[hit]]
            stay = np.repeat(~done, length)
            stay[hit + 1] = False
            symbols, owner = symbols[stay], owner[stay]
        return out


class Counter:
    def __init__(self, vocabulary: Vocabulary, remembered: int = 300_000):
        self.v, self.merger = vocabulary, RaggedMerger(vocabulary)
        self.memo = Memo(lambda w: int(self.merger.counts([w.encode("utf-8", "replace")])[0]), remembered)

    def counts(self, texts: list[str]) -> list[int]:
        split, extra = [], []
        for text in texts:
            pieces = self.v.pieces(text)
            split.append([w for i, piece in pieces if i is None for w in self.v.words(piece)] if len(pieces) != 1 or pieces[0][0] is not None else self.v.words(text))
            extra.append(sum(i is not None for i, _ in pieces))
        memo, known = self.memo, {}
        new = []
        for w in set().union(*split):
            n = memo.get(w) or memo.older.get(w)
            if n is None:
                new.append(w)
            else:
                known[w] = n
        for w, n in zip(new, self.merger.counts([w.encode("utf-8", "replace") for w in new]).tolist()):
            known[w] = n
            memo.put(w, n)
        return [sum(map(known.__getitem__, words)) + n for words, n in zip(split, extra)]


def count_tokens(df: DataFrame, tokenizer_json: str, *, limit: int, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds `n_bytes` (UTF-8), `n_tokens` and `over_limit` (more than `limit` tokens).

    Special strings inside a text count as one token each, as the library has it by default. A null
    or empty text has none.
    """

    def make():
        counter = Counter(Vocabulary.parse(tokenizer_json))

        def work(texts: list[str]) -> list:
            n = counter.counts(texts)
            return [[len(t.encode("utf-8", "replace")) for t in texts], n, [x > limit for x in n]]

        return work

    return add_columns(df, make, "n_bytes bigint, n_tokens bigint, over_limit boolean", text=text, keep=keep)
