import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from logpulse.llm import katz
from logpulse.llm.common import ascii_lower, prepare
from logpulse.llm.queries import op6_katz_lm

SF = "/root/testdata/sf0.001"


class Brute:
    """The model in dictionaries."""

    def __init__(self, rows):
        self.texts = [(i, h, [*re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t or "")), "</s>"]) for i, h, t in rows]
        train = [w for _, h, w in self.texts if not h]
        self.one = Counter(x for w in train for x in w)
        self.two = Counter(p for w in train for p in zip(["<s>", *w], w))
        self.n = sum(self.one.values())
        self.after = defaultdict(dict)
        for (h, w), c in self.two.items():
            self.after[h][w] = c
        d1, d2 = (katz.discounts([sum(v == c for v in table.values()) for c in range(1, 7)]) for table in (self.one, self.two))
        self.d1, self.d2 = (lambda c, d=d: d[c] if c <= 5 else 1.0 for d in (d1, d2))
        left = sum((1 - self.d1(c)) * c for c in self.one.values())
        self.total, self.unknown = (self.n, left / self.n) if left > 1e-12 else (self.n + 1, 1 / (self.n + 1))

    def word(self, w):
        c = self.one[w]
        return self.d1(c) * c / self.total if c else self.unknown

    def pair(self, h, w):
        seen = self.after.get(h)
        if not seen:
            return self.word(w)
        n = sum(seen.values())
        left = sum((1 - self.d2(c)) * c for c in seen.values())
        n, left = (n, left) if left > 1e-12 else (n + 1, 1)
        if w in seen:
            return self.d2(seen[w]) * seen[w] / n
        return left / n / (1 - sum(map(self.word, seen))) * self.word(w)

    def scores(self):
        for i, held, words in self.texts:
            yield i, (held, len(words), sum(self.one[w] > 0 for w in words), self.n, sum(math.log10((self.one[w] + 1) / (self.n + len(self.one) + 1)) for w in words), sum(math.log10(self.pair(h, w)) for h, w in zip(["<s>", *words], words)))


def same(got, brute):
    want = dict(brute.scores())
    assert len(got) == len(want)
    for r in got:
        a, b = tuple(r)[1:], want[r[0]]
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9, abs=1e-9) and a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9)


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, zlib.crc32(str(r.doc_id).encode()) % 7 == 2, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    brute = Brute(rows)
    same(op6_katz_lm(spark, SF).collect(), brute)
    vocabulary = [*brute.one, "(never)"]
    for h in ["<s>", *list(brute.after)[:40], "(never)"]:
        assert sum(brute.pair(h, w) for w in vocabulary) == pytest.approx(1)  # unknown words are one type
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("katz_blocks")]


def test_small_and_degenerate_tables(spark):
    prepare(spark)
    rows = [(1, False, "A b a B c"), (2, False, None), (3, True, "a zz"), (4, False, ""), (5, True, None), (6, False, "a b " * 30_000)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, held boolean, text string, score double")
    same(katz.score(df, F.col("held")).collect(), Brute(rows))
    assert katz.score(df.limit(0), F.col("held")).count() == 0
    untrained = katz.score(df, F.lit(True)).collect()
    assert {r.score for r in untrained} == {0.0} and {r.train_tokens for r in untrained} == {0}
    twice = spark.createDataFrame([(None, None, "x y"), (7, None, "x y"), (7, None, "x y")], "doc_id long, held boolean, text string")
    assert len({r.score for r in katz.score(twice, F.col("held")).collect()}) == 1


def test_packing_and_discounts():
    x = np.array([5, 9, 12, 3, 2**63], np.uint64)
    assert (katz.unpack_rising(katz.pack_rising(x)) == x).all() and (katz.unpack(katz.pack(x), np.uint64) == x).all()
    assert len(katz.unpack(katz.pack(x[:0]), np.uint64)) == 0
    n = [1000, 400, 200, 120, 80, 60]
    d, common = katz.discounts(n), 6 * 60 / 1000
    assert d[1:].tolist() == pytest.approx([((c + 1) * n[c] / (c * n[c - 1]) - common) / (1 - common) for c in range(1, 6)])
    assert (katz.discounts([0, 0, 0, 0, 0, 0]) == 1).all() and (katz.discounts([1, 0, 0, 0, 0, 9]) == 1).all()


def test_pairs_of_a_frequent_history_are_dealt_over_partitions(spark):
    prepare(spark)
    rows = [(i, i % 7 == 2, " ".join(f"the w{(i * 31 + k) % 400}" for k in range(60))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, held boolean, text string").repartition(4)
    same(katz.score(df, F.col("held"), split_uses=50).collect(), Brute(rows))
    words = np.arange(1, 100_001, dtype=np.uint64)
    history, bits = np.full(len(words), 7, np.uint64), np.full(len(words), 6, np.uint8)
    assert np.bincount(katz.pair_parts(history, words, bits, 64)).max() < 3_000
    assert len(np.unique(katz.pair_parts(history, words, 0 * bits, 64))) == 1
