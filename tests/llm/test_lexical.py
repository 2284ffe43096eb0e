import math
import re
from collections import Counter

from pyspark.sql import functions as F

from logpulse.llm import lexical
from logpulse.llm.common import ascii_lower, prepare
from logpulse.llm.queries import op13_ranked_lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, k):
    bags = [(d, Counter(TERM.findall(ascii_lower(t or "")))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, n_terms = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item in {i for i, _ in items}:
        terms = {x for i, t in items if i == item for x in TERM.findall(ascii_lower(t or ""))}
        scored = []
        for d, b in bags:
            m = 100 - 50 + (50 * b.total() * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * b[t]) // (1000 * b[t] + 20 * m)) for t in terms if t in b)
            if score > 0:
                scored.append((-score, d is None, d))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scored, key=lambda x: x[:2] + (x[2] or 0,))[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


def test_the_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{sf}/{n}.parquet").select(i, "text").collect()] for n, i in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert rows(op13_ranked_lexical_search(spark, sf)) == brute(docs, items, 50)


def test_terms_are_whole_and_only_ascii_is_lowered():
    scanner = lexical.TermScanner([t.encode() for t in ("a", "ab", "É", "é", "x1", "中文")])
    n, found = scanner.scan("A aB,ab_AB É é-X1 x12 中文!中文字 a\x00a \x7fa É́")
    assert n == 14 and dict(found) == {0: 4, 1: 3, 2: 1, 3: 1, 4: 1, 5: 1}
    assert scanner.scan("") == (0, {}) and scanner.scan(" ,.\n") == (0, {})
    assert lexical.TermScanner([]).scan("a b") == (2, {})


def test_nulls_ties_repeats_long_texts_and_any_number_of_passes(spark, monkeypatch):
    prepare(spark)
    texts = [(1, "the cat sat"), (2, "the cat sat"), (2, "the cat sat"), (3, None), (4, ""), (5, "..."), (None, "a cat"), (None, "a cat"), (6, "cat " * 300_000), (7, "ÉCLAIR éclair 7up"), (8, "dog dog")]
    items = [(1, "Cat, cat! DOG"), (2, None), (3, "éclair"), (None, "sat dog"), (1, "7UP"), (4, "nowhere"), (5, "the")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("doc", F.lit("x")).withColumn("a.b", F.lit(1)).repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("id", F.lit(1))
    for size in (lexical.PASS_BYTES, 12):
        monkeypatch.setattr(lexical, "PASS_BYTES", size)
        for k in (50, 3):
            assert rows(lexical.search(docs, bench, k=k)) == brute(texts, items, k)
    assert lexical.search(docs.limit(0), bench).collect() == []
    assert lexical.search(docs, bench.limit(0)).collect() == []


def test_large_sums_are_exact():
    import numpy as np

    words = [f"t{i}" for i in range(400)]
    items = lexical.Items([(1, " ".join(words))])
    weight = np.full(400, 27_999, np.int64)
    tf = np.full(400, 1 << 30, np.int64)
    got = lexical.Scorer(items, weight, 10, 10).scores(np.array([5]), np.arange(400), tf, np.zeros(400, np.int64), 1)
    assert got[0, 0] == 400 * 27_999 * ((1_000_000_000 << 30) // ((1000 << 30) + 20 * (50 + 250)))
