import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logpulse.llm import packing
from logpulse.llm.common import prepare
from logpulse.llm.queries import op12_best_fit_packing, tokenizer_text

SF = "/root/testdata/sf0.001"
FILE = "byte_bpe_50k.json"


def one_by_one(sizes, limit):
    """The method bin by bin and piece by piece."""
    left, bins = sorted(sizes, reverse=True), []
    while left:
        bin_, gap = [], limit
        for n in list(left):
            if n <= gap:
                bin_.append(n)
                left.remove(n)
                gap -= n
        if gap and len(bin_) > 1:
            s, best = min(bin_), None
            for i, x in enumerate(left):
                for y in left[i + 1 :]:
                    if s < x + y <= gap + s and (best is None or x + y > sum(best)):
                        best = (x, y)
            if best:
                bin_.remove(s)
                left.append(s)
                for n in best:
                    bin_.append(n)
                    left.remove(n)
                left.sort(reverse=True)
        bins.append(sorted(bin_))
    return bins


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 24), max_size=60), st.integers(24, 40))
def test_kinds_of_bins_are_the_bins_of_the_method(sizes, limit):
    got = [sorted(Counter(kind).elements()) for kind, times in packing.best_two_fit(Counter(sizes), limit) for _ in range(times)]
    want = one_by_one(sizes, limit)
    assert sorted(map(sum, got)) == sorted(map(sum, want)) and len(got) == len(want)
    assert Counter(x for b in got for x in b) == Counter(sizes)
    assert all(sum(b) <= limit for b in got)


def test_a_better_pair_replaces_the_shortest():
    kinds = list(packing.best_two_fit({50: 1, 40: 1, 30: 1, 19: 1}, 100))
    assert kinds[0] == ({50: 1, 30: 1, 19: 1}, 1) and kinds[1] == ({40: 1}, 1)


def test_kinds_are_bounded_by_the_limit_not_by_the_pieces():
    rng = random.Random(3)
    counts = {n: rng.randint(1, 10**9) for n in range(1, 1025)}
    kinds = list(packing.best_two_fit(counts, 1024))
    used = Counter()
    for kind, times in kinds:
        assert sum(n * c for n, c in kind.items()) <= 1024
        for n, c in kind.items():
            used[n] += c * times
    assert used == counts and len(kinds) < 9_000
    assert sum(t for _, t in kinds) < 1.02 * sum(n * c for n, c in counts.items()) / 1024 + 1


def check(rows, docs, limit, end):
    """Every token of every document is in place, and sequences have neither gaps nor overlaps."""
    library = Tokenizer.from_file(public_tokenizers.path(FILE))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(docs)
    for d, text in docs.items():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, end]
        at = 0
        for k, r in enumerate(sorted(by_doc[d], key=lambda r: r.piece)):
            part = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert (r.piece, r.start, r.ids_crc32) == (k, at, zlib.crc32(part)) and 0 < r.length <= limit
            assert r.length == limit or k == 0
            assert len(ids) > limit or r.length == len(ids)
            at += r.length
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return len(by_sequence)


def test_the_query_packs_all_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op12_best_fit_packing(spark, SF).collect()
    bins = check(rows, docs, 1024, 2)
    assert bins == sum(t for _, t in packing.best_two_fit(Counter(r.length for r in rows), 1024))
    assert bins <= 1.02 * sum(r.length for r in rows) / 1024 + 1


def test_nulls_repeats_special_strings_clashing_names_and_empty_tables(spark):
    prepare(spark)
    texts = [None, "", "the cat", "the cat", "x<|endoftext|>y", "the " * 50, "ab" * 3000, *["word"] * 500]
    rows = [(i, t, "p", 7) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, Offset long").withColumn("row", F.lit(1)).withColumn("task", F.lit(2)).repartition(5)
    got = packing.pack(df, tokenizer_text(FILE), limit=16, end=2)
    assert got.columns == ["doc_id", "text", "a.b", "row", "task", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = got.collect()
    bins = check(rows, dict(enumerate(texts)), 16, 2)
    assert bins == sum(t for _, t in packing.best_two_fit(Counter(r.length for r in rows), 16))
    same = packing.pack(spark.createDataFrame([(1, "a b")] * 40, "doc_id long, text string"), tokenizer_text(FILE), limit=16, end=2, keep=["doc_id"]).collect()
    assert len({(r.sequence_id, r.offset) for r in same}) == 40
    assert packing.pack(df.limit(0), tokenizer_text(FILE), limit=16, end=2).collect() == []
