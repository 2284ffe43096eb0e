import math
import random

import numpy as np

from tests_llm_brute import brute_leaks as brute

from logpulse.llm.common import prepare
from logpulse.llm.decontaminate import RADIUS, Benchmark, BlockIndex, _fingerprints, with_leaks
from logpulse.llm.queries import op8_benchmark_decontamination

SF = "/root/testdata/sf0.001"


def test_query_matches_brute_force(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {(r.doc_id, i): round(s, 9) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() for i, s in brute(r.text, items).items()}
    got = op8_benchmark_decontamination(spark, SF).collect()
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == want and want


def test_edited_passages_and_places():
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([1, 3, 5, 8, 20, 40, 59, 59])]
    bench = Benchmark(items)
    for _ in range(60):
        k, own = rng.choice(items)
        words = own.split()
        if len(words) > 20:
            words[rng.randrange(len(words))] = word()
        before = " ".join(word() for _ in range(rng.randint(0, 50)))
        text = f"{before} {' '.join(words).upper()}, {word()} {word()}"
        found = {i: (s, text[a:b]) for i, s, a, b in bench.search(text)}
        assert {i: round(s, 9) for i, (s, _) in found.items()} == {i: round(s, 9) for i, s in brute(text, items).items()}
        if k in found and found[k][0] == 1:
            assert found[k][1].lower().split() == own.split()
    assert bench.search("") == [] and Benchmark([]).search("x") == [] and Benchmark([(1, None), (2, "..")]).search("x") == []
    (i, s, a, b), = Benchmark([(4, "zwei drei")]).search("İİ eins zwei drei")
    assert (i, s, "İİ eins zwei drei"[a:b]) == (4, 1.0, "zwei drei")


def test_nulls_repeats_and_clashing_columns(spark, monkeypatch):
    prepare(spark)
    passage = "alpha beta gamma delta epsilon zeta"
    df = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, f"x {passage} y", 1), (3, f"x {passage} y", 1), (None, passage, 1)], "doc_id long, text string, leaks int")
    bench = spark.createDataFrame([(7, passage), (7, passage), (8, None), (None, "qq rr")], "item_id long, text string")
    got = with_leaks(df, bench).collect()
    assert [[tuple(x) for x in r.leaks] for r in got] == [[], [], [(7, 1.0, 2, 37)], [(7, 1.0, 2, 37)], [(7, 1.0, 0, 35)]]
    assert with_leaks(df, bench.limit(0)).where("size(leaks) > 0").count() == 0 and with_leaks(df.limit(0), bench).count() == 0
    monkeypatch.setattr("logpulse.llm.decontaminate.PASS_BYTES", 40)
    again = with_leaks(df, bench, keep=["doc_id"])
    assert again.columns == ["doc_id", "leaks"] and [len(r.leaks) for r in again.collect()] == [0, 0, 2, 2, 2] or [len(r.leaks) for r in again.collect()] == [0, 0, 1, 1, 1]


def test_texts_shorter_than_an_item_are_compared_whole():
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([3, 6, 9, 10, 20, 40, 59, 59])]
    items += [(8, "x y " * 20), (9, " ".join([*items[6][1].split()[:57], "other", "end"]))]
    bench, found_any = Benchmark(items), 0
    for _, own in items:
        words = own.split()
        for cut in range(1, min(16, len(words))):
            for text in (" ".join(words[:-cut]), " ".join(words[cut:]).upper(), " ".join(words[cut // 2 : len(words) - cut + cut // 2])):
                want = {}
                for item, other in items:
                    theirs, mine = other.split(), text.lower().split()
                    if len(mine) < len(theirs):
                        n = min(5, len(theirs))
                        a, b = ([tuple(x[i : i + n]) for i in range(len(x) - n + 1)] for x in (theirs, mine))
                        shared = sum(min(a.count(s), b.count(s)) for s in set(a))
                        if shared / (len(a) + len(b) - shared) >= 0.8:
                            want[item] = round(shared / (len(a) + len(b) - shared), 9)
                found_any += len(want)
                got = {i: (round(s, 9), text[a:b]) for i, s, a, b in bench.search(text)}
                longer = {i for i, other in items if len(other.split()) > len(text.split())}
                assert {i: x[0] for i, x in got.items() if i in longer} == want
                assert all(got[i][1] == text for i in want)
                assert [(i, s) for i, s, _, _ in bench.search_all(["zz", text])[1]] == [(i, s) for i, s, _, _ in bench.search(text)]
    assert found_any > 100
    (i, like, a, b), = Benchmark([items[6]]).search(" ".join(items[6][1].split()[:-3]))
    assert (i, a) == (6, 0) and like == 52 / 55


def test_the_block_index_finds_all_within_the_radius_and_measures_few():
    rng = np.random.default_rng(4)
    names = lambda *shape: rng.integers(0, 1 << 62, shape).astype(np.uint64)
    missed = pairs = 0
    for count in (9, 18, 36, 55, 90):
        items = names(400, count)
        windows = items.copy()
        edits = count - math.ceil(0.8 * 2 * count / 1.8 - 1e-9)  # as many as similarity 0.8 allows
        windows[:, :edits] = names(400, edits)
        prints, sought = (np.concatenate([_fingerprints(x, np.array([0]), count) for x in side]) for side in (items, windows))
        index = BlockIndex(prints, RADIUS)
        window, item = index.within(sought)
        apart = np.bitwise_count(sought[:, None] ^ prints[None, :]).sum(axis=2)
        assert set(zip(window.tolist(), item.tolist())) == set(map(tuple, np.argwhere(apart <= RADIUS).tolist()))
        assert index.distances < 0.3 * 400 * 400
        missed += int((np.diag(apart) > RADIUS).sum())
        pairs += 400
    assert missed <= 0.01 * pairs
    near = BlockIndex(prints, 5)
    assert set(zip(*map(np.ndarray.tolist, near.within(prints[:7])))) == {(i, i) for i in range(7)}
    assert near.distances < 0.01 * 7 * 400


def test_only_windows_and_items_that_meet_are_measured():
    rng = random.Random(9)
    vocabulary = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(400)]
    items = [(k, " ".join(rng.choices(vocabulary, k=30))) for k in range(300)]
    bench = Benchmark(items)
    found = bench.search(" ".join(f"{own} {rng.choice(vocabulary)}" for _, own in items[:40]))
    assert {i for i, *_ in found} == set(range(40))
    (_, _, near, members), = bench.index.values()
    assert 40 <= near.distances < 0.3 * 40 * 5 * len(members)  # some five windows each share enough shingles
