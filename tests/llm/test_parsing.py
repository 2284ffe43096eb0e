import hashlib
import random

import numpy as np

from logpulse.llm.common import prepare
from logpulse.llm.parsing import edited_fingerprints, fingerprints, labels, likeness, phrases, signatures, with_fingerprints
from logpulse.llm.queries import op5_fingerprints

SF = "/root/testdata/sf0.001"


def test_labels_are_few_differ_from_neighbours_and_depend_on_few_of_them():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    first = np.array([0, 700])
    got = labels(x, first)
    assert got.max() < 6
    assert all(got[i] != got[i - 1] for i in range(1, 3000) if i != 700)
    again = labels(np.concatenate([rng.integers(0, 1 << 63, 9, dtype=np.uint64), x[100:300]]), np.array([0]))
    assert (again[9 + 5 :] == got[105:300]).all()


def names(text):
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return phrases(codes, np.zeros(len(codes), np.int64), 1)[0]


def test_shared_substrings_share_interior_phrases_at_any_offset():
    rng = random.Random(5)
    letters = "abcdefghij  éß"
    common = "".join(rng.choices(letters, k=4000))
    whole = set(names(common).tolist())
    for offset in (0, 1, 2, 17, 500):
        other = "".join(rng.choices(letters, k=offset)) + common + "".join(rng.choices(letters, k=37))
        assert len(whole & set(names(other).tolist())) > 0.9 * len(whole)
    unrelated = "".join(rng.choices(letters, k=4000))
    assert len(whole & set(names(unrelated).tolist())) < 0.1 * len(whole)


def test_batches_do_not_matter_and_degenerate_texts():
    rng = random.Random(6)
    texts = ["", "a", "aa", "ab", "a" * 5000, "abab" * 900, "x" + "a" * 5000, *("".join(rng.choices("abc d", k=rng.randint(0, 400))) for _ in range(60)), "long " * 100_000]
    together = signatures(texts)
    assert all((signatures([t])[0] == s).all() for t, s in zip(texts, together))
    prints = fingerprints(texts)
    assert likeness(prints[:1], prints[:1])[0] == 1 and likeness(prints[:1], prints[1:2])[0] == 0


def brute(rows):
    """rows: (doc_id, text) with distinct ids."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        cut = len(t) // 3
        edited = t[: len(t) - cut] + after[:cut]
        a, b, c = (fingerprints([x]) for x in (t, edited, after))
        out[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), a[0].tobytes().hex(), b[0].tobytes().hex(), likeness(a, b)[0], likeness(a, c)[0])
    return out


def test_query_matches_brute_force(spark):
    want = brute([(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])
    for parts in ("4", "37"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = op5_fingerprints(spark, SF).collect()
        assert len(got) == len(want) and {r[0]: tuple(r)[1:] for r in got} == want
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert np.mean([w[4] for w in want.values()]) > 0.3 > 0.15 > np.mean([w[5] for w in want.values()])


def test_nulls_repeats_one_row_and_no_rows(spark):
    prepare(spark)
    df = spark.createDataFrame([(1, None, 0), (5, "", 0), (5, "abcdef", 0), (5, "abcdef", 0), (None, "xyz", 0), (None, None, 0)], "doc_id long, text string, fingerprint int")
    got = edited_fingerprints(df).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "5", "5", "5", "None", "None"]
    assert edited_fingerprints(df.limit(0)).count() == 0
    (one,) = edited_fingerprints(df.where("text = 'xyz'")).collect()
    assert one.edited_sha256 == hashlib.sha256(b"xyx").hexdigest() and one.near_next == 1
    assert [len(r.fingerprint) for r in with_fingerprints(df).collect()] == [256] * 6
