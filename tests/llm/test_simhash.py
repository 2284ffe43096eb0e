import random

import numpy as np
from tests_llm_brute import brute_components, brute_print, similar_groups

from logpulse.llm.common import prepare
from logpulse.llm.queries import op7_simhash_near_dedup
from logpulse.llm.simhash import close_pairs, link, near_duplicates, one_of_each, shared_blocks, shingle_hashes, wide_print, with_wide_fingerprints

SF = "/root/testdata/sf0.001"


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_query_matches_brute_force(spark):
    prints = {r.doc_id: brute_print(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = brute_components(prints)
    got = op7_simhash_near_dedup(spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{prints[i]:016x}", want[i]) for i in prints}


def test_links_in_crowded_keys_are_all_found(spark):
    """Two crowds of fingerprints around centres, in chunks of eight: most keys are not compared whole."""
    rng = random.Random(3)
    prints = set()
    for bits in (5, 3, 7):
        centre = rng.getrandbits(64)
        for _ in range(150):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, bits)):
                x ^= 1 << b
            prints.add(x)
    prints |= {rng.getrandbits(64) for _ in range(50)}
    listed = dict(enumerate(sorted(prints)))
    want = brute_components(listed)
    df = spark.createDataFrame([(signed(x),) for x in prints], "simhash long")
    got = {r.simhash: r.root for r in link(df, chunk=8).collect()}
    ours = {}
    for i, x in listed.items():
        ours.setdefault(got.get(signed(x), signed(x)), set()).add(i)
    theirs = {}
    for i, r in want.items():
        theirs.setdefault(r, set()).add(i)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_nulls_repeats_empty_and_extra_columns(spark):
    prepare(spark)
    text = "one two three four five six"
    rows = [(1, None, 1), (2, "", 1), (3, text, 1), (3, text, 2), (4, text.upper(), 1), (None, "quite other words in here", 1), (None, None, 1), (9, "a b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, simhash int")
    got = [(r.doc_id, r.component_id) for r in near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (2, 1), (3, 3), (3, 3), (4, 3), (None, None), (None, 1), (9, 9)], key=str)
    kept = one_of_each(df)
    assert kept.columns == ["doc_id", "text", "simhash"]
    assert sorted((str(r.doc_id) for r in kept.collect())) == ["1", "3", "9", "None"]
    assert one_of_each(df.limit(0)).count() == near_duplicates(df.limit(0)).count() == 0
    assert shingle_hashes("") == [] and len(shingle_hashes("a b")) == 1


def test_one_row_of_every_group_stays_whatever_its_key(spark):
    prepare(spark)
    words = ["alpha beta gamma delta epsilon", "one two three four five six", "red green blue white black", "north east south west up down", "spring summer autumn winter year"]
    rows = [(None, words[0]), (None, words[1]), (None, words[1].upper()), (5, words[2]), (None, words[2]), (7, words[3]), (7, words[4]), (7, words[4]), (8, words[4])]
    kept = one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.text.lower()) for r in kept) == sorted([("None", words[0]), ("None", words[1]), ("5", words[2]), ("7", words[3]), ("7", words[4])])


def planted(rng, similarity, shingles):
    """Two sets of hashes of just this Jaccard similarity."""
    both = round(shingles * similarity)
    left = (shingles - both + 1) // 2
    whole = np.array([rng.getrandbits(64) for _ in range(shingles)], np.uint64)
    return whole[: both + left], np.r_[whole[:both], whole[both + left :]]


def found(a, b):
    x, y = (np.frombuffer(wide_print(s), np.uint64).reshape(1, -1) for s in (a, b))
    return len(close_pairs(x, y, 90)[0]) > 0 and bool(set(shared_blocks(a)) & set(shared_blocks(b)))


def test_share_of_similar_texts_that_blocks_and_distance_find():
    rng = random.Random(8)
    share = {s: np.mean([found(*planted(rng, s, n)) for n in (50, 200, 1000) for _ in range(100)]) for s in (0.95, 0.9, 0.8, 0.6, 0.4)}
    print(share)
    assert share[0.95] == 1 and share[0.9] > 0.99 and share[0.8] >= 0.9 and share[0.6] < 0.02 and share[0.4] == 0


def test_wide_print_is_the_majority_of_each_bit_in_any_pieces():
    hashes = np.array([5, 2**63 + 9, 77], np.uint64)
    assert wide_print(hashes) == wide_print(hashes[::-1], piece=2) != wide_print(hashes[:2])
    assert wide_print(hashes[:0]) == bytes(64) and shared_blocks(hashes[:0]) == []
    assert shared_blocks(hashes, piece=1) == shared_blocks(hashes)


def test_edited_copies_go_and_others_stay(spark):
    """Groups of edited copies, one of them large: as brute force over sets of shingles has it."""
    prepare(spark)
    rng = random.Random(12)
    rows = []
    for group, copies in enumerate((1, 2, 5, 60)):
        words = [f"w{rng.randrange(4000)}" for _ in range(300)]
        for _ in range(copies):
            own = list(words)
            for at in rng.sample(range(300), rng.randint(0, 3)):
                own[at] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
        half = words[:150] + [f"y{rng.randrange(4000)}" for _ in range(150)]
        rows.append((len(rows), " ".join(half)))
    kept = {r.doc_id for r in one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == set(similar_groups(dict(rows)).values()) and len(kept) == 8


def test_wide_links_in_crowded_keys_are_all_found(spark):
    """Keys of more than eight rows are compared in chunks; the result is that of whole keys."""
    prepare(spark)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(80):
        own = list(words)
        for at in rng.sample(range(120), rng.randint(0, 4)):
            own[at] = f"x{rng.randrange(10**6)}"
        texts.append((" ".join(own),))
    prints = with_wide_fingerprints(spark.createDataFrame(texts, "text string"), keep=[]).selectExpr("print", "blocks", "xxhash64(print) simhash")
    groups = []
    for chunk in (8, 1024):
        of = {}
        for r in link(prints, chunk=chunk).collect():
            of.setdefault(r.root, set()).add(r.simhash)
        groups.append(sorted(map(sorted, of.values())))
    assert groups[0] == groups[1] and sum(map(len, groups[0])) > 60
