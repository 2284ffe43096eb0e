import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logpulse.llm import align
from logpulse.llm.common import prepare
from logpulse.llm.encoders import ByteLevelEncoder, PieceEncoder
from logpulse.llm.queries import op11_tokenizer_alignment, tokenizer_text
from tests_llm_texts import hard_texts

SF = "/root/testdata/sf0.001"
A_FILE, B_FILE = "byte_bpe_50k.json", public_tokenizers.path("piece_bpe_32k.model")


def model() -> bytes:
    with open(B_FILE, "rb") as file:
        return file.read()


def brute(texts):
    """The contract spelled out token by token, with the libraries that own the files."""
    a_lib = Tokenizer.from_file(public_tokenizers.path(A_FILE))
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    spare, letters = iter(range(256, 512)), {}
    for byte in range(256):
        letters[chr(byte) if byte in {*range(33, 127), *range(161, 173), *range(174, 256)} else chr(next(spare))] = byte

    def ranges(parts):
        out, at = [], 0
        for i, data in parts:
            out.append((i, at, at + len(data)))
            at += len(data)
        return out, b"".join(d for _, d in parts)

    facts, links_of = [], []
    for text in texts:
        links, groups, a, b = [], [], [], []
        if text:
            a, a_bytes = ranges([(i, bytes(letters[c] for c in a_lib.id_to_token(i))) for i in a_lib.encode(" " + text, add_special_tokens=False).ids])
            pieces = [(i, b_lib.id_to_piece(i)) for i in b_lib.encode(text)]
            b, b_bytes = ranges([(i, bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces])
            if a_bytes != (" " + text).encode() or b_bytes != a_bytes:
                a, b = [], []
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        low = 0
        for high in cuts:
            groups.append(tuple([i for i, _, e in side if low < e <= high] for side in (a, b)))
            low = high
        for i, s, e in a:
            links += [(i, j) for j, t, f in b if t < e and s < f]
        named = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        facts.append((len(a), len(b), len(groups), len(links), hashlib.sha256(named.encode()).hexdigest() if a else ""))
        links_of.append(links)
    count = Counter(x for links in links_of for x in links)
    top = defaultdict(int)
    for (_, j), n in count.items():
        top[j] = max(top[j], n)
    return [(*f, sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links)) for f, links in zip(facts, links_of)]


def columns(rows):
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256, r.n_best, r.count_sum) for r in rows]


def test_the_encoders_give_the_ids_of_the_libraries():
    a, b = ByteLevelEncoder(tokenizer_text(A_FILE)), PieceEncoder(model())
    a_lib, b_lib = Tokenizer.from_file(public_tokenizers.path(A_FILE)), sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    texts = hard_texts() + ["".join(f"a{chr(c)} {chr(c)}1" for c in range(s, s + 64) if not 0xD800 <= c < 0xE000) for s in range(0, 0x3400, 64)]
    for text in texts:
        assert a.ids(text) == a_lib.encode(text, add_special_tokens=False).ids, text
    assert b.plain(texts) == b_lib.encode(texts)
    a_lib.encode_special_tokens = True
    assert [a.plain(t) for t in texts] == [x.ids for x in a_lib.encode_batch(texts, add_special_tokens=False)]


def test_a_vocabulary_whose_ids_do_not_follow_its_merges_is_refused():
    with pytest.raises(ValueError):
        ByteLevelEncoder(tokenizer_text("word_bpe_49k.json"))


def test_equal_to_the_contract_on_hard_texts_in_any_number_of_runs(spark, monkeypatch):
    prepare(spark)
    texts = [None, *hard_texts(), "x </s><s> <unk> <0x41>", "the the the", "the the the", "a\0b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute([t or "" for t in texts])
    for records, parts in ((align.SPILL_RECORDS, "1"), (200, "13")):
        monkeypatch.setattr(align, "SPILL_RECORDS", records)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = align.align(df.repartition(3), tokenizer_text(A_FILE), model()).orderBy("doc_id").collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert columns(got) == want


def test_merging_runs_counts_pairs_of_all_runs():
    rng = np.random.default_rng(5)
    blocks, whole = [], Counter()
    for _ in range(7):
        block = align.Block(3)
        for docs in (4, 0, 9):
            pair = (rng.integers(0, 20, 50 * docs) << align.ID_BITS) | rng.integers(0, 6, 50 * docs)
            doc = np.sort(rng.integers(0, max(1, docs), 50 * docs))
            block.add(pair, doc, docs)
            whole.update(pair.tolist())
        blocks.append(list(block.runs()))
    top = Counter()
    for pair, n in whole.items():
        top[pair >> align.ID_BITS] = max(top[pair >> align.ID_BITS], n)
    for part in range(3):
        heads = [h for runs in blocks for p, h, _ in runs if p == part]
        for data, found in zip(heads, align.merge(heads)):
            b, size, a, _ = align.unpack(data)
            pairs = (np.repeat(b, size) << align.ID_BITS) | a
            assert found.tolist() == [2 * whole[p] + (whole[p] == top[p >> align.ID_BITS]) for p in pairs.tolist()]
    assert align.merge([]) == []


def test_clashing_columns_repeats_and_empty_tables(spark):
    prepare(spark)
    rows = [(None, "x y", 1, "p"), (None, "x y", 2, "q"), (3, None, 3, "r")]
    df = spark.createDataFrame(rows, "doc_id long, text string, N_Links long, `a.b` string").withColumn("row", F.col("doc_id")).withColumn("__text", F.lit(5))
    got = align.align(df, tokenizer_text(A_FILE), model())
    assert got.columns[:5] == ["doc_id", "text", "a.b", "row", "__text"]
    assert got.columns.count("n_links") == 1
    rows = sorted(got.collect(), key=lambda r: r["a.b"])
    assert [r["a.b"] for r in rows] == ["p", "q", "r"]
    assert rows[0].count_sum == 2 * rows[0].n_links > 0
    assert (rows[2].n_links, rows[2].groups_sha256, rows[2].count_sum) == (0, "", 0)
    assert align.align(df.limit(0), tokenizer_text(A_FILE), model()).collect() == []
    assert align.align(df, tokenizer_text(A_FILE), model(), keep=[]).count() == 3


def test_a_very_long_text_without_a_break(spark):
    prepare(spark)
    df = spark.createDataFrame([(1, "ab" * 600_000), (2, "x")], "doc_id long, text string")
    got = align.align(df, tokenizer_text(A_FILE), model()).orderBy("doc_id").collect()
    assert got[0].n_links > 100_000 and got[1].n_links == 1


def test_the_query_equals_the_contract_on_all_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = op11_tokenizer_alignment(spark, SF).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == [r.doc_id for r in docs]
    kept = [r.text or "" for r in docs]
    short = [t if len(t) < 6_000 else "" for t in kept]
    got_facts, want = columns(got), brute(short)
    assert sum(len(t) < 6_000 for t in kept) > 150
    for g, w, t, s in zip(got_facts, want, kept, short):
        if t == s:
            assert g[:5] == w[:5]
    few = spark.createDataFrame(list(enumerate(short)), "doc_id long, text string")
    assert columns(align.align(few, tokenizer_text(A_FILE), model()).orderBy("doc_id").collect()) == want
