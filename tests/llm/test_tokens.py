import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from logpulse.llm.bpe import Codec, encode_decode
from logpulse.llm.common import prepare
from logpulse.llm.queries import op1_bpe_codec, op9_token_counts, tokenizer_text
from logpulse.llm.token_counts import Counter, count_tokens
from logpulse.llm.vocabulary import Vocabulary
from tests_llm_texts import hard_texts

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_same_ids_and_text_as_the_library(name):
    codec, library = Codec(Vocabulary.read(public_tokenizers.path(name))), Tokenizer.from_file(public_tokenizers.path(name))
    for text in hard_texts():
        ids = codec.encode(text)
        assert ids == library.encode(text, add_special_tokens=False).ids, text
        if name.startswith("word"):
            assert codec.v.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_character_is_split_as_by_the_library():
    codec, library = Codec(Vocabulary.read(public_tokenizers.path("byte_bpe_50k.json"))), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["".join(f"a{chr(c)} {chr(c)}1" for c in range(s, s + 64) if not 0xD800 <= c < 0xE000) for s in range(0, 0x3400, 64)]
    differing = [t for t in texts if codec.encode(t) != library.encode(t, add_special_tokens=False).ids]
    assert not differing


def test_ragged_counts_match_the_library():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    counter, texts = Counter(Vocabulary.read(public_tokenizers.path("byte_bpe_50k.json"))), hard_texts()
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert counter.counts(texts) == want
    assert [counter.counts([t])[0] for t in texts] == want


def test_nulls_clashing_columns_repeats_and_empty_tables(spark):
    prepare(spark)
    rows = [(1, None, "x"), (1, "", "x"), (2, "the cat", "x"), (2, "the cat", "x"), (None, "the " * 60_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, N_Tokens string")
    got = count_tokens(df, tokenizer_text("byte_bpe_50k.json"), limit=1024).collect()
    assert [r.n_tokens for r in got] == [0, 0, 2, 2, 60_001]
    assert [r.over_limit for r in got] == [False, False, False, False, True]
    assert set(got[0].asDict()) == {"doc_id", "text", "n_bytes", "n_tokens", "over_limit"}
    coded = encode_decode(df, tokenizer_text("word_bpe_49k.json"), keep=["doc_id"])
    assert [len(r.token_ids) for r in coded.collect()] == [0, 0, 2, 2, 60_000]
    assert coded.filter("doc_id > 5").collect() == []
    assert encode_decode(df.limit(0), tokenizer_text("word_bpe_49k.json")).count() == 0


def test_queries_match_the_library_on_all_documents(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = op1_bpe_codec(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in op9_token_counts(spark, SF).collect():
        n = len(library.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 1024)
