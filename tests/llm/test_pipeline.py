import re

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from logpulse.llm.secrets import MASK, base_spans
from tests_llm_brute import brute_leaks, wide_groups

SF = "/root/testdata/sf0.001"


def test_pipeline_matches_brute_force(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = {i: r.text for i, r in docs.items() if r.text and re.search(r"[^\W\d_]", r.text)}
    first = {i for i, root in wide_groups(texts).items() if i == root}
    want = {i for i in first if not brute_leaks(texts[i], items)}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == want and len(want) < len(docs)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, r in got.items():
        assert not base_spans(r.text.replace(MASK, "")) and len(r.text) == r.n_chars
        if not base_spans(texts[i]):
            assert r.text.count(MASK) or r.text == texts[i]
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert (list(r.token_ids), r.decoded, r.n_tokens) == (ids, library.decode(ids, skip_special_tokens=False), len(ids))


def test_registered_and_stages_carry_extra_columns(spark):
    names = __spark_entry__.queries()
    assert "pipeline" in names and sum(bool(re.match(r"op\d+_", n)) for n in names) == 13
    rows = [(1, "the cat sat " * 9, "en", "s", 1, "k"), (2, None, "en", "s", 1, "k"), (3, "", "de", None, None, "k"), (None, "token = abcdefghijkl12345 und der hund", "de", "s", 1, "k"), (4, "the cat sat " * 9, "en", "s", 1, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    kept = df
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "None"]
    last = corpus_pipeline.encoded(spark, kept, SF)
    assert last.columns == [*df.columns, "n_tokens", "token_ids", "decoded"] and last.count() == 2
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, df.limit(0), SF).count() == 0


def test_unsure_languages_are_recognised_all_the_same(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline.language, "train", lambda docs: corpus_pipeline.language.Network(list("abcdefghijkl")))
    df = spark.createDataFrame([(1, "some words"), (2, "12 34"), (3, None), (4, "ein Satz")], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.recognised(spark, df, SF).collect()) == [1, 4]
