"""Registered queries of the text operators, each over its whole table with production parameters."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logpulse.llm import align, bpe, decontaminate, html_extract, katz, language, lexical, packing, parsing, secrets, simhash, token_counts, toxicity
from logpulse.llm.common import fold, prepare, table


def tokenizer_text(name: str) -> str:
    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    coded = bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_text("word_bpe_49k.json"), keep=["doc_id"])
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    network = language.train(docs.where(fold("doc_id", 3) != 1))
    return language.identify(docs, network, keep=["doc_id"]).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(fold("doc_id", 4) != 2))
    return toxicity.toxicity(docs, model, keep=["doc_id"]).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    found = secrets.with_secrets(docs, secrets.train(docs), keep=["doc_id"])
    base = F.filter("secrets", lambda s: s["kind"] != "model")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, ("assign", "access", "hex")), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return parsing.edited_fingerprints(table(spark, sf_dir, "documents"))


def op6_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return katz.score(table(spark, sf_dir, "documents"), fold("doc_id", 7) == 2)


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    classes = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that a window of the document resembles."""
    prepare(spark)
    found = decontaminate.with_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_text("byte_bpe_50k.json"), limit=1024, keep=["doc_id"])


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    pages = table(spark, sf_dir, "pages")
    extracted = html_extract.main_text(pages, html_extract.train(pages), keep=["page_id", "url"])
    return extracted.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    return align.align(table(spark, sf_dir, "documents"), tokenizer_text("byte_bpe_50k.json"), model, keep=["doc_id"])


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_text("byte_bpe_50k.json"), limit=1024, end=2, keep=["doc_id"])


def op13_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


QUERIES = {
    "op1_bpe_codec": op1_bpe_codec,
    "op2_language_id": op2_language_id,
    "op3_toxicity": op3_toxicity,
    "op4_secret_scan": op4_secret_scan,
    "op5_fingerprints": op5_fingerprints,
    "op6_katz_lm": op6_katz_lm,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_token_counts": op9_token_counts,
    "op10_html_extraction": op10_html_extraction,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_ranked_lexical_search": op13_ranked_lexical_search,
}

#: What of the queries SQL can say.
ORACLE: dict[str, str] = {
    "op13_ranked_lexical_search": r"""
WITH terms AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), wanted AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), lengths AS (
    SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id
), corpus AS (
    SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths
), uses AS (
    SELECT doc_id, term, count(*) AS tf FROM terms SEMI JOIN wanted USING (term) GROUP BY doc_id, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM uses, corpus GROUP BY term
), parts AS (
    SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS part
    FROM uses JOIN lengths USING (doc_id) JOIN weights USING (term), corpus
), scores AS (
    SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM parts JOIN wanted USING (term) GROUP BY item_id, doc_id
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
""",
}
