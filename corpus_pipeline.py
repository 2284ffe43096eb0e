"""The corpus pipeline: documents are filtered by language, freed of near duplicates and of benchmark
passages, have their secrets masked, and are encoded.

Every stage works on all that the one before it kept and is written as Parquet before the next reads
it. Extra columns are carried, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logpulse.llm import bpe, decontaminate, language, secrets, simhash
from logpulse.llm.common import fold, prepare, stored, table
from logpulse.llm.queries import tokenizer_text


def _with_row(docs: DataFrame) -> DataFrame:
    """The whole row in one column besides the text, so that no name can clash."""
    return docs.select(F.struct("*").alias("row"), "text")


def recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are given a language: all but null texts and those without a letter, which are `und`.

    However many languages were learned and however close they are, the likeliest counts as recognised.
    """
    prepare(spark)
    network = language.train(docs.where(fold("doc_id", 3) != 1))
    found = language.identify(_with_row(docs), network, keep=["row"])
    return found.where(F.col("lang_pred") != language.UNKNOWN).select("row.*")


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is similar at 0.8 or more in words taken by five, that of the smallest doc_id."""
    prepare(spark)
    return simhash.one_of_each(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that resembles a benchmark item."""
    prepare(spark)
    found = decontaminate.with_leaks(_with_row(docs), table(spark, sf_dir, "benchmark"), keep=["row"])
    return found.where(F.size("leaks") == 0).select("row.*")


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark and their n_chars counted anew."""
    prepare(spark)
    out = secrets.mask_secrets(docs, secrets.train(docs))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with `n_tokens`, `token_ids` and `decoded`, the text that the ids stand for."""
    prepare(spark)
    coded = bpe.encode_decode(_with_row(docs), tokenizer_text("word_bpe_49k.json"), keep=["row"])
    own = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in ("n_tokens", "token_ids", "decoded")]
    return coded.select(*own, F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "decoded")


STAGES = [
    ("language_id", recognised),
    ("near_dedup", unrepeated),
    ("decontamination", uncontaminated),
    ("secret_scan", masked),
    ("bpe_codec", encoded),
]

#: The stages are trained models, fingerprints and token ids, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
