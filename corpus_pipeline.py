"""From raw documents to token ids: five stages, each by one operator of ``docketry.llm``.

Each stage gets what its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.llm import bpe, jaccard, lines, mixing, toxicity
from docketry.llm.shared import written

VOCABULARY = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic; it learns from the labels of the training fold.

    Null and empty texts and null ids are scored like any other; repeated rows are scored alike and go
    or stay together.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.classify(docs, labels).filter("predicted = 0").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier line duplicates; a document of which nothing is left was a copy, and goes.

    Null and empty texts have no lines to drop and stay as they are.  Lines are earlier by document
    id, then place; repeated rows stand in the same place and keep the same lines.
    """
    cleaned = lines.dedup_lines(docs).filter("n_dropped = 0 or trim(text) <> ''")
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by five-word shingles at a similarity of 0.8.

    Texts that are null or without words link with nothing and stay; rows with the same id stay together.
    """
    gone = jaccard.join(docs, width=5, percent=80).filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Four fifths of the tokens, dealt to domains, languages and sources by weight; no document twice.

    Null languages and sources are leaves of their own; texts without words have no tokens and stay
    when the prefix reaches them.  Repeated rows go together.
    """
    mixed = mixing.mix(docs, fraction=0.8, max_epochs=1, domain_weights=mixing.DOMAINS, lang_weights=mixing.LANGS)
    return mixed.select(docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text (little-endian unsigned 32-bit), with digests of the ids and of the decoded text.

    One row per row; null and empty texts have no tokens.
    """
    vocabulary = public_tokenizers.path(VOCABULARY)
    encoded = bpe.decode(bpe.encode(docs, vocabulary).drop("text"), vocabulary)
    return encoded.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

#: SQL can't express the classifier or the encoding; see the brute-force test in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
