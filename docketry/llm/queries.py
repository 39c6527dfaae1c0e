"""The registered queries of this subpackage, one or more modules' worth of thin wrappers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, fim, lines, mixing, topk, vectorcodes


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from . import bpe

    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    encoded = bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary).drop("text")
    return bpe.decode(encoded, vocabulary).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import kneserney
    from .labelled import fold

    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(fold("doc_id", 7) == 2, F.lit(False))
    scored = kneserney.score(documents, kneserney.train(documents.filter(~held_out), order=3))
    return scored.withColumn("held_out", held_out)


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(_table(spark, sf_dir, "conversations"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality

    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.classify(documents, _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity

    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.classify(documents, _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import jaccard

    return jaccard.join(_table(spark, sf_dir, "documents").select("doc_id", "text"), width=4, percent=85)


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0, k=20)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.md5("text").alias("text_md5"))


def op9_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import lattice

    return lattice.dedup(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), threshold=0.93)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    mixed = mixing.mix(documents, domain_weights=mixing.DOMAINS, lang_weights=mixing.LANGS)
    return mixed.select("doc_id", "domain", "lang", "source", "epochs")


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import fim

    arranged = fim.fill_in_middle(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return fim.restore(arranged).select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("fim", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from . import tokencounts

    counted = tokencounts.count_tokens(_table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import vectorcodes

    codes = vectorcodes.compress(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return vectorcodes.with_label_errors(codes.rows).select("vec_id", "code", "error", "label_error", F.lit(codes.sha256).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_toxicity": op5_toxicity,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_topk": op7_topk,
    "op8_line_dedup": op8_line_dedup,
    "op9_lattice_dedup": op9_lattice_dedup,
    "op10_mixing": op10_mixing,
    "op11_fim": op11_fim,
    "op12_token_counts": op12_token_counts,
    "op13_vector_codes": op13_vector_codes,
}

SQL: dict[str, str] = {"op3_chat_formatting": chat.SQL, "op7_topk": topk.SQL, "op8_line_dedup": lines.SQL, "op10_mixing": mixing.SQL, "op11_fim": fim.SQL, "op13_vector_codes": vectorcodes.SQL}
