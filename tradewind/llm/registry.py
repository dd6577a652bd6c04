"""The text operators as queries over a folder of sample tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import (
    archives, decontaminate, merkle, mixing, mixing_sql, passages, private, quality_rules, secrets, set_join, sketches, token_files,
    toxicity, whitening,
)
from tradewind.llm.common import table
from tradewind.llm.spans import digest_columns

Query = Callable[[SparkSession, str], DataFrame]


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    return digest_columns(secrets.find_secrets(docs), secrets.KINDS)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.shingle_classes(table(spark, sf_dir, "documents", ["doc_id", "text"]))


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    return token_files.tokens_of(docs, tokenizer_file()).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.archive_pages(table(spark, sf_dir, "pages", ["page_id", "url", "html"]))


def op6_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    return digest_columns(private.find_private(docs), private.KINDS)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(
        table(spark, sf_dir, "documents", ["doc_id", "text"]), table(spark, sf_dir, "labels", ["doc_id", "toxic"]))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(
        table(spark, sf_dir, "documents", ["doc_id", "text"]), table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def op9_passage_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.quality(
        table(spark, sf_dir, "documents", ["doc_id", "text"]), table(spark, sf_dir, "labels", ["doc_id", "quality"]))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "source", "text"])
    return mixing.fair_mix(mixing.document_sizes(docs)).select(
        "doc_id", "size", "source_size", "target", "taken")


def op11_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.near_classes(table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", list(merkle.FIELDS))
    return merkle.audited(docs, claim=merkle.tampered())


def llm_queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_secrets, op2_jaccard_join, op3_token_files, op4_quality_rules, op5_warc, op6_private_data, op7_toxicity, op8_decontaminate,
        op9_passage_quality, op10_mix_sources, op11_near_duplicates, op12_whitening, op13_merkle)}


def llm_oracles() -> dict[str, str]:
    return {
        "op2_jaccard_join": set_join.ORACLE, "op4_quality_rules": quality_rules.ORACLE, "op5_warc": archives.ORACLE,
        "op8_decontaminate": decontaminate.oracle(), "op10_mix_sources": mixing_sql.ORACLE,
        "op11_near_duplicates": sketches.oracle(), "op13_merkle": merkle.ORACLE,
    }
