"""From raw documents to token files: five stages over the text operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's documents. All stages but the last keep the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradewind.llm.common import stored, table
from tradewind.llm.decontaminate import without_leaks
from tradewind.llm.mixing import mix_documents
from tradewind.llm.quality_rules import keep_good
from tradewind.llm.registry import tokenizer_file
from tradewind.llm.set_join import one_per_class
from tradewind.llm.token_files import tokens_of

# Near copies of the stage: sets of five-word shingles that are equal to 80 %. The query op2 has its own.
NEAR_WORDS, NEAR_PERCENT = 5, 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near-equal shingle sets, the one with the smallest id stays."""
    return one_per_class(docs, k=NEAR_WORDS, percent=NEAR_PERCENT)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mix_documents(docs)


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; returns their index."""
    return tokens_of(docs, tokenizer_file()).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", good_documents),
    ("jaccard_join", one_of_each),
    ("decontamination", not_in_benchmark),
    ("mixing", mixed),
    ("token_files", token_records),
]

# A tokenizer cannot be expressed in SQL; the tests hold run() against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage before it goes through stored Parquet."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def pipeline_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def pipeline_oracles() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
