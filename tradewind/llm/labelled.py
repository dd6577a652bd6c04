"""Bounded, deterministic samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import stored


def remainder(modulus: int) -> Column:
    """crc32 of the doc_id as text, modulo; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, held_out: Column, per_class: int
) -> DataFrame:
    """(doc_id, text, label) of at most `per_class` labelled documents of each class.

    Rows of the held-out fold are never looked at. The choice is by hash of the id. At most
    2 * per_class ids are broadcast; repeated ids count once on either side.
    """
    usable = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out).groupBy("doc_id").agg(
            F.max("label").alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = stored(
        usable.where("label = 0").orderBy(*order).limit(per_class).unionByName(
            usable.where("label = 1").orderBy(*order).limit(per_class)), "chosen")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
