"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of shuffled documents. A document's virtual finish time is the
number of words its source has sent up to and including it, divided by the source's target;
queues that are replayed continue to count. Sorting all documents by finish time interleaves
the sources in proportion to their targets, and cutting the sequence at the total budget
leaves each source within about one document of its target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import stored, words

# Rows of a queue that one task sorts. The number of buckets follows from the row count.
BUCKET_ROWS = 20_000
FULL_HASH = 1 << 32


def shuffle_key(doc_id: Column, seed: str) -> Column:
    """A place in the shuffled queue that depends on the id and the seed only."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def bucket_of(key: Column, buckets: int) -> Column:
    """Equal ranges of the first 32 bits of the key, in key order."""
    head = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    return F.floor(head * F.lit(buckets) / F.lit(FULL_HASH)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, repeats: int) -> DataFrame:
    """Target per source from (source, source_size): shares by weight, none above its cap.

    Sorted by cap over weight, the capped sources come first; the first source whose share of
    what is left stays within its cap sets the level for all after it. One row per source, so
    the windows are small.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight_list = F.array(*[F.lit(int(w)) for w in weights])
    placed = sizes.withColumn("_n", F.row_number().over(by_name)).select(
        "source", "source_size", "_n",
        F.element_at(weight_list, ((F.col("_n") - 1) % len(weights) + 1).cast("int")).alias("_w"),
        (F.col("source_size") * F.lit(repeats)).alias("_cap"),
    )
    tight = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("_n"))
    before = tight.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    levelled = placed.select(
        "*",
        F.sum("source_size").over(every).alias("_all"),
        F.sum("_w").over(every).alias("_weights"),
        F.coalesce(F.sum("_cap").over(before), F.lit(0)).alias("_cap_before"),
        F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_w_before"),
    ).withColumn(
        "_level",
        (F.col("_all") * F.lit(float(share)) - F.col("_cap_before")) / (F.col("_weights") - F.col("_w_before")),
    )
    level = F.min(F.when(F.col("_level") <= F.col("_cap") / F.col("_w"), F.struct("_n_tight", "_level"))).over(every)
    return (
        levelled.withColumn("_n_tight", F.row_number().over(tight))
        .withColumn("_line", level.getField("_level"))
        .select(
            "source", "source_size",
            F.when(F.col("_line").isNull(), F.col("_cap").cast("double"))
            .otherwise(F.least(F.col("_cap").cast("double"), F.col("_line") * F.col("_w"))).alias("target"),
        )
    )


def fair_mix(
    sizes: DataFrame,
    *,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    repeats: int = 2,
    seed: str = "mix",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Per row of (doc_id, source, size): its source's size and target, and how often it is taken.

    `weights` repeat over the sources in code point order, null last; together the targets are
    `share` of all sizes and each at most `repeats` of its source. Returns doc_id, source, size,
    source_size, target, copies, taken = size * copies.

    A source may hold any share of the rows: a queue is cut into ranges of its shuffle key,
    each range is sorted by itself, and sums over ranges give the words before it. The global
    order by finish time is cut into ranges in the same way; the budget falls into one range,
    and the last document within it becomes a bound that every row is compared with. No row
    is dropped. Null sizes count 0; a null source is a source; an empty input gives no rows.
    Rows that repeat a doc_id lie next to each other in the queue and are counted separately.
    """
    queue = stored(sizes.select(
        "doc_id", "source", F.coalesce(F.col("size"), F.lit(0)).cast("long").alias("size"),
        shuffle_key(F.col("doc_id"), seed).alias("_key")), "queue")
    rows = queue.count()
    buckets = max(1, -(-rows // bucket_rows))
    queue = queue.withColumn("_bucket", bucket_of(F.col("_key"), buckets))

    per_bucket = queue.groupBy("source", "_bucket").agg(F.sum("size").alias("_words"))
    targets = source_targets(
        per_bucket.groupBy("source").agg(F.sum("_words").alias("source_size")), weights, share, repeats)
    earlier = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = per_bucket.select(
        "source", "_bucket", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_before"))
    ranges = ranges.alias("r").join(targets.alias("t"), F.expr("r.source <=> t.source")).select(
        F.col("r.source").alias("_source"), F.col("_bucket").alias("_range"), "_before", "source_size", "target")

    within = Window.partitionBy("source", "_bucket").orderBy("_key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, 0)
    sent = queue.withColumn("_sent", F.sum("size").over(within)).join(
        ranges, F.expr("source <=> _source and _bucket = _range"))
    timed = stored(sent.select(
        "doc_id", "source", "size", "source_size", "target", "_key",
        (F.col("_before") + F.col("_sent")).alias("_sent")), "finish")

    def finish(turn) -> Column:
        return F.when(F.col("target") > 0, (F.lit(turn) * F.col("source_size") + F.col("_sent")) / F.col("target"))

    turns = timed.select("*", F.explode(F.array(*[F.lit(t) for t in range(repeats)])).alias("_turn"))
    order = ["_finish", "_source_rank", "_key", "_turn"]
    # Null sources sort last here as well.
    ranked = turns.select(
        finish(F.col("_turn")).alias("_finish"), "_key", "_turn", "size",
        F.coalesce(F.concat(F.lit("0"), "source"), F.lit("1")).alias("_source_rank"),
    ).where("_finish is not null").withColumn("_slot", F.floor(F.col("_finish") * F.lit(buckets)).cast("long"))
    slots = ranked.groupBy("_slot").agg(F.sum("size").alias("_words"))
    budget = timed.groupBy("source").agg(F.first("target").alias("target")).agg(F.sum("target")).scalar()
    up_to = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    # One row per 20,000 documents; the slot in which the budget ends is one of them.
    last = (
        slots.withColumn("_before", F.coalesce(F.sum("_words").over(up_to), F.lit(0)))
        .where(F.col("_before") <= budget).orderBy(F.desc("_slot")).limit(1)
    )
    running = Window.partitionBy("_slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    bound = (
        ranked.join(F.broadcast(last), "_slot")
        .withColumn("_total", F.col("_before") + F.sum("size").over(running))
        .where(F.col("_total") <= budget).orderBy(*[F.desc(c) for c in order]).limit(1).collect()
    )
    first_slot = last.collect()
    if bound:
        end = [bound[0][c] for c in order]
    elif first_slot:
        # The first document of the slot no longer fits: all earlier slots are taken.
        end = [first_slot[0]["_slot"] / buckets, "", "", -1]
    else:
        end = [-1.0, "", "", -1]
    rank = F.coalesce(F.concat(F.lit("0"), "source"), F.lit("1"))
    bound_row = F.struct(*[F.lit(v).alias(f"c{i}") for i, v in enumerate(end)])
    copies = sum(
        (F.when(F.struct(finish(t).alias("c0"), rank.alias("c1"), F.col("_key").alias("c2"),
                         F.lit(t).alias("c3")) <= bound_row, 1).otherwise(0) for t in range(repeats)),
        F.lit(0),
    )
    copies = F.when(F.col("target") > 0, copies).otherwise(0)
    return timed.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (F.col("size") * copies).cast("long").alias("taken"))


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size in words) of documents."""
    return docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """Documents as often as the mix takes them, with their own columns only.

    Rows are matched to their decision by doc_id, null included; rows that repeat a doc_id are
    taken as often as the first of them.
    """
    chosen = fair_mix(document_sizes(docs), **options).groupBy(F.col("doc_id").alias("_mix_id")).agg(
        F.max("copies").alias("_mix_copies"))
    own = [F.col(f"d.`{c}`") for c in docs.columns]
    return (
        docs.alias("d").join(chosen.where("_mix_copies > 0"), F.expr("d.doc_id <=> _mix_id"))
        .withColumn("_mix_turn", F.explode(F.sequence(F.lit(1), F.col("_mix_copies"))))
        .select(*own)
    )
