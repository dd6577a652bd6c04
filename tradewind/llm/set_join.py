"""Exact Jaccard join of shingle sets with index lists, block skipping and derived answers.

A document's set holds the hashes of its distinct k-word shingles, 3 unless given. Two sets of x and y members
are linked when their overlap o satisfies 100 * o >= percent * (x + y - o).

* Index lists. The members of every set are put in one global order, common shingles last. Two
  linked sets share at least three shingles within their first x - ceil(p * x) + 3 members, so
  lists are kept for those only, and a pair must meet in three lists. Each entry carries its
  position and the set's size.
* Block skipping. Within a list, entries are grouped into blocks by position and size. Two
  blocks whose positions leave too few members behind, or whose sizes are too far apart, are
  skipped as a whole; entries of the remaining blocks are tested one by one.
* Derived answers. Sets of one list are first compared with the list's first set only, which
  settles large groups of near copies in linear time. For a set y that is highly similar to
  such a hub h, the answers of h bound those of y: for every z,
  overlap(y, z) <= overlap(h, z) + |y without h|. Hubs are asked once for all their sets; blocks
  that the bound excludes are never laid out, and connected sets need no comparison.

Equal sets are one set from the start. Nothing is sampled or capped.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import components, ship, small_or_shuffled, stored

WORDS = 3
PERCENT = 90
# Shingles that are put last in the order: 8 bytes each, so the list that every task gets is
# at most 1 MB. A larger or smaller list changes the work, not the result.
COMMON = 131_072
# Members after which a task counts its shingles, and the least count worth reporting.
COUNT_MEMBERS = 2_000_000
COMMON_FROM = 8
WORD_CACHE = 200_000
# Lists in which a pair must meet. Different linked sets share at least p / (1 - p) members: nine
# at 90 %, four at 80 %, and this many at 75 % and above.
MEETINGS = 3
# Rounds in which lists are compared with their hub before all other pairs are.
HUB_ROUNDS = 2

ship(__name__)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    """Hashes of words, computed once while there is room."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < WORD_CACHE:
            self[word] = value
        return value


def shingle_set(text: bytes, hashes: WordHashes, k: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; of all words if there are fewer."""
    # bytes.lower() changes A-Z only; bytes.split() splits at U+0020 and U+0009 to U+000D.
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    width = min(k, len(found))
    value = _mix(each[: len(each) - width + 1] + np.uint64(width))
    for i in range(1, width):
        value = _mix(value * np.uint64(31) + each[i: len(each) - width + 1 + i])
    return np.unique(value)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[bytes]:
    for value in batch.column(column).cast(pa.binary()):
        yield value.as_py() or b""


def fingerprint(members: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(members.tobytes()) if len(members) else b""


def _counter(k: int):
    """(shingle, documents) of the shingles that a task sees twice or more in its stretch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = WordHashes(), [], 0

        def counted():
            value, count = np.unique(np.concatenate(held), return_counts=True)
            often = count > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(value[often].view(np.int64)), pa.array(count[often])], ["shingle", "n"])

        for batch in batches:
            for text in _texts(batch, 0):
                held.append(shingle_set(text, hashes, k))
                size += len(held[-1])
                if size >= COUNT_MEMBERS:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    return run


def common_shingles(docs: DataFrame, most: int = COMMON, k: int = WORDS) -> np.ndarray:
    """The most frequent shingles, rarest first: what the order puts last.

    Tasks report only shingles that repeat among their own documents, so little is shuffled;
    the counts are low estimates and decide the order only.
    """
    counts = docs.select("text").mapInArrow(_counter(k), "shingle long, n long")
    total = counts.groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON_FROM)
    top = total.orderBy(F.desc("n"), "shingle").limit(most).select("shingle").toArrow()
    return top["shingle"].to_numpy()[::-1].astype(np.int64).view(np.uint64)


def least_size(percent: int) -> int:
    """The least size of a set that can be linked with a different one: y / (y + 1) >= percent."""
    return -(-percent // (100 - percent)) if percent < 100 else 1 << 62


def prefix_length(size: int, percent: int = PERCENT) -> int:
    return min(size, size - -(-percent * size // 100) + MEETINGS)


def _prefixes(common: np.ndarray, percent: int, k: int):
    order = np.argsort(common, kind="stable")
    known, place = common[order], order

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, prints, prefixes = [], [], []
            for text in _texts(batch, 1):
                members = shingle_set(text, hashes, k)
                length = prefix_length(len(members), percent)
                if len(known) and len(members):
                    at = np.minimum(np.searchsorted(known, members), len(known) - 1)
                    late = known[at] == members
                    first = members[~late]
                    if len(first) < length:
                        last = members[late]
                        first = np.concatenate([first, last[np.argsort(place[at[late]], kind="stable")]])
                else:
                    first = members
                sizes.append(len(members))
                prints.append(fingerprint(members))
                prefixes.append(first[:length].view(np.int64))
            offsets = np.cumsum([0, *map(len, prefixes)])
            flat = np.concatenate(prefixes) if prefixes else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64()))],
                ["doc_id", "n_shingles", "print", "prefix"])

    return run


def _members(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [shingle_set(t, hashes, k) for t in _texts(batch, 1)]
            offsets = np.cumsum([0, *map(len, found)])
            flat = np.concatenate(found) if found else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([fingerprint(x) for x in found], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.view(np.int64)))],
                ["id", "print", "members"])

    return run


def needed(x: Column, y: Column, percent: int) -> Column:
    """The least overlap of two linked sets of these sizes."""
    return F.ceil(F.lit(percent) * (x + y) / F.lit(100 + percent))


def _possible(a: str, b: str, percent: int) -> Column:
    """Sizes and positions of a shared shingle leave room for enough overlap."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    rest = F.least(na - F.col(f"{a}.pos"), nb - F.col(f"{b}.pos"))
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (
        rest + (MEETINGS - 1) >= needed(na, nb, percent))


def _often_met(met: DataFrame, x: str, y: str) -> DataFrame:
    """Pairs (a, b) of ids that meet in enough lists."""
    pairs = met.select(F.greatest(f"{x}.id", f"{y}.id").alias("a"), F.least(f"{x}.id", f"{y}.id").alias("b"))
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("lists")).where(
        F.col("lists") >= MEETINGS).select("a", "b")


def hub_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """Every list's sets against the list's first set of another class, as (a, b)."""
    entry = F.struct("class", "id", "pos", "n")
    lists = entries.groupBy("shingle").agg(
        F.min(entry).alias("low"), F.max(entry).alias("high"),
    ).where("low.class <> high.class")
    met = entries.alias("e").join(lists.alias("l"), "shingle").select(
        F.struct("e.id", "e.pos", "e.n").alias("x"),
        F.when(F.col("e.class") != F.col("l.low.class"), F.col("l.low")).otherwise(F.col("l.high")).alias("y"))
    return _often_met(met.where(_possible("x", "y", percent)), "x", "y")


BLOCK = ["class", "hub", "size_block", "pos_block"]


def in_blocks(entries: DataFrame, hubs: DataFrame) -> DataFrame:
    """Entries of the lists that hold several classes, with their hub and their block."""
    several = entries.groupBy("shingle").agg(F.min("class").alias("l"), F.max("class").alias("h")).where("l <> h")
    placed = entries.join(several.select("shingle"), "shingle", "left_semi").join(hubs, "id", "left")
    # Blocks: a tenth in size, and a fiftieth of the size in position. A set without a hub is its own.
    return placed.select(
        "shingle", "id", "pos", "n", "class", F.coalesce("hub", "id").alias("hub"),
        F.coalesce("extra", F.lit(0)).alias("extra"),
        F.floor(F.log("n") / F.log(F.lit(1.1))).cast("int").alias("size_block"),
        F.floor(F.col("pos") * 50 / F.col("n")).cast("int").alias("pos_block"))


def block_meetings(blocked: DataFrame, percent: int) -> DataFrame:
    """Pairs of blocks of different classes in one list that are not skipped."""
    blocks = blocked.groupBy("shingle", *BLOCK).agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max("extra").alias("extra"),
        F.max(F.col("n") - F.col("pos")).alias("rest"))
    a, b = blocks.alias("a"), blocks.alias("b")
    met = a.join(b, F.expr("a.shingle = b.shingle and a.class < b.class")).where(
        (100 * F.least("a.most", "b.most") >= percent * F.greatest("a.least", "b.least"))
        & (F.least("a.rest", "b.rest") + (MEETINGS - 1) >= needed(F.col("a.least"), F.col("b.least"), percent)))
    return met.select(
        F.col("a.shingle").alias("shingle"),
        *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "ab" for c in [*BLOCK, "least", "extra"]])


def hub_questions(met: DataFrame) -> DataFrame:
    """Pairs (a, b) of hubs whose sets meet in enough lists, counted over all sets of either hub."""
    return met.groupBy(F.col("a_hub").alias("a"), F.col("b_hub").alias("b")).agg(
        F.count_distinct("shingle").alias("lists")).where(F.col("lists") >= MEETINGS).select("a", "b")


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, overlap, na, nb) of pairs of set ids, from the members themselves."""
    left = sets.select(F.col("id").alias("a"), F.col("members").alias("ma"))
    right = sets.select(F.col("id").alias("b"), F.col("members").alias("mb"))
    return pairs.join(left, "a").join(right, "b").select(
        "a", "b", F.size(F.array_intersect("ma", "mb")).cast("long").alias("overlap"),
        F.size("ma").cast("long").alias("na"), F.size("mb").cast("long").alias("nb"))


def linked(percent: int) -> Column:
    return 100 * F.col("overlap") >= percent * (F.col("na") + F.col("nb") - F.col("overlap"))


def hubs_of(known: DataFrame, percent: int) -> DataFrame:
    """(id, hub, extra): the linked set of smallest id with which a set was compared, and |set without hub|."""
    near = known.where(linked(percent)).select(
        F.col("a").alias("id"),
        F.struct(F.col("b").alias("hub"), (F.col("na") - F.col("overlap")).alias("extra")).alias("h"))
    return near.groupBy("id").agg(F.min("h").alias("h")).select("id", "h.hub", "h.extra")


def not_excluded(met: DataFrame, blocked: DataFrame, answers: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets that the answers of their hubs do not rule out.

    `answers` has the overlap of every asked pair of hubs. It bounds whole blocks first, so a
    large group of near copies is not laid out against sets that its hub excludes, and then
    the single sets of the blocks that are left.
    """
    of_hubs = answers.select(F.col("a").alias("a_hub"), F.col("b").alias("b_hub"), "overlap")
    left = met.join(of_hubs, ["a_hub", "b_hub"]).where(
        F.col("overlap") + F.col("a_extra") + F.col("b_extra")
        >= needed(F.col("a_least"), F.col("b_least"), percent)).drop("a_least", "a_extra", "b_least", "b_extra")

    def side(s: str) -> DataFrame:
        return blocked.select("shingle", *[F.col(c).alias(f"{s}_{c}") for c in BLOCK],
                              F.struct("id", "pos", "n", "extra").alias(s))

    pairs = left.join(side("a"), ["shingle", *[f"a_{c}" for c in BLOCK]])
    pairs = pairs.join(side("b"), ["shingle", *[f"b_{c}" for c in BLOCK]])
    return _often_met(pairs.where(
        _possible("a", "b", percent)
        & (F.col("overlap") + F.col("a.extra") + F.col("b.extra") >= needed(F.col("a.n"), F.col("b.n"), percent))),
        "a", "b")


def shingle_classes(docs: DataFrame, *, k: int = WORDS, percent: int = PERCENT, common: int = COMMON) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_shingles and component_id.

    component_id is the smallest doc_id that links reach, itself included. A null or empty text
    has no shingles and is linked with nothing. A null doc_id gets its n_shingles and a null
    component. Of rows that repeat a doc_id with different texts, the set with the smallest
    fingerprint stands for the document; all its rows share its component.
    """
    if not 75 <= percent <= 100:
        raise ValueError(f"linked sets share {MEETINGS} members at 75 to 100 percent only, not at {percent}")
    spark, docs = docs.sparkSession, docs.select("doc_id", "text")
    late = common_shingles(docs, common, k)
    prefixes = stored(docs.mapInArrow(
        _prefixes(late, percent, k), "doc_id long, n_shingles long, print binary, prefix array<long>"), "prefixes")
    chosen = prefixes.where("doc_id is not null and n_shingles > 0").groupBy("doc_id").agg(
        F.min("print").alias("print"))
    # Equal sets are one: the smallest doc_id stands for all.
    first = stored(chosen.groupBy("print").agg(F.min("doc_id").alias("id")), "sets")
    # Smaller sets are linked with equal ones only, which are one already.
    entries = prefixes.where(F.col("n_shingles") >= least_size(percent)).alias("p").join(
        first.alias("f"), F.expr("p.doc_id = f.id and p.print = f.print")
    ).select("f.id", F.col("n_shingles").alias("n"), "prefix").dropDuplicates(["id"])
    entries = entries.select("id", "n", F.posexplode("prefix").alias("pos", "shingle")).select(
        "id", "n", F.col("pos").cast("long").alias("pos"), "shingle")
    # A list of one set has nobody to meet.
    met = entries.groupBy("shingle").agg(F.min("id").alias("l"), F.max("id").alias("h")).where("l <> h")
    entries = stored(entries.join(met.select("shingle"), "shingle", "left_semi"), "entries")

    sets = spark.createDataFrame([], "id long, members array<long>")

    def with_sets_of(pairs: DataFrame) -> DataFrame:
        """The sets so far and those of the pairs' ids, made from their texts."""
        asked = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
        ids = stored(asked.join(sets.select("id"), "id", "left_anti").join(first, "id"), "ids")
        if not ids.limit(1).count():
            return sets
        ids = small_or_shuffled(ids)
        wanted = docs.join(ids.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
        made = wanted.mapInArrow(_members(k), "id long, print binary, members array<long>").join(
            ids, ["id", "print"], "left_semi").dropDuplicates(["id"])
        return sets.unionByName(stored(made.select("id", "members"), "members"))

    known = None
    labels = None
    for turn in range(HUB_ROUNDS + 1):
        classed = entries.withColumn("class", F.col("id")) if labels is None else entries.join(
            labels, F.expr("id = node"), "left").select(
                "id", "n", "pos", "shingle", F.coalesce("component", "id").alias("class"))
        if turn < HUB_ROUNDS:
            pairs = hub_pairs(classed, percent)
        else:
            blocked = stored(in_blocks(classed, hubs_of(known, percent)), "blocked")
            met = stored(block_meetings(blocked, percent), "met")
            asked = stored(hub_questions(met), "asked")
            sets = with_sets_of(asked)
            pairs = not_excluded(met, blocked, stored(overlaps(asked, sets), "hub-overlaps"), percent)
        if known is not None:
            pairs = pairs.join(known.select("a", "b"), ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        sets = with_sets_of(pairs)
        answers = stored(overlaps(pairs, sets), "overlaps")
        known = answers if known is None else known.unionByName(answers)
        # The components so far stand for the links found before.
        links = answers.where(linked(percent)).select("a", "b")
        if labels is not None:
            links = links.unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
        labels = components(links)

    of_set = first.join(labels, F.expr("id = node"), "left").select(
        F.col("print").alias("_print"), F.coalesce("component", "id").alias("component_id"))
    of_doc = chosen.join(of_set, F.expr("print = _print")).select(
        F.col("doc_id").alias("_id"), "component_id")
    return prefixes.join(of_doc, F.expr("doc_id = _id"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_per_class(docs: DataFrame, *, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Documents without those that are linked, directly or not, to one with a smaller doc_id.

    Columns as given. Rows that repeat the kept doc_id all stay, as do documents without words
    or without an id.
    """
    dropped = stored(
        shingle_classes(docs, k=k, percent=percent).where("doc_id <> component_id")
        .select(F.col("doc_id").alias("_dropped")).distinct(), "dropped")
    return docs.join(small_or_shuffled(dropped), F.expr("doc_id = _dropped"), "left_anti")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))) END AS g
  FROM w
), e AS (
  SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s
), o AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c
  FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
  GROUP BY ALL
), l AS (
  SELECT a, b FROM o WHERE 100 * c >= 90 * (na + nb - c)
  UNION ALL
  SELECT b, a FROM o WHERE 100 * c >= 90 * (na + nb - c)
), r AS (
  SELECT doc_id AS d, doc_id AS c FROM s
  UNION
  SELECT l.a, r.c FROM r JOIN l ON l.b = r.d
)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, min(c) AS component_id
FROM s JOIN r ON d = doc_id GROUP BY ALL
"""
