"""Near-duplicate classes from bottom-k sketches of one hash function.

A document's set holds 64-bit hashes of its distinct word shingles; its sketch is the `keep`
smallest of them. A set of at most `keep` members is its own sketch.

* Inverted lists. The values that sketches retain lead to the sets that retain them. Values are put
  in one global order, rare ones first. Two linked sets share so many retained values that they
  must share one among the first few of each; only those enter the lists, and a set enters
  with fewer of them for partners of its size or larger than for smaller ones. For whole sets that
  is exact; for truncated ones a linked pair fails with a probability below RISK.
* Union sketch. The `keep` smallest values of two sketches together are the sketch of the union; the
  share of them that both sets hold estimates the similarity. A pair goes on unless a linked
  one would show so few with a probability below RISK. Of two whole sets it is the similarity itself.
* Marks. Before sketches are sent to a pair, 256 bits a set tell most pairs apart. Of whole sets they are the
  parities of the members that fall to each of 256 slots, in which two sets differ in no more
  bits than members: exact. Of truncated sets they are one bit of each slot's smallest member; a
  linked pair differs in too many of them with a probability below RISK.
* Exact check. Pairs with a truncated set that pass are compared on the full sets, made again from
  the texts of those documents only.
* Groups. Equal sets are one from the start. The sets of a list are first compared with one of
  them, its centre, which joins large groups of near copies in linear time; after that only
  pairs whose members are not yet connected are made, in portions of a hot list, without
  the centres. A pair that meets in many lists is made in the first of them if that is
  among the LEAD first open lists of both.

Nothing is sampled or capped. Texts that differ little from one another but are not linked, in
very large numbers, still meet in pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import components, discard, ship, small_or_shuffled, stored
from tradewind.llm.set_join import WordHashes, fingerprint, least_size, shingle_set

WORDS, PERCENT, KEEP = 4, 80, 512
# Chance with which a linked pair of truncated sets may escape one of the three bounds.
RISK = 1e-9
# Bits of a set's marks, and open lists of a set that its entries name.
MARKS, LEAD = 256, 8
# Values put last in the order (8 bytes each in every task); the list changes the work, not the result.
FREQUENT, FREQUENT_FROM, COUNTED = 131_072, 8, 2_000_000
# Rounds against a list's centre, and entries of a list, or pairs of a set, that one task takes at once.
CENTRE_ROUNDS, PORTION = 2, 2_000
# Sets that a Python worker makes sketches or list entries of at once.
BATCH_ROWS = 1_000

ship(__name__)


@lru_cache(maxsize=None)
def fewest(n: int, keep: int, percent: int, risk: float = RISK) -> int:
    """Shared retained values below which a set of n members and a linked partner fall with a chance under `risk`.

    Of a union of u members at least `percent` are shared, and its `keep` smallest are a draw
    without replacement. The union has at most 100 * n / percent members, which spreads most.
    """
    union = max(keep, 100 * n // percent)
    shared = -(-percent * union // 100)

    def log_choose(a: int, b: int) -> float:
        return math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)

    total = 0.0
    for hits in range(max(0, keep - union + shared), min(keep, shared) + 1):
        total += math.exp(log_choose(shared, hits) + log_choose(union - shared, keep - hits) - log_choose(union, keep))
        if total >= risk:
            # One less, since a smaller union rounds otherwise.
            return max(1, hits - 1)
    return 1


def most_apart(percent: int, risk: float = RISK) -> int:
    """Marks in which a linked pair of truncated sets differs, at most but for a chance under `risk`.

    The smallest members of the slots are a draw from the union. One that is not shared, at most
    100 - percent of a hundred, shows in half the cases.
    """
    p = (100 - percent) / 200
    total = 0.0
    for apart in range(MARKS, 0, -1):
        total += math.comb(MARKS, apart) * p ** apart * (1 - p) ** (MARKS - apart)
        if total >= risk:
            return apart
    return 0


def entry_lengths(n: int, keep: int, percent: int) -> tuple[int, int]:
    """(longer, shorter): values of a set's sketch to look up smaller partners by, and larger ones."""
    if 100 * n // percent <= keep:
        return n + percent * n // -100 + 1, n + 2 * percent * n // -(100 + percent) + 1
    length = min(n, keep) - fewest(n, keep, percent) + 1
    return length, length


def listed_lengths(n: int, keep: int, percent: int) -> tuple[int, int]:
    """(longer, shorter) for partners of any size: a set of up to `keep` members can meet truncated and whole ones."""
    longer, shorter = entry_lengths(n, keep, percent)
    if n <= keep:
        longer, shorter = max(longer, n + percent * n // -100 + 1), max(shorter, n + 2 * percent * n // -(100 + percent) + 1)
    return longer, shorter


def _portions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of batches, since a sketch takes more room than most texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def marks(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parities, lows) of ascending members, packed: see the module's text."""
    slot = (members % np.uint64(MARKS)).astype(np.intp)
    least = np.zeros(MARKS, np.uint64)
    # Of several members of a slot the last one stays, which is the smallest.
    least[slot[::-1]] = members[::-1]
    odd = np.bincount(slot, minlength=MARKS) % 2
    return tuple(np.packbits(x.astype(bool)).view(np.int64) for x in (odd, least // np.uint64(MARKS) % np.uint64(2)))


def _sketcher(k: int, keep: int, percent: int):
    half = np.uint64(1 << 63)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in _portions(batches):
            sizes, hits, prints, kept, odd, low = [], [], [], [], [], []
            for value in batch.column(1).cast(pa.binary()):
                members = shingle_set(value.as_py() or b"", hashes, k)
                # Ascending as signed numbers, as Spark compares them.
                turn = int(np.searchsorted(members, half))
                signed = np.concatenate([members[turn: turn + keep], members[: min(turn, keep)]])[:keep]
                sizes.append(len(members))
                hits.append(fewest(len(members), keep, percent))
                prints.append(fingerprint(members))
                kept.append(signed.view(np.int64))
                for column, bits in zip((odd, low), marks(members)):
                    column.append(bits)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(hits, pa.int64()), pa.array(prints, pa.binary()), _lists(kept), _lists(odd),
                 _lists(low)],
                ["doc_id", "n_shingles", "hits", "print", "sketch", "odd", "low"])

    return run


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64()))


def _repeated(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(value, n) of values that a stretch of sketches holds more than once."""
    held, size = [], 0

    def counted():
        value, count = np.unique(np.concatenate(held), return_counts=True)
        often = count > 1
        return pa.RecordBatch.from_arrays([pa.array(value[often]), pa.array(count[often])], ["value", "n"])

    for batch in batches:
        held.append(batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64))
        size += len(held[-1])
        if size >= COUNTED:
            yield counted()
            held, size = [], 0
    if held:
        yield counted()


def frequent_values(sets: DataFrame, most: int = FREQUENT) -> np.ndarray:
    """Values that many sketches hold, rarest first; the counts are low estimates that only decide an order."""
    counts = sets.select("sketch").mapInArrow(_repeated, "value long, n long")
    total = counts.groupBy("value").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT_FROM)
    top = total.orderBy(F.desc("n"), "value").limit(most).select("value").toArrow()
    return top["value"].to_numpy()[::-1].astype(np.int64)


def _entries(frequent: np.ndarray, keep: int, percent: int):
    order = np.argsort(frequent, kind="stable")
    known = frequent[order]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            shorter, first = [], []
            for n, values in zip(batch.column(1).to_pylist(), batch.column(3)):
                values = values.values.to_numpy()
                longer, short = listed_lengths(n, keep, percent)
                if len(known):
                    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
                    late = known[at] == values
                    if len(values) - np.count_nonzero(late) < longer:
                        values = np.concatenate([values[~late], values[late][np.argsort(order[at[late]], kind="stable")]])
                    else:
                        values = values[~late]
                first.append(values[:longer])
                shorter.append(short)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shorter, pa.int64()), batch.column(2), _lists(first)],
                ["id", "n", "shorter", "hits", "first"])

    return run


LISTED = "id long, n long, shorter long, hits long, first array<long>"


def _full(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for i, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                members = shingle_set(value.as_py() or b"", hashes, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int64()), pa.array([fingerprint(members)], pa.binary()), _lists([members.view(np.int64)])],
                    ["id", "print", "members"])

    return run


def _sizes_agree(x: Column, y: Column, percent: int) -> Column:
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def _centre(entry: Column, turn: int) -> Column:
    """The centre of a list: the smallest id at first, so that lists agree on it, and later one by
    hash, so that they differ and a set meets many."""
    return F.min_by(entry, F.xxhash64("id", "value", F.lit(turn))) if turn else F.min_by(entry, "id")


def centre_pairs(entries: DataFrame, percent: int, turn: int) -> DataFrame:
    """(a, b): the sets of every list with its centre."""
    lists = entries.groupBy("value").agg(_centre(F.struct("id", "n", "class"), turn).alias("c"))
    met = entries.join(lists, "value").where((F.col("class") != F.col("c.class")) & _sizes_agree(F.col("n"), F.col("c.n"), percent))
    return met.select(F.greatest("id", "c.id").alias("a"), F.least("id", "c.id").alias("b")).distinct()


def _enough(x: str, y: str, keep: int, percent: int) -> tuple[Column, Column]:
    """(whole, least): whether both sets are their own sketches, and the least shared values of a linked pair."""
    nx, ny = F.col(f"{x}n"), F.col(f"{y}n")
    whole = F.greatest(nx, ny) <= keep
    return whole, F.when(whole, F.ceil(F.lit(percent) * (nx + ny) / F.lit(100 + percent))).otherwise(
        F.greatest(F.col(f"{x}hits"), F.col(f"{y}hits")))


def open_lists(entries: DataFrame) -> DataFrame:
    """Entries of lists that hold several classes, without the lists' centres, which have met all others.

    `lead` has the first few values of the set that are left, in the order of all values.
    """
    centres = [F.col(f"c{turn}") for turn in range(CENTRE_ROUNDS)]
    lists = entries.groupBy("value").agg(
        F.min("class").alias("low"), F.max("class").alias("high"), F.ceil(F.count(F.lit(1)) / PORTION).alias("portions"),
        *[_centre(F.col("id"), turn).alias(f"c{turn}") for turn in range(CENTRE_ROUNDS)]).where("low <> high").drop("low", "high")
    left = entries.join(lists, "value").where(~F.col("id").isin(*centres)).drop("c0", "c1")
    held = left.groupBy("id", "n", "shorter", "hits", "class").agg(
        F.sort_array(F.collect_list(F.struct("pos", "value", "portions"))).alias("held"))
    return held.select(
        "id", "n", "shorter", "hits", "class", F.slice("held.value", 1, LEAD).alias("lead"), F.explode("held").alias("e")).select(
            "id", "n", "shorter", "hits", "class", "lead", "e.*")


def open_pairs(entries: DataFrame, keep: int, percent: int) -> DataFrame:
    """(a, b): sets of different classes that meet with enough values left to be linked, after all rounds with centres.

    The larger set looks smaller ones up by its longer stretch, which meets their shorter one. A
    list is cut into portions by the looking set, each of which meets all shorter entries. Where
    the leads of two sets share a value, only the first such list makes the pair.
    """
    shared = stored(open_lists(entries), "open")
    looking = shared.withColumn("portion", F.pmod(F.xxhash64("id"), F.col("portions")))
    found = shared.where("pos < shorter").withColumn("portion", F.explode(F.sequence(F.lit(0).cast("long"), F.col("portions") - 1)))
    x, y = looking.alias("x"), found.alias("y")
    nx, ny = F.col("x.n"), F.col("y.n")
    # The first value that two linked sets share leaves room for the others behind it.
    rest = F.least(F.least(nx, F.lit(keep)) - F.col("x.pos"), F.least(ny, F.lit(keep)) - F.col("y.pos"))
    _, enough = _enough("x.", "y.", keep, percent)
    first = F.get(F.array_intersect("x.lead", "y.lead"), F.lit(0))
    met = x.join(y, F.expr("x.value = y.value and x.portion = y.portion and x.class <> y.class and (y.n < x.n or y.n = x.n and y.id < x.id)")).where(
        (100 * ny >= percent * nx) & (rest >= enough) & (F.coalesce(first, F.col("x.value")) == F.col("x.value")))
    return met.select(F.greatest("x.id", "y.id").alias("a"), F.least("x.id", "y.id").alias("b")).distinct()


def with_both(pairs: DataFrame, sets: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (a, b) with the columns of both sets, as a_* and b_*.

    A set in more pairs than a portion (a centre) is repeated, and its pairs are spread by the other
    set. Only sets of a pair are shuffled.
    """
    given = pairs
    for side, other in (("a", "b"), ("b", "a")):
        load = given.groupBy(side).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > PORTION)
        hot = stored(load.select(F.col(side).alias("_id"), F.ceil(F.col("_n") / PORTION).alias("_copies")), "hot")
        spread = F.coalesce("_copies", F.lit(1).cast("long"))
        small = small_or_shuffled(hot)
        pairs = pairs.join(small, F.col(side) == F.col("_id"), "left").withColumn(
            "_salt", F.pmod(F.xxhash64(other), spread)).drop("_id", "_copies")
        ids = stored(given.select(F.col(side).alias("id")).distinct(), "asked")
        copies = sets.join(small_or_shuffled(ids), "id", "left_semi").join(small, F.col("id") == F.col("_id"), "left").select(
            F.col("id").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns],
            F.explode(F.sequence(F.lit(0).cast("long"), spread - 1)).alias("_salt"))
        pairs = pairs.join(copies, [side, "_salt"]).drop("_salt")
    return pairs


def not_apart(pairs: DataFrame, sets: DataFrame, keep: int, percent: int) -> DataFrame:
    """(a, b) of pairs whose marks do not rule a link out."""
    both = with_both(pairs, sets, ["n", "hits", "odd", "low"])

    def apart(column: str) -> Column:
        x, y = F.col(f"a_{column}"), F.col(f"b_{column}")
        return sum((F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(MARKS // 64)), F.lit(0))

    whole, enough = _enough("a_", "b_", keep, percent)
    near = F.when(whole, apart("odd") <= F.col("a_n") + F.col("b_n") - 2 * enough).otherwise(apart("low") <= most_apart(percent))
    return both.where(near).select("a", "b")


def estimated(pairs: DataFrame, sets: DataFrame, keep: int, percent: int) -> DataFrame:
    """(a, b, certain) of pairs whose union sketch does not rule a link out; certain: it is the whole union."""
    both = with_both(pairs, sets, ["n", "hits", "sketch"])
    shared = F.array_intersect("a_sketch", "b_sketch")
    whole, enough = _enough("a_", "b_", keep, percent)
    union = F.slice(F.sort_array(F.array_union("a_sketch", "b_sketch")), 1, keep)
    hits = F.when(whole, F.size(shared)).otherwise(F.size(F.array_intersect(union, shared)))
    return both.where(hits >= enough).select("a", "b", whole.alias("certain"))


def near_classes(docs: DataFrame, *, k: int = WORDS, percent: int = PERCENT, keep: int = KEEP) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_shingles, component_id and kept.

    component_id is the smallest doc_id that links reach, itself included; kept says that it is
    the row's own. A null or empty text has no shingles and is linked with nothing. A null doc_id
    has a null component and is kept. Of rows that repeat a doc_id with different texts, the set
    with the smallest fingerprint stands for the document; all its rows share its component.
    """
    spark, docs = docs.sparkSession, docs.select("doc_id", "text")
    sketched = stored(docs.mapInArrow(
        _sketcher(k, keep, percent), "doc_id long, n_shingles long, hits long, print binary, sketch array<long>, odd array<long>, low array<long>"),
        "sketches")
    named = stored(sketched.select("doc_id", "n_shingles", "print"), "named")
    chosen = named.where("doc_id is not null and n_shingles > 0").groupBy("doc_id").agg(F.min("print").alias("print"))
    # Equal sets are one: the smallest doc_id stands for all.
    first = stored(chosen.groupBy("print").agg(F.min("doc_id").alias("id")), "prints")
    # Prints are compared as bounds, so that the join is by id alone and its shuffle serves the next step too.
    sets = stored(sketched.where(F.col("n_shingles") >= least_size(percent)).alias("s").join(
        first.alias("f"), F.expr("s.doc_id = f.id and s.print >= f.print and s.print <= f.print")).select(
            "f.id", F.col("n_shingles").alias("n"), "hits", "sketch", "odd", "low").dropDuplicates(["id"]), "sets")
    discard(sketched)

    listed = sets.select("id", "n", "hits", "sketch").mapInArrow(
        _entries(frequent_values(sets), keep, percent), LISTED)
    entries = listed.select("id", "n", "shorter", "hits", F.posexplode("first").alias("pos", "value"))
    # A list of one set has nobody to meet.
    met = entries.groupBy("value").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("value")
    entries = stored(entries.join(met, "value", "left_semi"), "entries")

    known = spark.createDataFrame([], "a long, b long")
    full = spark.createDataFrame([], "id long, members array<long>")
    labels = None
    for turn in range(CENTRE_ROUNDS + 1):
        classed = entries.withColumn("class", F.col("id")) if labels is None else entries.join(
            labels, F.expr("id = node"), "left").withColumn("class", F.coalesce("component", "id"))
        pairs = centre_pairs(classed, percent, turn) if turn < CENTRE_ROUNDS else open_pairs(classed, keep, percent)
        if turn:
            pairs = pairs.join(known, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        known = known.unionByName(pairs)
        near = stored(not_apart(pairs, sets, keep, percent), "near")
        passed = stored(estimated(near, sets, keep, percent), "passed")
        unsure = passed.where("not certain").select("a", "b")
        asked = unsure.select(F.col("a").alias("id")).unionByName(unsure.select(F.col("b").alias("id"))).distinct()
        ids = stored(asked.join(full.select("id"), "id", "left_anti").join(first, "id"), "ids")
        if ids.limit(1).count():
            small = small_or_shuffled(ids)
            wanted = docs.join(small.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
            made = wanted.mapInArrow(_full(k), "id long, print binary, members array<long>").join(
                small, ["id", "print"], "left_semi").dropDuplicates(["id"])
            full = full.unionByName(stored(made.select("id", "members"), "full"))
        both = with_both(unsure, full, ["members"])
        overlap = F.size(F.array_intersect("a_members", "b_members"))
        sure = both.where(100 * overlap >= percent * (F.size("a_members") + F.size("b_members") - overlap)).select("a", "b")
        links = passed.where("certain").select("a", "b").unionByName(sure)
        if labels is not None:
            links = links.unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
        labels = components(links)

    of_set = first.join(labels, F.expr("id = node"), "left").select(
        F.col("print").alias("_print"), F.coalesce("component", "id").alias("component_id"))
    of_doc = chosen.join(of_set, F.expr("print = _print")).select(F.col("doc_id").alias("_id"), "component_id")
    component = F.coalesce("component_id", "doc_id")
    return named.select("doc_id", "n_shingles").join(of_doc, F.expr("doc_id = _id"), "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def oracle(words: int = WORDS, percent: int = PERCENT) -> str:
    """The same classes in SQL, by counting shared shingles of all pairs that share one."""
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {words} THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - {words - 2}), lambda i: array_to_string(ws[i:i + {words - 1}], ' '))) END AS g
  FROM w
), e AS (
  SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s
), o AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c
  FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
  GROUP BY ALL
), l AS (
  SELECT a, b FROM o WHERE 100 * c >= {percent} * (na + nb - c)
  UNION ALL
  SELECT b, a FROM o WHERE 100 * c >= {percent} * (na + nb - c)
), r AS (
  SELECT doc_id AS d, doc_id AS c FROM s
  UNION
  SELECT l.a, r.c FROM r JOIN l ON l.b = r.d
)
SELECT *, doc_id = component_id AS kept FROM (
  SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, min(c) AS component_id FROM s JOIN r ON d = doc_id GROUP BY ALL)
"""
