"""Benchmark decontamination by template windows, in built-in functions only.

Texts become templates: numbers, the units after them, and names are replaced by a mark of
their type, the rest is lower-cased without punctuation. A window of five template words that
an item and a document share is found by a hash join. For each item, document and alignment
(distance of the two places), the values that stood where the marks are must correspond: the
same value of the item always to the same value of the document. Where they conflict, the value
of the document at most places stands for the item's value, and only windows that hold another
one are dropped. That keeps questions whose parameters were exchanged, and drops windows that
agree by their form only. Items that are shorter than a window, or have windows with too few plain
words for a template, are also compared word by word with their values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import once, small_or_shuffled, stored, words

WINDOW = 5
# Windows need at least so many plain words.
MIN_PLAIN = 3
# Share of an item's windows that a document must hold.
COVERAGE = 0.5
# Private-use characters that texts do not contain; the value follows the mark.
NUMBER, NAME, UNIT = "\ue000", "\ue001", "\ue002"
UNITS = (
    "km cm mm m kg mg g lb lbs oz l ml miles mile feet foot ft inches inch in yards hours hour h minutes minute min "
    "seconds second s days day weeks week months month years year percent dollars dollar usd euros euro eur cents degrees"
).split()
PUNCTUATION = ".,;:!?\"'()[]"


def marked_words(text: Column) -> Column:
    """Template words of a text, each marked one followed by its value."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), r"([\p{Ll}0-9,;] )(\p{Lu}\p{L}*)", f"$1{NAME}$2")
    digits = F.regexp_replace(out, r"[0-9][0-9.,:/]*", f"{NUMBER}$0")
    units = F.regexp_replace(digits, rf"({NUMBER}[0-9.,:/]+ ?)({'|'.join(UNITS)})\b", f"$1 {UNIT}$2")
    out = F.lower(F.when(text.rlike("[0-9]"), units).otherwise(out))
    for mark in PUNCTUATION:
        out = F.replace(out, F.lit(mark), F.lit(""))
    return words(out)


def _is_slot(word: Column) -> Column:
    return word.startswith(NUMBER) | word.startswith(NAME) | word.startswith(UNIT)


def _exact_hash(words_: Column, i: Column, length: Column | int) -> Column:
    """Hash of words with their values. The marks go: whether a name gets one depends on what stands before it."""
    return F.xxhash64(F.lit("exact"), F.transform(
        F.slice(words_, i + 1, length), lambda w: F.when(_is_slot(w), F.substr(w, F.lit(2))).otherwise(w)))


def windows(frame: DataFrame, key: str, exact: Sequence[int] = ()) -> DataFrame:
    """(key, hash, place, slots): template windows; slots are the window's words if any is marked.

    For each length in `exact`, all windows of so many words with their values follow, without slots.
    """
    frame = once(frame.select(key, "text"), _marked=marked_words(F.col("text"))).select(key, "_marked")
    frame = once(frame, _slotted=F.transform("_marked", _is_slot))
    frame = once(frame, _template=F.transform(
        "_marked", lambda w, i: F.when(F.get("_slotted", i), F.substring(w, 1, 1)).otherwise(w)),
        _any=F.array_contains("_slotted", True))
    size = F.size("_template")
    starts = F.when(size >= WINDOW, F.sequence(F.lit(0), size - WINDOW)).otherwise(F.array().cast("array<int>"))

    def window(i: Column) -> Column:
        hashed = F.xxhash64(*[F.get("_template", i + k) for k in range(WINDOW)])
        slots = F.when(F.col("_any"), F.slice("_marked", i + 1, WINDOW))
        return F.struct(hashed.alias("hash"), i.alias("place"), F.when(F.exists(slots, _is_slot), slots).alias("slots"))

    def exact_windows_of(n: int) -> Column:
        at = F.when(size >= n, F.sequence(F.lit(0), size - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.struct(
            _exact_hash(F.col("_marked"), i, n).alias("hash"), i.alias("place"),
            F.lit(None).cast("array<string>").alias("slots")))

    found = F.transform(starts, window)
    if exact:
        found = F.concat(found, *[exact_windows_of(n) for n in exact])
    return frame.select(key, F.inline(found))


def exact_windows(items: DataFrame) -> DataFrame:
    """(item_id, hash, place, length) of items that templates do not cover, all windows with their values.

    These are the items of under five words, as one window, and those with a window of too few plain words.
    """
    frame = once(items.select("item_id", "text"), _marked=marked_words(F.col("text"))).where(F.size("_marked") > 0)
    length, size = F.least(F.size("_marked"), F.lit(WINDOW)), F.size("_marked")
    frame = once(frame, _starts=F.sequence(F.lit(0), size - length))
    few = F.exists("_starts", lambda i: WINDOW - F.size(F.filter(F.slice("_marked", i + 1, WINDOW), _is_slot)) < MIN_PLAIN)
    return frame.where((size < WINDOW) | few).select("item_id", length.alias("length"), F.inline(F.transform(
        "_starts", lambda i: F.struct(_exact_hash(F.col("_marked"), i, length).alias("hash"), i.alias("place")))))


def benchmark_windows(items: DataFrame) -> DataFrame:
    """(item_id, hash, place, slots, n_windows, length, n_exact) of all items with words.

    Rows of template windows have no length, those of exact ones have one. n_windows and n_exact
    count the item's windows of either kind.
    """
    found = windows(items.select("item_id", "text"), "item_id")
    plain = F.size(F.filter(F.coalesce("slots", F.array().cast("array<string>")), _is_slot))
    found = found.where(WINDOW - plain >= MIN_PLAIN).withColumn("length", F.lit(None).cast("int")).unionByName(
        exact_windows(items).withColumn("slots", F.lit(None).cast("array<string>")))
    sizes = found.groupBy(F.col("item_id").alias("_item")).agg(
        F.count_distinct(F.when(F.col("length").isNull(), F.col("place"))).alias("n_windows"),
        F.count_distinct(F.when(F.col("length").isNotNull(), F.col("place"))).alias("n_exact"))
    return found.join(sizes, F.expr("item_id <=> _item")).drop("_item")


def consistent_windows(aligned: DataFrame) -> DataFrame:
    """Alignments with their `exact` places, with `places` of their windows without a conflicting value, and with those windows' `values`.

    An item's value stands for the document's value at most places of the alignment, of equally
    frequent ones for the smallest. Windows without slots (`free`) always count.
    """
    aligned = aligned.withColumn("pairs", F.array_distinct(F.flatten(F.col("slotted.pairs"))))
    aligned = aligned.withColumn("values", F.array_distinct(F.transform("pairs", lambda p: p.dropFields("at"))))
    agrees = F.size(F.array_distinct(F.col("values.item"))) == F.size("values")

    def places_of(v: Column) -> Column:
        return F.size(F.filter("pairs", lambda p: (p.getField("item") == v.getField("item")) & (p.getField("doc") == v.getField("doc"))))

    def loses(v: Column) -> Column:
        return F.exists("ranked", lambda o: (o.getField("item") == v.getField("item")) & (
            (o.getField("n") > v.getField("n")) | ((o.getField("n") == v.getField("n")) & (o.getField("doc") < v.getField("doc")))))

    ranked = F.transform("values", lambda v: F.struct(
        v.getField("item").alias("item"), v.getField("doc").alias("doc"), places_of(v).alias("n")))
    aligned = aligned.withColumn("ranked", F.when(~agrees, ranked))
    lost = F.transform(F.filter("ranked", loses), lambda v: F.struct(v.getField("item").alias("item"), v.getField("doc").alias("doc")))
    aligned = aligned.withColumn("lost", F.when(~agrees, lost))
    kept = F.when(F.col("lost").isNull(), F.col("slotted")).otherwise(F.filter("slotted", lambda w: ~F.exists(
        w.getField("pairs"), lambda p: F.array_contains("lost", p.dropFields("at")))))
    aligned = aligned.withColumn("kept", kept)
    values = F.when(F.col("lost").isNull(), F.col("values")).otherwise(F.array_distinct(
        F.transform(F.flatten(F.col("kept.pairs")), lambda p: p.dropFields("at"))))
    return aligned.select(
        "doc_id", "item_id", "n_windows", "n_exact", "exact", F.array_union("free", F.col("kept.place")).alias("places"),
        values.alias("values"))


def leaks(docs: DataFrame, items: DataFrame, *, coverage: float = COVERAGE) -> DataFrame:
    """Pairs of a document and a benchmark item it contains.

    Per pair: doc_id, item_id, n_windows of the item, n_matched (different windows of the item
    without a conflicting value), n_slots (different values that correspond) and verbatim
    (all of them equal). Only pairs with n_matched >= coverage * n_windows, counted over template
    windows or, if those are too few and the item has exact windows, over its windows of both kinds.
    n_slots counts values in template windows only.

    The documents' windows meet the items' in a hash join: the items are broadcast if counted
    small and shuffled otherwise, and what a document shares with an item is summed up before
    it is shuffled. Null or empty texts have no windows. Rows that repeat a doc_id count as one
    document; documents without an id are reported together under null.
    """
    found = stored(benchmark_windows(items), "windows")
    lengths = [r.length for r in found.where("length is not null").select("length").distinct().collect()]
    index = small_or_shuffled(found.select(
        "item_id", "hash", F.col("place").alias("item_place"), F.col("slots").alias("item_slots"), "n_windows", "n_exact",
        F.col("length").isNotNull().alias("is_exact")))
    met = windows(docs.select("doc_id", "text"), "doc_id", lengths).join(index, "hash")
    # (place in the item, value of the item, value of the document) of the window's slots.
    pairs = F.filter(F.transform("item_slots", lambda w, k: F.struct(
        (F.col("item_place") + k).alias("at"), w.alias("item"), F.get("slots", k).alias("doc"))),
        lambda p: _is_slot(p.getField("item")))
    aligned = met.select(
        "doc_id", "item_id", "n_windows", "n_exact", (F.col("place") - F.col("item_place")).alias("shift"),
        F.when(F.col("item_slots").isNull() & ~F.col("is_exact"), F.col("item_place")).alias("free"),
        F.when(F.col("is_exact"), F.col("item_place")).alias("exact"),
        F.when(F.col("item_slots").isNotNull(), F.struct(F.col("item_place").alias("place"), pairs.alias("pairs"))).alias("slotted"),
    ).groupBy("doc_id", "item_id", "n_windows", "n_exact", "shift").agg(
        F.collect_set("free").alias("free"), F.collect_set("slotted").alias("slotted"),
        (F.collect_set("exact") if lengths else F.array().cast("array<int>")).alias("exact"))

    def different(places: Column) -> Column:
        return F.size(F.array_distinct(F.flatten(F.collect_list(places)))).cast("long")

    pairs = consistent_windows(aligned).groupBy("doc_id", "item_id", "n_windows", "n_exact").agg(
        different(F.col("places")).alias("n_matched"), different(F.array_union("places", "exact")).alias("n_both"),
        F.array_distinct(F.flatten(F.collect_list("values"))).alias("values"))
    by_template = (F.col("n_windows") > 0) & (F.col("n_matched") >= F.lit(coverage) * F.col("n_windows"))
    by_both = (F.col("n_exact") > 0) & (F.col("n_both") >= F.lit(coverage) * F.col("n_exact"))
    return pairs.where(by_template | by_both).select(
        "doc_id", "item_id", F.when(by_template, F.col("n_windows")).otherwise(F.col("n_exact")).alias("n_windows"),
        F.when(by_template, F.col("n_matched")).otherwise(F.col("n_both")).alias("n_matched"),
        F.size("values").cast("long").alias("n_slots"),
        F.forall("values", lambda p: p.getField("item") == p.getField("doc")).alias("verbatim"))


def without_leaks(docs: DataFrame, items: DataFrame, *, coverage: float = COVERAGE) -> DataFrame:
    """Documents that contain no benchmark item, with their own columns; those without an id stay."""
    found = stored(leaks(docs, items, coverage=coverage).select(F.col("doc_id").alias("_leaked")).where(
        "_leaked is not null").distinct(), "leaked")
    return docs.join(small_or_shuffled(found), F.expr("doc_id = _leaked"), "left_anti")


def oracle() -> str:
    """DuckDB SQL of `leaks` over documents and benchmark."""

    def template(source: str, key: str) -> str:
        out = rf"regexp_replace(coalesce(text, ''), '([\p{{Ll}}0-9,;] )(\p{{Lu}}\p{{L}}*)', '\1{NAME}\2', 'g')"
        out = f"regexp_replace({out}, '([0-9][0-9.,:/]*)', '{NUMBER}\\1', 'g')"
        out = f"regexp_replace({out}, '({NUMBER}[0-9.,:/]+ ?)({'|'.join(UNITS)})\\b', '\\1 {UNIT}\\2', 'g')"
        quoted = PUNCTUATION.replace("'", "''")
        out = f"translate(lower({out}), '{quoted}', '')"
        return (f"SELECT {key}, list_filter(regexp_split_to_array({out}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws "
                f"FROM {source}")

    def is_slot(x: str) -> str:
        return f"{x}[1] IN ('{NUMBER}', '{NAME}', '{UNIT}')"

    def cut(source: str, key: str) -> str:
        return (f"SELECT {key}, i AS place, slots, array_to_string(list_transform(slots, lambda x: "
                f"CASE WHEN {is_slot('x')} THEN x[1] ELSE x END), ' ') AS win, len(list_filter(slots, lambda x: {is_slot('x')})) AS n_slots "
                f"FROM (SELECT {key}, i, ws[i:i + {WINDOW - 1}] AS slots FROM (SELECT {key}, ws, "
                f"unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM {source} WHERE len(ws) >= {WINDOW}))")

    def exact(key: str, source: str) -> str:
        """Windows of `length` words with their values, without the marks."""
        return (f"SELECT {key}, i AS place, length, array_to_string(list_transform(ws[i:i + length - 1], lambda x: "
                f"CASE WHEN {is_slot('x')} THEN x[2:] ELSE x END), ' ') AS win FROM (SELECT {key}, ws, length, "
                f"unnest(range(1, len(ws) - length + 2)) AS i FROM {source} WHERE len(ws) >= length)")

    place = "doc_id, item_id, shift"
    slots_of = f"(SELECT unnest(range(1, {WINDOW + 1})) AS k) WHERE {is_slot('a[k]')}"
    plain = f"{WINDOW} - len(list_filter(ws[i:i + {WINDOW - 1}], lambda x: {is_slot('x')}))"
    return f"""
WITH dt AS ({template('documents', 'doc_id')}), bt AS ({template('benchmark', 'item_id')}),
dw AS ({cut('dt', 'doc_id')}), bw AS (SELECT * FROM ({cut('bt', 'item_id')}) WHERE {WINDOW} - n_slots >= {MIN_PLAIN}),
few AS (SELECT item_id, ws, least(len(ws), {WINDOW}) AS length FROM bt WHERE len(ws) BETWEEN 1 AND {WINDOW - 1}
  OR len(list_filter(range(1, len(ws) - {WINDOW - 2}), lambda i: {plain} < {MIN_PLAIN})) > 0),
bx AS ({exact('item_id', 'few')}),
dx AS ({exact('doc_id', '(SELECT doc_id, ws, length FROM dt, (SELECT DISTINCT length FROM few))')}),
n AS (SELECT item_id, count(DISTINCT place) FILTER (NOT is_exact) AS n_windows, count(DISTINCT place) FILTER (is_exact) AS n_exact
  FROM (SELECT item_id, place, false AS is_exact FROM bw UNION ALL SELECT item_id, place, true FROM bx) GROUP BY item_id),
met AS (SELECT DISTINCT doc_id, item_id, dw.place - bw.place AS shift, bw.place, bw.slots AS a, dw.slots AS b FROM dw JOIN bw USING (win)),
-- The value of the document at most places stands for the item's value; windows with another one are lost.
v AS (SELECT DISTINCT {place}, place + k AS spot, a[k] AS iv, b[k] AS dv FROM met, {slots_of}),
ranked AS (SELECT {place}, iv, dv, row_number() OVER (PARTITION BY {place}, iv ORDER BY count(*) DESC, dv) AS r FROM v GROUP BY {place}, iv, dv),
lost AS (SELECT m.doc_id, m.item_id, m.shift, m.place, m.a, m.b FROM (SELECT *, a[k] AS iv, b[k] AS dv FROM met, {slots_of}) m JOIN ranked r
  ON m.doc_id IS NOT DISTINCT FROM r.doc_id AND m.item_id IS NOT DISTINCT FROM r.item_id AND m.shift = r.shift AND m.iv = r.iv AND m.dv = r.dv AND r.r > 1),
kept AS (SELECT {place}, place, a, b FROM met EXCEPT SELECT {place}, place, a, b FROM lost),
vals AS (SELECT doc_id, item_id, count(*) AS n_slots, bool_and(iv = dv) AS verbatim FROM (
  SELECT DISTINCT doc_id, item_id, a[k] AS iv, b[k] AS dv FROM kept, {slots_of}) GROUP BY doc_id, item_id),
c AS (SELECT doc_id, item_id, count(DISTINCT place) FILTER (NOT is_exact) AS by_template, count(DISTINCT place) AS by_both
  FROM (SELECT doc_id, item_id, place, false AS is_exact FROM kept
    UNION ALL SELECT doc_id, item_id, bx.place, true FROM dx JOIN bx USING (length, win)) GROUP BY doc_id, item_id),
j AS (SELECT c.*, n_windows, n_exact, n_windows > 0 AND by_template >= {COVERAGE} * n_windows AS fits
  FROM c JOIN n ON c.item_id IS NOT DISTINCT FROM n.item_id)
SELECT j.doc_id, j.item_id, CASE WHEN fits THEN n_windows ELSE n_exact END AS n_windows,
  CASE WHEN fits THEN by_template ELSE by_both END AS n_matched, coalesce(n_slots, 0) AS n_slots, coalesce(verbatim, true) AS verbatim
FROM j LEFT JOIN vals ON j.doc_id IS NOT DISTINCT FROM vals.doc_id AND j.item_id IS NOT DISTINCT FROM vals.item_id
WHERE fits OR (n_exact > 0 AND by_both >= {COVERAGE} * n_exact)
"""
