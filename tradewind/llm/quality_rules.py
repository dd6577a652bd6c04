"""Quality rules as a short-circuit cascade, in built-in functions only.

Every rule is an expression over a few statistics of a text. On a sample, each rule's cost
(time to evaluate it) and selectivity (share it rejects) are measured; the cascade then asks
the rules in falling order of rejections per cost, and a later rule is not evaluated for a
document that an earlier one has rejected. The order changes the time, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import NOT_SPACE, once, words

# The rows of the sample on which costs and selectivities are estimated.
SAMPLE_ROWS = 2_000
WINDOW = 5
# The symbols that are counted, and the limits of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


@dataclass(frozen=True)
class Rule:
    """A named condition under which a document is rejected, over `text` and `_words`."""

    name: str
    rejects: Column


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def n_words() -> Column:
    return F.size("_words").cast("long")


def word_chars() -> Column:
    return F.length(F.array_join("_words", "")).cast("long")


def n_symbols() -> Column:
    # Plain byte searches; each symbol is one byte.
    left = _text()
    for symbol in SYMBOLS:
        left = F.replace(left, F.lit(symbol), F.lit(""))
    return (F.octet_length(_text()) - F.octet_length(left)).cast("long")


def _lines() -> Column:
    return F.filter(F.split(_text(), "\n"), lambda line: line.rlike(NOT_SPACE))


def n_upper_words() -> Column:
    return F.size(F.filter("_words", lambda w: (w == F.upper(w)) & (w != F.lower(w)))).cast("long")


def n_letter_words() -> Column:
    return F.size(F.filter("_words", lambda w: w.rlike(r"\p{L}"))).cast("long")


def default_rules() -> list[Rule]:
    """Rules beyond the base. The limits are wide: ordinary prose is far from all of them."""
    return [
        Rule("symbols", 100 * n_symbols() > 25 * n_words()),
        Rule("shouting", 100 * n_upper_words() > 50 * n_words()),
        Rule("word_length", (word_chars() < 2 * n_words()) | (word_chars() > 25 * n_words())),
        Rule("no_letters", 100 * n_letter_words() < 60 * n_words()),
        Rule("same_lines", F.size(F.array_distinct(_lines())) * 100 < 50 * F.size(_lines())),
    ]


@dataclass(frozen=True)
class Estimate:
    name: str
    seconds: float
    rejected: float


def estimate_rules(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Time and rejected share of each rule on a sample of about `sample_rows` rows.

    The sample holds only what orders the rules. It is kept in executor memory and computed
    again if lost. An empty input gives zero shares.
    """
    rows = docs.count()
    sample = docs.select("text")
    if rows > sample_rows:
        sample = sample.sample(False, min(1.0, sample_rows / rows), 17)
    sample = sample.withColumn("_words", words(F.col("text"))).persist()
    try:
        seen = max(1, sample.count())
        found = []
        for rule in rules:
            started = time.perf_counter()
            rejected = sample.agg(F.count_if(rule.rejects)).first()[0]
            found.append(Estimate(rule.name, time.perf_counter() - started, rejected / seen))
        return found
    finally:
        sample.unpersist()


def ordered_rules(rules: Sequence[Rule], estimates: Sequence[Estimate]) -> list[Rule]:
    """Rules by falling rejections per second; equal ones by name."""
    gain = {e.name: e.rejected / max(e.seconds, 1e-6) for e in estimates}
    return sorted(rules, key=lambda r: (-gain[r.name], r.name))


def cascade(rules: Sequence[Rule]) -> Column:
    """True if no rule rejects; later branches are evaluated only for what earlier ones leave."""
    verdict = None
    for rule in rules:
        hit = F.coalesce(rule.rejects, F.lit(False))
        verdict = F.when(hit, F.lit(False)) if verdict is None else verdict.when(hit, F.lit(False))
    return F.lit(True) if verdict is None else verdict.otherwise(F.lit(True))


def _repeat_columns(frame: DataFrame) -> DataFrame:
    """Adds n_repeat_words from `_words`: words inside 5-word windows that occur twice or more.

    Windows are compared by a 64-bit hash within one text. Only texts in which a hash repeats
    are sorted, by (hash, place); equal neighbours are repeats, and the places they start at,
    in order, cover min(5, distance to the next) words each.
    """
    size = F.size("_words")
    starts = F.when(size >= WINDOW, F.sequence(F.lit(0), size - WINDOW)).otherwise(
        F.array().cast("array<int>"))
    frame = once(frame, _hashes=F.transform(
        starts, lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)])))
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    frame = once(frame, _pairs=F.when(repeats, F.sort_array(F.transform(
        "_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def place(pair, i):
        here = pair.getField("h")
        # get() gives null outside the array, and null is not equal to anything.
        before = F.get("_pairs", i - 1).getField("h")
        after = F.get("_pairs", i + 1).getField("h")
        again = F.coalesce(here == before, F.lit(False)) | F.coalesce(here == after, F.lit(False))
        return F.when(again, pair.getField("i"))

    frame = once(frame, _places=F.sort_array(F.array_compact(F.transform("_pairs", place))))
    covered = F.aggregate(
        "_places",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("end")),
        lambda acc, p: F.struct(
            (acc.getField("n") + F.least(F.lit(WINDOW), p - acc.getField("end"))).alias("n"), p.alias("end")),
        lambda acc: acc.getField("n"),
    )
    return once(frame, n_repeat_words=F.coalesce(covered, F.lit(0)).cast("long")).drop(
        "_hashes", "_pairs", "_places")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def quality_report(
    docs: DataFrame, *, rules: Sequence[Rule] | None = None, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """One row per document: doc_id, the base statistics, base_failed and kept.

    Row by row without a shuffle. A null or empty text has no words, fails the base rules and
    is not kept; repeated rows are judged separately; a null doc_id is passed on.
    """
    asked = ordered_rules(rules or default_rules(), estimate_rules(docs, rules or default_rules(), sample_rows))
    frame = _repeat_columns(once(docs.select("doc_id", "text"), _words=words(F.col("text"))))
    frame = once(
        frame, n_words=n_words(), word_chars=word_chars(), n_symbols=n_symbols(), _lines=_lines())
    frame = once(frame, n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    return frame.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"),
        F.when(base_failed(), F.lit(False)).otherwise(cascade(asked)).alias("kept"))


def keep_good(docs: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that the base rules and the cascade keep, with their own columns.

    The word count and the cascade come first; the repeat windows are computed only for
    documents that are still in.
    """
    rules = default_rules()
    asked = ordered_rules(rules, estimate_rules(docs, rules, sample_rows))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    frame = once(docs.select(row.alias("_row"), F.col("text")), _words=words(F.col("text")))
    frame = frame.where(F.when(n_words() < MIN_WORDS, F.lit(False)).otherwise(cascade(asked)))
    frame = _repeat_columns(frame).where(
        100 * F.col("n_repeat_words") <= MAX_REPEAT_PERCENT * n_words())
    return frame.select("_row.*")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), windows AS (
  SELECT r, i, array_to_string(words[i:i + 4], ' ') AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest(range(0, 5)) AS k) GROUP BY r
), s AS (
  SELECT doc_id, words, lines, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(words, lambda x: x = upper(x) AND x <> lower(x))) AS n_upper,
    len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) AS n_letter
  FROM w LEFT JOIN covered USING (r)
), b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 25 * n_words OR 100 * n_upper > 50 * n_words
    OR word_chars < 2 * n_words OR word_chars > 25 * n_words OR 100 * n_letter < 60 * n_words
    OR 100 * len(list_distinct(lines)) < 50 * len(lines)) AS kept
FROM b
"""
