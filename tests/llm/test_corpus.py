"""Rules, mixing, decontamination, classifiers and the pipeline against plain code."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from check import differences, oracle_connection
from tradewind.llm import decontaminate, mixing, passages, quality_rules, sketches, toxicity
from tradewind.llm.registry import llm_oracles, llm_queries, tokenizer_file

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, _words string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "x", "y") for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def connection(sample):
    return oracle_connection(sample)


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_matches_oracle(name, spark, sample, connection):
    frame = llm_queries()[name](spark, sample)
    result = connection.execute(llm_oracles()[name])
    columns = [c[0] for c in result.description]
    assert differences(frame.columns, [tuple(r) for r in frame.collect()], columns, result.fetchall()) is None


def test_one_query_of_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in llm_queries())
    assert numbers == list(range(1, 14)) and list(corpus_pipeline.pipeline_queries()) == ["pipeline"]


def test_rules_on_awkward_rows(spark):
    words = " ".join(f"word{i}" for i in range(40))
    rows = [(1, None, "a"), (2, "", "a"), (None, words, None), (3, "a b c d e f " * 2_000, "a"), (4, words, "a"), (4, words, "a"),
            (5, " ".join(w + "###" for w in words.split()), "b")]
    found = {r.doc_id: r for r in quality_rules.quality_report(docs_of(spark, rows)).collect()}
    assert [found[i].kept for i in (1, 2, None, 3, 4, 5)] == [False, False, True, False, True, False]
    assert found[3].n_repeat_words == 12_000 and found[1].n_words == 0
    kept = quality_rules.keep_good(docs_of(spark, rows))
    assert kept.columns == docs_of(spark, rows).columns and sorted(str(r.doc_id) for r in kept.collect()) == ["4", "4", "None"]
    assert quality_rules.quality_report(docs_of(spark, [])).count() == 0


def test_cascade_order():
    rules = [quality_rules.Rule(n, None) for n in "abc"]
    found = [quality_rules.Estimate("a", 1.0, 0.1), quality_rules.Estimate("b", 0.1, 0.1), quality_rules.Estimate("c", 1.0, 0.5)]
    assert [r.name for r in quality_rules.ordered_rules(rules, found)] == ["b", "c", "a"]


def test_mix_keeps_its_targets(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 60)), rng.choice(["a"] * 8 + ["b", "c", None])) for i in range(900)]
    rows += [(None, "w w", "a"), (7, "w", "a"), (7, "w", "a")]
    found = mixing.fair_mix(mixing.document_sizes(docs_of(spark, rows)), bucket_rows=50).collect()
    again = mixing.fair_mix(mixing.document_sizes(docs_of(spark, rows)), bucket_rows=900).collect()
    assert sorted(map(str, found)) == sorted(map(str, again)) and len(found) == len(rows)
    for source in ("a", "b", "c", None):
        mine = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 130 and mine[0].target <= 2 * mine[0].source_size
        assert all(r.taken <= 2 * r.size for r in mine)
    assert abs(sum({r.source: r.target for r in found}.values()) - 1.5 * sum(r.size for r in found)) < 1e-6
    assert mixing.fair_mix(mixing.document_sizes(docs_of(spark, []))).count() == 0
    mixed = mixing.mix_documents(docs_of(spark, rows))
    assert mixed.columns == docs_of(spark, rows).columns


def test_changed_parameters_are_leaks(spark):
    item = "a train leaves the old station at 40 km per hour and Anna waits 40 minutes near the long bridge for it"
    same = item.replace("40", "75").replace("Anna", "Peter")
    mixed = item.replace("40", "75", 1)
    rows = [(1, "so " + item.upper().lower() + " end", "a"), (2, "so " + same, "a"), (3, mixed, "a"), (4, None, "a"), (5, "", "a"),
            (6, "a train leaves the old house and nobody waits at all for the next one to come back here", "a"), (None, same, "a"), (2, same, "a")]
    items = spark.createDataFrame([(9, item, ""), (10, None, ""), (11, "too short", "")], "item_id long, text string, doc_id string")
    found = {r.doc_id: r for r in decontaminate.leaks(docs_of(spark, rows), items).collect()}
    assert {1, 2, None} <= set(found) and not {4, 5, 6} & set(found)
    assert not found[2].verbatim and found[2].n_slots == 4
    left = decontaminate.without_leaks(docs_of(spark, rows), items)
    assert {4, 5, 6, None} <= {r.doc_id for r in left.collect()} and left.columns == docs_of(spark, rows).columns
    assert decontaminate.leaks(docs_of(spark, []), items).count() == 0


def test_one_changed_value_leaves_other_windows(spark):
    item = "a train leaves the old station at 40 km per hour and Anna waits 40 minutes near the long bridge for it"
    first = item.replace("40", "75", 1)
    rows = [(1, item, "a"), (3, first, "a"), (4, first.replace("40", "62"), "a")]
    items = spark.createDataFrame([(9, item)], "item_id long, text string")
    found = {r.doc_id: r for r in decontaminate.leaks(docs_of(spark, rows), items).collect()}
    assert set(found) == {1, 3, 4} and found[1].n_matched == found[1].n_windows and found[1].verbatim
    # The second place's value wins the tie or is dropped itself; windows of the other place do not count.
    assert found[1].n_windows > found[3].n_matched >= found[1].n_windows // 2
    left = decontaminate.without_leaks(docs_of(spark, rows), items)
    assert left.count() == 0


def test_items_without_templates_match_verbatim(spark):
    texts = {9: "What is photosynthesis exactly?", 10: "2 + 2 = 4", 11: "Anna Bob Carl Dora Emil Fritz", 12: "", 13: None}
    items = spark.createDataFrame(list(texts.items()), "item_id long, text string")
    rows = [(1, "they asked What is photosynthesis exactly and left", "a"), (2, "so 2 + 2 = 4 it is", "a"), (3, "so 2 + 3 = 5 it is", "a"),
            (4, "we met Anna Bob Carl Dora Emil Fritz there", "a"), (5, "we met Paul Bob Kurt Dora Ernst Fritz there", "a"),
            (6, "what is photosynthesis not exactly", "a"), (7, "", "a"), (8, None, "a")]
    found = [(r.doc_id, r.item_id) for r in decontaminate.leaks(docs_of(spark, rows), items).collect()]
    assert sorted(found) == [(1, 9), (2, 10), (4, 11)]


def test_leaks_and_their_sql_agree(spark):
    import duckdb
    import pandas as pd

    rng = random.Random(8)
    train = "a train leaves the old station at 40 km per hour and Anna waits 40 minutes near the long bridge for it"
    texts = {9: train, 10: "Yes", 11: "What is photosynthesis exactly?", 12: "2 + 2 = 4", 13: "Anna Bob Carl Dora Emil Fritz", 14: "",
             15: None, 16: "in 1990 the town of Anna had 12 000 people and 12 wells, in 2001 it had 40 wells"}
    rows = [(1, train), (2, "so " + train.replace("40", "75")), (3, train.replace("40", "75", 1)), (4, "they said yes to it"),
            (5, "YES"), (6, None), (7, ""), (8, "so 2 + 2 = 4 it is"), (9, "so 2 + 3 = 5 it is"), (None, train), (None, "What is photosynthesis exactly"),
            (10, train.replace("40", "75")), (10, train.replace("40", "62")), (11, train + " and " + train.replace("Anna", "Eva"))]
    for i in range(20, 120):
        words = (texts[rng.choice([9, 9, 11, 12, 13, 16])] or "").split()
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(words))
            words[at] = rng.choice(["40", "75", "12", "Anna", "Peter", "km", "wells", "the", words[at]])
        rows.append((i, "we saw " + " ".join(words) + " today"))
    items = spark.createDataFrame(list(texts.items()), "item_id long, text string")
    found = decontaminate.leaks(docs_of(spark, [(i, t, "a") for i, t in rows]), items)
    con = duckdb.connect()
    for name, key, listed in (("documents", "doc_id", rows), ("benchmark", "item_id", texts.items())):
        con.register(name, pd.DataFrame(listed, columns=[key, "text"]).astype({key: "Int64", "text": "string"}))
    result = con.execute(decontaminate.oracle())
    columns = [c[0] for c in result.description]
    assert differences(found.columns, [tuple(r) for r in found.collect()], columns, result.fetchall()) is None
    pairs = {(r.doc_id, r.item_id) for r in found.collect()}
    assert {(1, 9), (3, 9), (4, 10), (5, 10), (None, 9), (None, 11)} <= pairs and len(pairs) > 50


def test_toxicity_generalises(spark):
    rng = random.Random(3)
    calm = ["river", "stone", "window", "garden", "paper", "morning", "bridge", "winter"]
    rows, labels = [], []
    for i in range(400):
        words = rng.choices(calm, k=20)
        if i % 2:
            words[rng.randrange(20)] = rng.choice(["stupid", "idiotic", "worthless"])
        rows.append((i, " ".join(words), "a"))
        labels.append((i, i % 2, 1))
    rows += [(9001, "river stone stupidd window", "a"), (9002, "river stone paper window", "a"), (9003, None, "a"), (9004, "", "a")]
    marked = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    found = {r.doc_id: r for r in toxicity.toxicity(docs_of(spark, rows), marked).collect()}
    assert found[9001].score > found[9002].score and found[9001].predicted == 1 and len(found) == 404
    held = [r for r in found.values() if r.held_out and r.doc_id < 400]
    assert held and all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out for r in found.values())
    assert np.mean([r.predicted == r.doc_id % 2 for r in held]) > 0.95
    assert {r.score for r in toxicity.toxicity(docs_of(spark, rows[:3]), marked.limit(0)).collect()} != set()


def test_quality_model(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(300):
        words = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(rng.choice([5, 80, 260]))]
        if i % 3 == 0:
            words = [w + "$$$" for w in words]
        rows.append((i, " ".join(words), "a"))
        labels.append((i, int(i % 3 != 0)))
    rows += [(9001, None, "a"), (9002, "", "a"), (None, "a b", "a")]
    marked = spark.createDataFrame(labels, "doc_id long, quality int")
    found = [r for r in passages.quality(docs_of(spark, rows), marked).collect()]
    assert len(found) == 303 and all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert held and np.mean([r.predicted == (r.doc_id % 3 != 0) for r in held]) > 0.95


def plain_pipeline(spark, folder):
    """The stages in plain Python; what SQL can say comes from DuckDB's oracles."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    con = oracle_connection(folder)
    docs = con.execute("SELECT * FROM documents").to_arrow_table()

    def left(sql, drop):
        nonlocal docs
        con.execute("DROP VIEW IF EXISTS documents")
        con.register("documents", docs)
        result = con.execute(sql)
        names = [c[0] for c in result.description]
        gone = {r[names.index("doc_id")] for r in result.fetchall() if drop(dict(zip(names, r)))}
        docs = docs.filter(pa.array([i not in gone for i in docs["doc_id"].to_pylist()]))
        con.unregister("documents")

    left(llm_oracles()["op4_quality_rules"], lambda r: not r["kept"])
    # The stage's own shingle width and similarity.
    left(sketches.oracle(corpus_pipeline.NEAR_WORDS, corpus_pipeline.NEAR_PERCENT), lambda r: not r["kept"])
    left(llm_oracles()["op8_decontaminate"], lambda r: True)
    con.register("documents", docs)
    result = con.execute(llm_oracles()["op10_mix_sources"])
    taken = {r[0]: (r[4] // r[1] if r[1] else 0) for r in result.fetchall()}
    tokenizer = Tokenizer.from_file(tokenizer_file())
    out, start = [], 0
    for i, text in sorted(zip(docs["doc_id"].to_pylist(), docs["text"].to_pylist())):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        for _ in range(taken[i]):
            out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    return out


def test_pipeline(spark, sample):
    found = sorted((tuple(r) for r in corpus_pipeline.run(spark, sample).collect()), key=lambda r: r[1])
    assert found == plain_pipeline(spark, sample)
    # Near copies at five words and 80 percent that three words and 90 percent would keep.
    assert not {145, 177} & {r[0] for r in found}
