"""The set join against brute force on small, awkward inputs."""

from __future__ import annotations

import random
import re

import pytest

from tradewind.llm.common import components
from tradewind.llm.set_join import one_per_class, prefix_length, shingle_classes

SCHEMA = "doc_id long, text string, lang string, n_shingles string"


def brute(rows):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k:k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                o = len(sets[a] & sets[b])
                if 100 * o >= 90 * (len(sets[a]) + len(sets[b]) - o):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {(i, len(sets[i]), find(i)) for i in ids}


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    line = " ".join(rng.choices(vocabulary, k=12))
    rows = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.choice([5, 30, 90, 200]))
        for _ in range(rng.choice([1, 2, 6, 14])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(" ".join(copy) + rng.choice(["", "", "\n" + line]))
    rows += [line, line.upper(), "", None, "  \n ", "a", "A", "a b", "a b c", "\u00c9 b c", "\u00e9 b c"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("common", [0, 40])
def test_same_as_brute_force(spark, seed, common):
    rows = corpus(seed)
    if common and seed > 1:
        pytest.skip("one seed is enough for the order")
    found = shingle_classes(spark.createDataFrame([(i, t, "en", "x") for i, t in rows], SCHEMA), common=common or 100)
    assert {tuple(r) for r in found.collect()} == brute(rows)


def test_null_and_repeated_ids_and_empty_table(spark):
    text = "one two three four five six seven"
    rows = [(None, text, "en", ""), (1, text, "en", ""), (1, text, "en", ""), (2, text, None, None), (3, None, None, None)]
    found = [tuple(r) for r in shingle_classes(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(found, key=str) == sorted([(None, 5, None), (1, 5, 1), (1, 5, 1), (2, 5, 1), (3, 0, 3)], key=str)
    assert shingle_classes(spark.createDataFrame([], SCHEMA)).count() == 0
    kept = one_per_class(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "lang", "n_shingles"]
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1, 3]


def test_prefix_holds_enough_members():
    for n in range(1, 300):
        assert prefix_length(n) == min(n, n - -(-90 * n // 100) + 3)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_of_chains_stars_and_loops(spark, seed):
    rng = random.Random(seed)
    nodes = rng.sample(range(1000), 90)
    edges = list(zip(nodes[:30], nodes[1:31]))  # a chain in random order
    edges += [(nodes[40], n) for n in nodes[41:60]]  # a star
    edges += [(rng.choice(nodes[61:]), rng.choice(nodes[61:])) for _ in range(25)]
    edges += [edges[0], edges[0][::-1], (None, 5), (7, None)]
    groups = {n: {n} for e in edges if None not in e and e[0] != e[1] for n in e}
    for a, b in edges:
        if a in groups and b in groups:
            merged = groups[a] | groups[b]
            for n in merged:
                groups[n] = merged
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, found)) == sorted((n, min(g)) for n, g in groups.items())


def test_no_edges(spark):
    assert components(spark.createDataFrame([(3, 3)], "a long, b long")).count() == 0


def test_stage_links_near_copies(spark):
    import corpus_pipeline

    base = [f"w{i}" for i in range(100)]
    # Three of 100 words: nine of 96 five-word shingles change, and seven of 98 three-word ones.
    changed = [f"x{i}" if i in (1, 50, 98) else w for i, w in enumerate(base)]
    # Changed words apart from each other and from the ends: 15 of 96 are too many.
    far = [f"y{i}" if i in (20, 50, 80) else w for i, w in enumerate(base)]
    rows = [(1, " ".join(base), "en", ""), (2, " ".join(changed), "en", ""), (3, " ".join(far), "en", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r.doc_id for r in corpus_pipeline.one_of_each(spark, docs, "").collect()) == [1, 3]
    assert sorted(r.doc_id for r in one_per_class(docs).collect()) == [1, 2, 3]


def test_short_texts_never_enter_lists(spark):
    """Sets too small to be linked with a different one: equal texts are one class, others stay alone."""
    rows = [(i, f"click here to log in user{i // 2}") for i in range(600)] + [(900, "a b c d e f g h i j k l"), (901, "a b c d e f g h i j k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in shingle_classes(docs).collect()}
    assert found == {**{i: i - i % 2 for i in range(600)}, 900: 900, 901: 900}
    assert set(found.items()) == {(i, c) for i, _, c in brute(rows)}
