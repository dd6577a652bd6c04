"""Bottom-k near duplicates against brute force."""

from __future__ import annotations

import random
import re

import pytest

from tradewind.llm import sketches

SCHEMA = "doc_id long, text string, lang string, n_shingles string, kept string"


def brute(rows, words, percent):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                o = len(sets[a] & sets[b])
                if 100 * o >= percent * (len(sets[a]) + len(sets[b]) - o):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {(i, len(sets[i]), find(i), find(i) == i) for i in sets}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x", "y") for i, t in rows], SCHEMA)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    line = " ".join(rng.choices(vocabulary, k=12))
    rows = []
    for _ in range(14):
        base = rng.choices(vocabulary, k=rng.choice([5, 8, 12, 30, 90, 150, 200, 400]))
        for _ in range(rng.choice([1, 2, 6, 14])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4, 6, 8])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(" ".join(copy[: len(copy) - rng.choice([0, 0, 1, 9])]) + rng.choice(["", "", "\n" + line]))
    rows += [line, line.upper(), "", None, "  \n ", "a", "A", "a b c", "a b c d", "É b c d e", "é b c d e"]
    # Sets of four and five shingles are the smallest that differ and are linked.
    rows += ["p q r s t u v", "p q r s t u v w", "x0 " + line, "x1 " + line, "x2 " + line]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, keep", [(1, 512), (3, 24)])
def test_same_as_brute_force(spark, seed, keep):
    # A small sketch has little to tell by, so links rest on the exact check.
    rows = corpus(seed)
    found = sketches.near_classes(frame(spark, rows), keep=keep)
    assert {tuple(r) for r in found.collect()} == brute(rows, 4, 80)


def test_hot_lists_in_portions(spark, monkeypatch):
    monkeypatch.setattr(sketches, "PORTION", 5)
    rows = corpus(5)
    base = " ".join(f"v{i}" for i in range(60))
    rows += [(1000 + i, base.replace(f"v{i} ", f"u{i} ")) for i in range(40)]
    found = sketches.near_classes(frame(spark, rows))
    assert {tuple(r) for r in found.collect()} == brute(rows, 4, 80)


def test_template_lines_do_not_meet(spark):
    """Lines that share all but their last word are not linked at eight shingles, and make no pairs."""
    rows = [(i, f"please click here to log in to your account now user{i}") for i in range(300)]
    sets = spark.createDataFrame([(i, 8, 1, list(range(7)) + [100 + i]) for i, _ in rows], "id long, n long, hits long, sketch array<long>")
    listed = sets.mapInArrow(sketches._entries(sketches.frequent_values(sets), 128, 80), sketches.LISTED)
    from pyspark.sql import functions as F

    entries = listed.select("id", "n", "shorter", "hits", F.posexplode("first").alias("pos", "value"), F.col("id").alias("class"))
    assert sketches.open_pairs(entries, 128, 80).count() == 0
    assert {r.component_id for r in sketches.near_classes(frame(spark, rows)).collect()} == set(range(300))


def test_bounds():
    assert sketches.least_size(80) == 4 and sketches.least_size(90) == 9
    for n in range(1, 104):
        longer, shorter = sketches.entry_lengths(n, 128, 80)
        assert longer == n - -(-80 * n // 100) + 1 and shorter == n - -(-160 * n // 180) + 1
    for n in (104, 128, 5_000):
        assert sketches.entry_lengths(n, 128, 80)[0] == min(n, 128) - sketches.fewest(n, 128, 80) + 1
    found = [sketches.fewest(n, 128, 80) for n in (110, 150, 300, 5_000, 10 ** 6)]
    assert found == sorted(found, reverse=True) and 70 <= found[-1] < found[0] <= 103


def test_linked_sets_stay_above_the_bound():
    rng = random.Random(8)
    for n in (150, 400, 2_000):
        least = sketches.fewest(n, 128, 80)
        for _ in range(300):
            union = 100 * n // 80
            values = rng.sample(range(1 << 40), union)
            shared = set(values[: -(-80 * union // 100)])
            assert sum(v in shared for v in sorted(values)[:128]) >= least


def test_awkward_rows(spark):
    text = "one two three four five six seven eight"
    rows = [(None, text), (1, text), (1, text), (2, text), (3, None), (4, "word " * 30_000)]
    found = [tuple(r) for r in sketches.near_classes(frame(spark, rows)).collect()]
    assert sorted(found, key=str) == sorted([
        (None, 5, None, True), (1, 5, 1, True), (1, 5, 1, True), (2, 5, 1, False), (3, 0, 3, True), (4, 1, 4, True)], key=str)
    assert sketches.near_classes(frame(spark, [])).count() == 0


def test_whole_sets_that_a_truncated_partner_could_meet(spark):
    """105 and 104 shingles fit a sketch of 128 whole; their pairs need as many entries as other whole sets do."""
    for n in range(1, 129):
        longer, shorter = sketches.listed_lengths(n, 128, 80)
        assert longer >= n - -(-80 * n // 100) + 1 and shorter >= n - -(-160 * n // 180) + 1
    # The smaller set lacks the first 21 values of the larger one.
    sets = spark.createDataFrame([(0, 105, 1, list(range(105))), (1, 84, 1, list(range(21, 105)))], "id long, n long, hits long, sketch array<long>")
    large, small = sets.mapInArrow(sketches._entries(sketches.frequent_values(sets), 128, 80), sketches.LISTED).orderBy("id").collect()
    assert set(large["first"]) & set(small["first"][: small["shorter"]])
    rows = []
    for g in range(12):
        # The shorter text is the longer one's middle.
        words = [f"g{g}w{i}" for i in range(108 + g)]
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(words[9: 12 - -80 * (105 + g) // 100]))]
    found = sketches.near_classes(frame(spark, rows), keep=128)
    assert {tuple(r) for r in found.collect()} == brute(rows, 4, 80)
    assert found.where("kept").count() == 12


def entries_of(spark, sets):
    rows = [(i, len(v), sketches.entry_lengths(len(v), 512, 80)[0], 1, p, x, i) for i, v in sets for p, x in enumerate(v)]
    return spark.createDataFrame(rows, "id long, n long, shorter long, hits long, pos int, value long, class long")


def test_a_pair_is_made_in_one_list(spark, tmp_path):
    """Near copies share most of their entries; joined list by list they would make twenty rows a pair."""
    sets = [(i, [1000 * i + j for j in range(i % 3)] + list(range(100 - i % 3))) for i in range(30)]
    made = sketches.open_pairs(entries_of(spark, sets), 512, 80)
    rows = made._jdf.queryExecution()
    pairs = {tuple(r) for r in made.collect()}

    def joins(plan):
        below = [plan.children().apply(i) for i in range(plan.children().size())]
        if plan.nodeName().startswith("AdaptiveSparkPlan"):
            below = [plan.executedPlan()]
        elif "QueryStage" in plan.nodeName():
            below = [plan.plan()]
        own = [plan.metrics().apply("numOutputRows").value()] if "Join" in plan.nodeName() else []
        return own + [n for x in below for n in joins(x)]

    assert len(pairs) > 300 and max(joins(rows.executedPlan())) == len(pairs)


def test_pairs_are_those_of_every_list(spark):
    """Centres, which have met their lists, leave; all other pairs that share an entry stay."""
    rng = random.Random(11)
    sets = [(i, sorted(rng.sample(range(60), 40))) for i in range(40)]
    held, short = dict(sets), sketches.entry_lengths(40, 512, 80)[1]
    entries = entries_of(spark, [(i, v[:9]) for i, v in sets]).selectExpr("id", "40L n", f"{short}L shorter", "hits", "pos", "value", "class")
    met = {tuple(r) for t in range(sketches.CENTRE_ROUNDS) for r in sketches.centre_pairs(entries, 80, t).collect()}
    made = {tuple(r) for r in sketches.open_pairs(entries, 512, 80).collect()}
    for a in held:
        for b in held:
            if a > b and 9 * (80 - 2 * len(set(held[a]) & set(held[b]))) <= 80:
                assert (a, b) in met | made


def test_marks_keep_linked_pairs():
    import numpy as np

    rng = random.Random(13)
    bits = lambda x, y: int(np.unpackbits((x ^ y).view(np.uint8)).sum())
    linked, others = [], []
    for n in (5, 60, 400, 3_000):
        for _ in range(60):
            values = [rng.getrandbits(62) for _ in range(3 * n)]
            x, near, far = (np.unique(np.array(v, np.uint64)) for v in (values[:n], values[n // 10: n + n // 10], values[n:]))
            (odd, low), (near_odd, near_low), (_, far_low) = map(sketches.marks, (x, near, far))
            assert bits(odd, near_odd) <= len(np.setxor1d(x, near))
            if n > 512:
                linked.append(bits(low, near_low))
                others.append(bits(low, far_low))
    assert max(linked) <= sketches.most_apart(80) < min(others)
