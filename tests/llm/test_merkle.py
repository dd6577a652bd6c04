"""The Merkle manifest against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from tradewind.llm import merkle
from tradewind.llm.registry import llm_queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, label string, pos long"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(*values) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """(levels, root): digests of each level, bottom first."""
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([sha("".join(row[i:i + 2])) for i in range(0, len(row), 2)])
    return levels


def path(levels, at):
    found = []
    for row in levels[:-1]:
        found.append((at & 1, row[at ^ 1] if at ^ 1 < len(row) else ""))
        at >>= 1
    return found


def brute(rows):
    """Result rows of (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for i, text, lang, source, n in rows:
        leaf = leaf_of(i, source, lang, n, text)
        bad = i is not None and zlib.crc32(str(i).encode()) % 7 == 0
        claim = leaf_of(i, source, lang, None if n is None else n + 1, text) if bad else leaf
        groups.setdefault(lang, []).append((i, leaf, claim))
    if not groups:
        return []
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[g] = tree([leaf for _, leaf, _ in groups[g]])
    top = tree([trees[g][-1][0] for g in names])
    root, out = top[-1][0], []
    for k, g in enumerate(names):
        for at, (i, leaf, claim) in enumerate(groups[g]):
            steps = path(trees[g], at) + path(top, k)
            node = claim
            for side, other in steps:
                node = sha(other + node if side else node + other)
            out.append((i, leaf, trees[g][-1][0], root, sha("".join(s for _, s in steps)), node, node == root))
    return out


def query(spark, rows, height):
    docs = spark.createDataFrame([(*r, "x", "y", 0) for r in rows], SCHEMA)
    found = merkle.audited(docs, claim=merkle.tampered(), height=height)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("height", [1, 3, 8])
def test_same_as_plain_trees(spark, height):
    rng = random.Random(height)
    rows = [(i, f"text {i} é", rng.choice(["en"] * 6 + ["de", "fr", None, "\U0001f600", "￿"]), rng.choice(["a", None, ""]),
             rng.choice([None, 5, 123456])) for i in range(-3, 130)]
    rows += [(None, "n", "en", "a", 1), (None, "m", "en", "a", 1), (7, "again", "en", "a", 1), (7, "again", "en", "a", 1),
             (200, None, "it", None, None), (201, "", "", "", 0), (202, "long " * 50_000, "en", "a", 250_000)]
    rng.shuffle(rows)
    assert query(spark, rows, height) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("sizes", [(), (1,), (4, 1), (16, 17, 3)])
def test_sizes_at_block_borders(spark, sizes):
    rows = [(100 * g + i, "t", f"l{g}", "a", i) for g, n in enumerate(sizes) for i in range(n)]
    assert query(spark, rows, 2) == sorted(brute(rows), key=str)


def test_every_row_of_the_sample(spark, sample):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{sample}/documents.parquet").collect()]
    found = sorted((tuple(r) for r in llm_queries()["op13_merkle"](spark, sample).collect()), key=str)
    assert found == sorted(brute(rows), key=str)
    assert {r[-1] for r in found} == {True, False}


def test_layout_is_a_permutation_split_at_half_height():
    for height in range(12):
        places = np.concatenate(merkle.layout(height))
        assert sorted(places.tolist()) == list(range((2 << height) - 1))
    # Height 3: two levels above, then four bottom trees of three nodes each.
    assert [p.tolist() for p in merkle.layout(3)] == [[0], [1, 2], [3, 6, 9, 12], [4, 5, 7, 8, 10, 11, 13, 14]]


def test_any_changed_field_breaks_the_fold(spark):
    rows = [(i, f"t{i}", "en", "a", i) for i in range(20)]
    docs = spark.createDataFrame([(*r, "x", "y", 0) for r in rows], SCHEMA)
    from pyspark.sql import functions as F

    for field, other in (("text", F.lit("T")), ("source", F.lit(None)), ("doc_id", F.col("doc_id") + 100)):
        claim = merkle.leaf_digest([other if f == field else F.col(f) for f in merkle.FIELDS])
        assert not any(r.verified for r in merkle.audited(docs, claim=claim).collect())
    assert all(r.verified for r in merkle.audited(docs).collect())
