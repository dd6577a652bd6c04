"""Merkle manifest of a dataset: digests of all rows under one root, and a proof for each row.

Rows are the leaves of one tree per group (a language, say); the groups' roots are the leaves of a
last tree. A node digests its one or two children, as hex text.

* Blocks. A tree is cut into aligned subtrees of BLOCK_HEIGHT levels: rows 0 to 255, 256 to 511
  and so on. One Spark group of at most 256 leaves makes one block; the roots of the blocks are
  the leaves of the next tier of blocks, until a tree has one root. A tier is a stored table.
* Van Emde Boas layout. A block holds all its nodes in one buffer, split at half its height: the
  upper half first, then its bottom subtrees from left to right, each laid out in the same way. The
  place of a node follows from its depth and index alone, with no pointers; a path from a leaf
  up stays within few stretches of the buffer, whatever the size of a cache line.
* Proofs come down the tiers: a block adds the siblings of its leaves to the path from its own root
  upwards, which the block above has made.

Nothing larger than a block is ever in one place, and no row text leaves its scan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import numbered, ship, stored

BLOCK_HEIGHT = 8
# Length of a digest as hex text.
DIGEST = 64
ALONE, LEFT, RIGHT = b"-", b"<", b">"

TIER = ("tree string, block long, size long, levels int, count int, nodes binary, root string, "
        "ids array<long>, labels array<string>")
PATHS = "tree string, block long, path binary, subroot string"

ship(__name__)


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


@lru_cache(maxsize=None)
def layout(height: int) -> tuple[np.ndarray, ...]:
    """Places of a complete binary tree's nodes in van Emde Boas order: one array per depth, by index."""
    if height == 0:
        return (np.zeros(1, np.int64),)
    upper = (height + 1) // 2
    lower = height + 1 - upper
    first = (1 << upper) - 1
    starts = first + np.arange(1 << upper, dtype=np.int64) * ((1 << lower) - 1)
    return layout(upper - 1) + tuple((starts[:, None] + places).ravel() for places in layout(lower - 1))


def subtree(leaves: Sequence[bytes], levels: int) -> bytes:
    """The nodes of one block, `levels` above its leaves, in layout order; absent nodes are zero bytes."""
    places = layout(levels)
    nodes = bytearray(DIGEST * ((2 << levels) - 1))
    row = list(leaves)
    for depth in range(levels, -1, -1):
        for place, node in zip(places[depth].tolist(), row):
            nodes[place * DIGEST: (place + 1) * DIGEST] = node
        row = [digest(b"".join(row[i: i + 2])) for i in range(0, len(row), 2)]
    return bytes(nodes)


def node_at(nodes: memoryview, place: int) -> bytes:
    return bytes(nodes[place * DIGEST: (place + 1) * DIGEST])


def path_in_block(nodes: memoryview, levels: int, count: int, leaf: int) -> bytes:
    """Siblings from a leaf up to the block's root, each after a mark for its side."""
    places, steps = layout(levels), []
    for depth in range(levels, 0, -1):
        other = leaf ^ 1
        if other < count:
            steps += [LEFT if leaf & 1 else RIGHT, node_at(nodes, int(places[depth][other]))]
        else:
            steps.append(ALONE)
        leaf, count = leaf >> 1, (count + 1) >> 1
    return b"".join(steps)


def siblings(path: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(side, sibling) of each level of a path, bottom first."""
    at = 0
    while at < len(path):
        side = path[at: at + 1]
        length = 0 if side == ALONE else DIGEST
        yield side, path[at + 1: at + 1 + length]
        at += 1 + length


def proof_digest(path: bytes) -> str:
    return digest(b"".join(s for _, s in siblings(path))).decode()


def folded(leaf: bytes, path: bytes) -> str:
    """The root that a leaf and a path lead to."""
    for side, sibling in siblings(path):
        leaf = digest(sibling + leaf if side == LEFT else leaf + sibling)
    return leaf.decode()


def framed(column: Column) -> Column:
    """`-` for null, else byte count, colon, value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[framed(c) for c in columns]).cast("binary"), 256)


def _block(tier: int, height: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        size = table["size"][0].as_py()
        levels = min(height, (size - 1).bit_length() - tier * height)
        nodes = subtree([n.encode() for n in table["node"].to_pylist()], levels)
        root = node_at(memoryview(nodes), 0).decode()
        made = [[table["tree"][0].as_py()], [table["block"][0].as_py()], [size], [levels], [len(table)], [nodes], [root],
                [table["id"].to_pylist()], [table["label"].to_pylist()]]
        return pa.table([pa.array(v, f.type) for v, f in zip(made, BLOCKS)], schema=BLOCKS)

    return run


BLOCKS = pa.schema([
    ("tree", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("levels", pa.int32()), ("count", pa.int32()),
    ("nodes", pa.binary()), ("root", pa.string()), ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.string()))])


def tree_tiers(leaves: DataFrame, order: Sequence[str], height: int, name: str) -> list[DataFrame]:
    """Tables of blocks, lowest first, over leaves (tree, node, id, label) in the given order within a tree.

    Leaves are range-partitioned and sorted by tree and order, so that a tree with most of the
    rows spreads over all tasks, and numbered; a leaf's place is its number less its tree's first.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    # Stored first: ranges are cut from a sample, which would digest every row once more.
    ordered = numbered(stored(leaves, f"{name}-digests").repartitionByRange(*keys).sortWithinPartitions(*keys), f"{name}-leaves")
    trees = stored(ordered.groupBy("tree").agg(
        F.min("number").alias("first"), F.count(F.lit(1)).alias("size")), f"{name}-trees")
    largest = trees.agg(F.max("size")).first()[0] or 0
    nodes = ordered.join(trees.withColumnRenamed("tree", "_tree"), F.col("tree").eqNullSafe(F.col("_tree"))).select(
        "tree", (F.col("number") - F.col("first")).alias("pos"), "size", "node", "id", "label")
    tiers: list[DataFrame] = []
    while not tiers or largest > 1 << (height * len(tiers)):
        if tiers:
            nodes = tiers[-1].where(F.col("size") > 1 << (height * len(tiers))).select(
                "tree", F.col("block").alias("pos"), "size", F.col("root").alias("node"),
                F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("label"))
        blocked = nodes.withColumn("block", F.shiftright("pos", height))
        tiers.append(stored(blocked.groupBy("tree", "block").applyInArrow(_block(len(tiers), height), TIER), f"{name}-tier"))
    return tiers


def tree_roots(tiers: Sequence[DataFrame], height: int) -> DataFrame:
    """(tree, root) of every tree."""
    tops = [t.where(_is_top(i, height)).select("tree", "root") for i, t in enumerate(tiers)]
    roots = tops[0]
    for t in tops[1:]:
        roots = roots.unionByName(t)
    return roots


def _is_top(tier: int, height: int) -> Column:
    top = F.col("size") <= 1 << (height * (tier + 1))
    return top & (F.col("size") > 1 << (height * tier)) if tier else top


def _below(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths of a block's leaves, which are the blocks of the tier below."""
    for batch in batches:
        for k in range(len(batch)):
            nodes, levels, count, start, tree, path, subroot = _fields(batch, k)
            paths = [path_in_block(nodes, levels, count, i) + path for i in range(count)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree] * count, pa.string()), pa.array(range(start, start + count), pa.int64()),
                 pa.array(paths, pa.binary()), pa.array([subroot] * count, pa.string())],
                ["tree", "block", "path", "subroot"])


def _fields(batch: pa.RecordBatch, k: int):
    """A block of a joined tier row: its buffer and numbers, the place of its first leaf, its own path."""
    levels, count, start, tree, path, subroot = (
        batch.column(c)[k].as_py() for c in ("levels", "count", "start", "tree", "path", "subroot"))
    return memoryview(batch.column("nodes")[k].as_buffer()), levels, count, start, tree, path, subroot


LEAVES = "id long, label string, tree string, leaf string, path binary, subroot string, proof_sha256 string, folded_root string"


def _leaf_rows(labels_claim: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                nodes, levels, count, _, tree, path, subroot = _fields(batch, k)
                ids, labels = batch.column("ids")[k].as_py(), batch.column("labels")[k].as_py()
                bottom, rows = layout(levels)[levels], []
                for i in range(count):
                    leaf = node_at(nodes, int(bottom[i]))
                    whole = path_in_block(nodes, levels, count, i) + path
                    claim = labels[i].encode() if labels_claim and labels[i] is not None else leaf
                    rows.append((ids[i], labels[i], tree, leaf.decode(), whole, subroot, proof_digest(whole), folded(claim, whole)))
                types = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*rows), types)],
                    [c.split()[0] for c in LEAVES.split(", ")])

    return run


def leaf_paths(tiers: Sequence[DataFrame], above: DataFrame, height: int, *, claims: bool = False) -> DataFrame:
    """LEAVES of every leaf; `above` has (tree, path, subroot) from each tree's root upwards.

    With `claims`, a leaf's label is the digest that is folded instead of its own.
    """
    given = None
    for i in range(len(tiers) - 1, -1, -1):
        tier = tiers[i]
        tops = tier.where(_is_top(i, height)).select(F.col("tree").alias("t"))
        start = tops.join(above, F.col("t").eqNullSafe(F.col("tree"))).select(
            "tree", F.lit(0).cast("long").alias("block"), "path", "subroot")
        paths = start if given is None else start.unionByName(given)
        paths = paths.select(F.col("tree").alias("_tree"), F.col("block").alias("_block"), "path", "subroot")
        joined = tier.withColumn("start", F.shiftleft("block", height)).join(
            paths, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_block"))).drop("_tree", "_block")
        if i:
            given = stored(joined.mapInArrow(_below, PATHS), "merkle-paths")
        else:
            return joined.mapInArrow(_leaf_rows(claims), LEAVES)


@dataclass
class Manifest:
    """Stored tiers of the groups' trees and of the tree over their roots; root is None for no rows."""

    groups: list[DataFrame]
    top: list[DataFrame]
    root: str | None
    height: int

    def proofs(self, *, claims: bool = False) -> DataFrame:
        """LEAVES of every row of the dataset, with paths to the root."""
        spark = self.groups[0].sparkSession
        if self.root is None:
            return spark.createDataFrame([], LEAVES)
        start = spark.createDataFrame([(None, b"", self.root)], "tree string, path binary, subroot string")
        tops = leaf_paths(self.top, start, self.height)
        above = stored(tops.select(F.col("label").alias("tree"), "path", F.col("leaf").alias("subroot")), "merkle-tops")
        return leaf_paths(self.groups, above, self.height, claims=claims)


def write_manifest(rows: DataFrame, *, fields: Sequence[str], group: str, order: str,
                   claim: Column | None = None, height: int = BLOCK_HEIGHT) -> Manifest:
    """Builds and stores the manifest of rows with an integer key `order`.

    Leaves of a group ascend by `order`, null first, and among equal keys by digest; groups ascend
    by the bytes of their name, null first. `claim` is the digest some other copy has for a row,
    kept beside the leaf as its label, for `Manifest.proofs(claims=True)`. Rows that repeat are
    leaves of their own. Other columns are not read.
    """
    leaf = leaf_digest([F.col(c) for c in fields])
    label = F.lit(None).cast("string") if claim is None else claim
    leaves = rows.select(
        F.col(group).cast("string").alias("tree"), F.col(order).cast("long").alias("id"), leaf.alias("node"), label.alias("label"))
    groups = tree_tiers(leaves, ["id", "node", "label"], height, "merkle")
    roots = tree_roots(groups, height).select(
        F.lit(None).cast("string").alias("tree"), F.lit(None).cast("long").alias("id"), F.col("root").alias("node"),
        F.col("tree").alias("label"))
    top = tree_tiers(roots, ["label"], height, "merkle-top")
    found = tree_roots(top, height).first()
    return Manifest(groups, top, found.root if found else None, height)


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def audited(docs: DataFrame, *, claim: Column | None = None, height: int = BLOCK_HEIGHT) -> DataFrame:
    """Per row of documents: leaf, subroot, root, proof, and whether the claimed digest folds to the root.

    Null fields have their own mark, so null and empty texts differ. No rows give no rows.
    """
    manifest = write_manifest(docs, fields=FIELDS, group="lang", order="doc_id", claim=claim, height=height)
    root = F.lit(manifest.root)
    return manifest.proofs(claims=claim is not None).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", root.cast("string").alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"))


def tampered(every: int = 7) -> Column:
    """Digest of a row whose n_chars is one more, where `every` divides the checksum of its id; else null."""
    more = {c: F.col(c) for c in FIELDS} | {"n_chars": F.try_add(F.col("n_chars").cast("long"), F.lit(1).cast("long"))}
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0, leaf_digest(list(more.values())))


ORACLE = r"""
WITH RECURSIVE crc AS (
  SELECT DISTINCT doc_id AS c_id, xor(list_reduce([4294967295::BIGINT] || list_transform(
      range(1, len(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i::BIGINT, 1))::BIGINT),
    lambda acc, b: list_reduce([xor(acc, b)] || range(0, 8), lambda v, s: xor(v >> 1, (v & 1) * 3988292384))),
    4294967295::BIGINT) AS code
  FROM documents WHERE doc_id IS NOT NULL
), raw AS (
  SELECT doc_id, lang, n_chars,
    coalesce(octet_length(doc_id::VARCHAR::BLOB) || ':' || doc_id, '-') || coalesce(octet_length(source::BLOB) || ':' || source, '-')
      || coalesce(octet_length(lang::BLOB) || ':' || lang, '-') AS head,
    coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail
  FROM documents
), leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(length((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) AS other
  FROM raw
), placed AS (
  SELECT l.*, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS size, coalesce(code % 7 = 0, false) AS bad
  FROM leaves l LEFT JOIN crc ON c_id = doc_id
), nodes AS (
  SELECT lang, 0 AS lvl, pos, size, leaf AS h FROM placed
  UNION ALL
  SELECT lang, lvl + 1, pos // 2, (size + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM nodes WHERE size > 1 GROUP BY lang, lvl, pos // 2, size
), subroots AS (
  SELECT lang, h AS subroot, lvl AS height, row_number() OVER (ORDER BY encode(coalesce(lang, '')), lang NULLS FIRST) - 1 AS tpos,
    count(*) OVER () AS tsize
  FROM nodes WHERE size = 1
), tops AS (
  SELECT 0 AS lvl, tpos AS pos, tsize AS size, subroot AS h FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, (size + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM tops WHERE size > 1 GROUP BY lvl, pos // 2, size
), steps AS (
  SELECT p.doc_id, p.lang, p.pos AS id, n.lvl, (p.pos >> n.lvl) % 2 AS side, s.h AS sibling
  FROM placed p JOIN nodes n ON n.lang IS NOT DISTINCT FROM p.lang AND n.pos = p.pos >> n.lvl AND n.size > 1
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM p.lang AND s.lvl = n.lvl AND s.pos = xor(p.pos >> n.lvl, 1)
  UNION ALL
  SELECT p.doc_id, p.lang, p.pos, r.height + n.lvl, (r.tpos >> n.lvl) % 2, s.h
  FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
  JOIN tops n ON n.pos = r.tpos >> n.lvl AND n.size > 1
  LEFT JOIN tops s ON s.lvl = n.lvl AND s.pos = xor(r.tpos >> n.lvl, 1)
), paths AS (
  SELECT lang, id, list({'side': side, 'sibling': coalesce(sibling, '')} ORDER BY lvl) AS path,
    string_agg(coalesce(sibling, ''), '' ORDER BY lvl) AS joined
  FROM steps GROUP BY lang, id
), walk AS (
  SELECT p.lang, p.pos, 0 AS k, CASE WHEN bad THEN other ELSE leaf END AS h, coalesce(path, []) AS path
  FROM placed p LEFT JOIN paths t ON t.lang IS NOT DISTINCT FROM p.lang AND t.id = p.pos
  UNION ALL
  SELECT lang, pos, k + 1, sha256(CASE WHEN path[k + 1].side = 1 THEN path[k + 1].sibling || h ELSE h || path[k + 1].sibling END), path
  FROM walk WHERE k < len(path)
), top AS (SELECT h AS root FROM tops WHERE size = 1)
SELECT p.doc_id, p.leaf, r.subroot, root, sha256(coalesce(joined, '')) AS proof_sha256, w.h AS folded_root, w.h = root AS verified
FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
JOIN walk w ON w.lang IS NOT DISTINCT FROM p.lang AND w.pos = p.pos AND w.k = len(w.path)
LEFT JOIN paths t ON t.lang IS NOT DISTINCT FROM p.lang AND t.id = p.pos CROSS JOIN top
"""
