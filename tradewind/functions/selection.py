"""Exact ntiles by distributed selection: no sort, shuffle or window over the rows.

A tile is decided by the keys at the tile borders alone. Each border's key is searched as in
quickselect: a bounded sample of the rows inside a bracket gives two pivots close to the border's
rank, one pass counts the rows up to each pivot, and the bracket shrinks to what lies between
them, by a factor of tens each time. What is left is sorted on the driver once it is no larger
than a sample. Ranks are counted, never estimated, so the result is exact; keys end with a
unique tie-break, so that one very common value is split like any other.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tradewind.session import ensure_checkpoint_dir

# Rows of a bracket that the driver sorts, sampled or not, and the share of hash values in a sample.
SAMPLE = 20_000
HASHES = 1 << 40
# Standard deviations between a border's expected place in a sample and its pivots.
SPREAD = 5.0
ROUNDS = 40


@dataclass(frozen=True)
class Tile:
    """A column `name` with the tile of a numeric `value`.

    As in `ntile`, ascending puts nulls first and NaN last, descending the reverse.
    """

    value: str
    name: str
    descending: bool = False

    def key(self, tie_break: str) -> Column:
        """A struct that sorts as the rows are ranked."""
        value, sign = F.col(self.value), -1 if self.descending else 1
        place = F.when(value.isNull(), -sign).when(F.isnan(value.cast("double")), sign).otherwise(0)
        ranked = F.when(place == 0, -value if self.descending else value)
        return F.struct(place.alias("place"), ranked.alias("value"), F.col(tie_break).alias("tie"))


def _order(key: Row) -> tuple:
    """Sorts collected keys as Spark does: text by its bytes."""
    tie = key.tie.encode() if isinstance(key.tie, str) else key.tie
    return key.place, 0 if key.value is None else key.value, tie is not None, tie if tie is not None else 0


class _Border:
    """Search for the key of one rank: `below` rows up to `low`, `upto` rows up to `high`."""

    def __init__(self, rank: int, total: int):
        self.rank, self.below, self.upto = rank, 0, total
        self.low = self.high = self.found = None

    @property
    def inside(self) -> int:
        return self.upto - self.below

    def pivots(self, sample: list[Row]) -> list[Row]:
        share = (self.rank - self.below) / self.inside
        at, spread = share * len(sample), SPREAD * math.sqrt(len(sample) * share * (1 - share)) + 1
        last = len(sample) - 1
        return [sample[max(0, min(last, math.floor(at - spread)))], sample[max(0, min(last, math.ceil(at + spread)))]]

    def narrow(self, pivot: Row, rank: int) -> None:
        if rank >= self.rank:
            if rank < self.upto:
                self.high, self.upto = pivot, rank
        elif rank > self.below:
            self.low, self.below = pivot, rank


def tile_ends(total: int, tiles: int) -> list[int]:
    """The last rank of each tile but the last: the first total % tiles tiles hold one row more."""
    short, longer = divmod(total, tiles)
    return [j * short + min(j, longer) for j in range(1, tiles)]


def keys_at(frame: DataFrame, key: Column, ranks: Sequence[int], total: int, *, sample: int = SAMPLE) -> dict[int, Column]:
    """The keys at some ranks (from 1) of a frame, as literals. Give frames that are stored."""
    keyed = frame.select(key.alias("k"))
    kind = keyed.schema["k"].dataType

    def literal(k: Row) -> Column:
        return F.struct(*[F.lit(k[f]).cast(t.dataType).alias(f) for f, t in zip(kind.names, kind.fields)])

    borders = {r: _Border(r, total) for r in ranks}
    for turn in range(ROUNDS):
        search = [b for b in borders.values() if b.found is None]
        if not search:
            return {r: literal(b.found) for r, b in borders.items()}
        tests = []
        for b in search:
            inside = F.lit(True)
            if b.low is not None:
                inside = inside & (F.col("k") > literal(b.low))
            if b.high is not None:
                inside = inside & (F.col("k") <= literal(b.high))
            if b.inside > sample:
                inside = inside & (F.pmod(F.xxhash64("k.tie", "k.value", F.lit(turn)), F.lit(HASHES)) < HASHES * sample // b.inside)
            tests.append(inside)
        hits = keyed.select("k", F.array(*tests).alias("hit")).where(F.array_contains("hit", True)).collect()
        asked = []
        for at, b in enumerate(search):
            mine = sorted((r.k for r in hits if r.hit[at]), key=_order)
            if b.inside <= sample:
                b.found = mine[b.rank - b.below - 1]
            elif mine:
                asked += [(b, p) for p in b.pivots(mine)]
        if asked:
            counts = keyed.agg(*[F.count_if(F.col("k") <= literal(p)).alias(f"_{i}") for i, (_, p) in enumerate(asked)]).first()
            for (b, p), rank in zip(asked, counts):
                b.narrow(p, rank)
    raise RuntimeError("the brackets of the tile borders did not close")


def with_tiles(frame: DataFrame, tie_break: str, tiles: int, columns: Sequence[Tile], *, sample: int = SAMPLE) -> DataFrame:
    """Adds a tile (1 to tiles) per entry of `columns`, ranked by (value, tie_break).

    `tie_break` must be unique. The frame is checkpointed once, since each search passes over it a
    few times; the driver holds at most `sample` keys per border.
    """
    ensure_checkpoint_dir(frame.sparkSession)
    stored = frame.checkpoint()
    total = stored.count()
    added = {}
    for tile in columns:
        key = tile.key(tie_break)
        ends = [e for e in tile_ends(total, tiles) if 0 < e < total]
        found = keys_at(stored, key, sorted(set(ends)), total, sample=sample)
        above = [(key > found[e]).cast("int") for e in ends]
        added[tile.name] = sum(above, F.lit(1)).cast("int")
    return stored.withColumns(added)
