"""Key ledgers: several tables folded onto one key by a single shuffle.

A chain of joins between fact tables shuffles each table for each join and sends
every row of a hot key to one task. A ledger instead gives each table its own
measures (0 or NULL for the others), unions them and aggregates once by the key.
Spark combines map-side first, so a key with a third of all rows reaches its reducer
as one row per map task, and no fan-out can arise between the tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack_sources(
    sources: Sequence[tuple[DataFrame, Mapping[str, Column]]], keys: Sequence[str]
) -> DataFrame:
    """Union of the sources on `keys`; a measure a source does not give is NULL there."""
    parts = [
        frame.select(*[F.col(k) for k in keys], *[c.alias(n) for n, c in measures.items()])
        for frame, measures in sources
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def with_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are all present: only these can match in an equi-join."""
    return frame.dropna(subset=list(keys))


def rows_from_columns(
    one_row: DataFrame, label: str, entries: Sequence[tuple[str, Mapping[str, Column]]]
) -> DataFrame:
    """Turn columns of a (one-row) frame into rows: one per entry, named by `label`."""
    cells = [
        F.struct(F.lit(name).alias(label), *[c.alias(n) for n, c in values.items()])
        for name, values in entries
    ]
    return one_row.select(F.explode(F.array(*cells)).alias("_cell")).select("_cell.*")
