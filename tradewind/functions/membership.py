"""Exact membership of keys in bitmaps, so that rows are looked up without being shuffled.

A whole number is a bit in the block of 32,768 numbers around it. A text splits without loss into
what stands before its final digits, how many these are, and their number, so ids such as
'C-000123' fill blocks just as well. Every block is one row of 4 KB. Keys that fill few blocks fit
into a broadcast that answers exactly, unlike a Bloom filter, for rows with and without a match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.joins import rows_at_most
from tradewind.session import ensure_checkpoint_dir

# Bits of a block: fixed by Spark's bitmap functions. A power of two.
BLOCK_BITS = 32_768
# Blocks of a broadcast: at most 64 MB, or 500 million keys that follow one another.
MOST_BLOCKS = 16_384
# Final digits that surely fit into a long.
DIGITS = 18

PLACE = ("_before", "_digits", "_block")


def kind_of(data_type: T.DataType) -> str | None:
    """'number' or 'text' for types whose values have places in blocks, else None."""
    if isinstance(data_type, T.IntegralType):
        return "number"
    return "text" if data_type.simpleString() == "string" else None


def placed(value: Column, kind: str) -> list[Column]:
    """Block of a value (three columns) and its bit there. Values are equal exactly when all four are."""
    if kind == "number":
        before, digits, number = F.lit(""), F.lit(0), value.cast("long")
    else:
        final = F.regexp_extract(value, rf"([0-9]{{1,{DIGITS}}})\z", 1)
        digits = F.length(final)
        before = F.substring(value, F.lit(1), F.length(value) - digits)
        number = F.when(digits > 0, final.cast("long")).when(value.isNotNull(), F.lit(0).cast("long"))
    block = F.shiftright(number, BLOCK_BITS.bit_length() - 1)
    bit = number.bitwiseAND(F.lit(BLOCK_BITS - 1))
    return [c.alias(n) for c, n in zip((before, digits, block, bit), (*PLACE, "_bit"))]


def key_blocks(frame: DataFrame, column: str, *, most: int = MOST_BLOCKS) -> DataFrame | None:
    """Bitmaps of the column's values by block, or None where there are (or may be) more than `most`.

    An estimate comes first, so that scattered keys, which would need a block each, build none.
    The blocks are checkpointed and counted before they are given out.
    """
    kind = kind_of(frame.schema[column].dataType)
    if kind is None:
        return None
    value = F.col(f"`{column}`")
    places = frame.where(value.isNotNull()).select(*placed(value, kind))
    if places.agg(F.approx_count_distinct(F.struct(*PLACE), 0.02)).first()[0] > most:
        return None
    ensure_checkpoint_dir(frame.sparkSession)
    blocks = places.groupBy(*PLACE).agg(F.bitmap_construct_agg("_bit").alias("_bits")).checkpoint()
    return blocks if rows_at_most(blocks, most) else None


def with_membership(frame: DataFrame, column: str, blocks: DataFrame, name: str) -> DataFrame:
    """Adds `name`: whether the value is in the blocks from `key_blocks`; null for a null value.

    A map-side join with the broadcast blocks and a look at one bit. The column must be of the same kind as
    the one the blocks were built from.
    """
    value = F.col(f"`{column}`")
    places = frame.select("*", *placed(value, kind_of(frame.schema[column].dataType)))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.shiftright(F.col("_bit"), 3).cast("int") + 1, F.lit(1))), 16, 10)
    found = F.getbit(byte.cast("int"), F.col("_bit").bitwiseAND(F.lit(7)).cast("int")) == 1
    return (
        places.join(F.broadcast(blocks), list(PLACE), "left")
        .withColumn(name, F.when(value.isNotNull(), F.coalesce(found, F.lit(False))))
        .drop(*PLACE, "_bit", "_bits")
    )
