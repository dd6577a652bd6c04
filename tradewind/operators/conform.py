"""Raw strings to typed tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.operators.rules import keep
from tradewind.schema import SOURCES, Field, Source


def convert(field: Field) -> Column:
    """Typed value of a raw column; text that does not parse becomes NULL."""
    raw = F.col(field.name)
    if field.kind == "text":
        return raw
    if field.kind == "blank_to_null":
        return F.nullif(raw, F.lit(""))
    if field.kind == "int_from_decimal":
        # "44.0" is not an int to Spark, but is a double.
        return raw.try_cast("double").try_cast("int")
    return raw.try_cast(field.kind)


def order_timestamp() -> Column:
    """Date and time columns as one timestamp; NULL if either is missing or unreadable."""
    return F.concat("order_date", F.lit(" "), "order_time").try_cast("timestamp")


def typed_columns(source: Source, frame: DataFrame, missing: str) -> list[Column]:
    absent = [f.name for f in source.fields if f.name not in frame.columns]
    if absent and missing == "error":
        raise ValueError(f"{source.raw} lacks the columns {absent}")
    columns = []
    for field in source.fields:
        if field.name in absent:
            continue
        columns.append(convert(field).alias(field.target))
        if source.raw == "orders" and field.name == "order_time" and "order_date" not in absent:
            columns.append(order_timestamp().alias("order_timestamp"))
    return columns


def conform(table: str, raw: DataFrame, as_of: Column, *, missing: str = "error") -> DataFrame:
    """The typed table of one raw table: rows that pass its rules, columns cast.

    `missing="skip"` accepts a raw table without some of the declared columns.
    Filter and projection only, so the scan stays a single narrow pass.
    """
    source = SOURCES[table]
    return raw.where(keep(table, raw, as_of)).select(*typed_columns(source, raw, missing))


def conform_all(raw: Mapping[str, DataFrame], as_of: Column, *, missing: str = "error") -> dict[str, DataFrame]:
    """Typed tables by typed name."""
    return {
        SOURCES[table].typed: conform(table, frame, as_of, missing=missing)
        for table, frame in raw.items()
    }
