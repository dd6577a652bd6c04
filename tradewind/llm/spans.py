"""Spans found in texts, and the digests the queries derive from them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import ship

Span = tuple[str, int, int, str, float]
SPAN_SCHEMA = "doc_id long, spans array<struct<kind:string,start:long,end:long,target:string,score:double>>"
_TYPE = pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("target", pa.string()), ("score", pa.float64())]))
_NAMES = ("kind", "start", "end", "target", "score")

ship(__name__)


def find_spans(docs: DataFrame, finder: Callable[[], Callable[[list[str]], list[list[Span]]]]) -> DataFrame:
    """(doc_id, spans) of (doc_id, text): `finder()` makes, once per task, what maps texts to spans."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = finder()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = find([t or "" for t in part.column(1).to_pylist()])
                rows = [[dict(zip(_NAMES, s)) for s in spans] for spans in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(rows, _TYPE)], ["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, SPAN_SCHEMA)


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s.getField("kind"), s.getField("start").cast("string"), s.getField("end").cast("string"))), ",")


def digest_columns(found: DataFrame, base: Sequence[str]) -> DataFrame:
    """doc_id, counts of the base kinds, the hash of the base spans, and all spans as text."""

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s.getField("kind").isin(*kinds))

    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(span_text(of(*base)), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
