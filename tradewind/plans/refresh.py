"""Derived tables brought up to date from newly loaded rows, without reading the old ones again."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tradewind.operators.conform import conform
from tradewind.operators.rollups import ROLLUPS, Rollup, finished
from tradewind.plans.pipeline import Pipeline
from tradewind.schema import SOURCES
from tradewind.sources.layers import write_table
from tradewind.sources.partials import add_load, read_partials
from tradewind.streaming.ingest import ingest_all_new_files

RAW_OF = {s.typed: raw for raw, s in SOURCES.items()}


def fold_new_rows(pipeline: Pipeline, fact: str, rollups: Mapping[str, Rollup]) -> int:
    """Folds ingested rows that no earlier call has seen into partials; returns how many it read.

    The ingested table is read as a stream with its own checkpoint, so only new files are
    opened. The typed rows of a load are kept while all rollups of the fact fold them.
    """
    spark, raw = pipeline.spark, RAW_OF[fact]

    def fold(batch: DataFrame, load: int) -> None:
        rows = conform(raw, batch, pipeline.as_of, missing=pipeline.raw_missing).persist()
        try:
            for name, rollup in rollups.items():
                add_load(rows, pipeline.out_root, name, rollup, load)
        finally:
            rows.unpersist()

    query = (
        spark.readStream.schema(SOURCES[raw].raw_schema()).parquet(f"{pipeline.out_root}/bronze/{raw}")
        .writeStream.foreachBatch(fold)
        .option("checkpointLocation", f"{pipeline.out_root}/_refresh/{raw}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def refresh(pipeline: Pipeline, rollups: Mapping[str, Rollup] = ROLLUPS) -> dict[str, DataFrame]:
    """Loads new raw files and rewrites the rollups' derived tables from stored partials.

    Gives the rows of a full rebuild. A raw row dated after the `as_of` of its load stays out, as
    it does from the typed table then; a full rebuild with a later `as_of` takes it. Typed tables
    and derived tables without a rollup are left to `build_layers`. Partials cannot take rows back,
    so raw files must be ingested by the file stream, not by a ledger that loads changed files again.
    """
    if pipeline.changed_files is not None:
        raise ValueError("a refresh needs files that do not change; leave changed_files out")
    raw = ingest_all_new_files(
        pipeline.spark, pipeline.raw_root, f"{pipeline.out_root}/bronze", f"{pipeline.out_root}/_ingest")
    for fact in sorted({r.fact for r in rollups.values()}):
        pipeline.loaded[fact] = fold_new_rows(pipeline, fact, {n: r for n, r in rollups.items() if r.fact == fact})
    star = {"dim_product": conform("products", raw["products"], pipeline.as_of, missing=pipeline.raw_missing)}
    made = {
        name: write_table(
            finished(read_partials(pipeline.spark, pipeline.out_root, name), rollup, star=star, rounding=pipeline.rounding),
            pipeline.out_root, "gold", name)
        for name, rollup in rollups.items()
    }
    pipeline.written.setdefault("gold", {}).update(made)
    return made
