"""The whole pipeline: raw files to derived tables, layer by layer, then the drift check."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.measures import PUBLISHED, Rounding
from tradewind.operators import metadata, metrics
from tradewind.operators.conform import conform_all
from tradewind.operators.rules import check_columns, rejects_seen, validation_log, watched
from tradewind.plans import gold
from tradewind.schema import SOURCES
from tradewind.sources.layers import (
    current_path, metrics_append, read_history, read_table, table_path, write_layer, write_table,
)
from tradewind.sources.loads import load_all_new_files, loaded_rows, read_ledger
from tradewind.streaming.ingest import ingest_all_new_files


class DriftDetected(RuntimeError):
    """A headline metric moved by the threshold or more since the previous run."""


@dataclass
class Pipeline:
    """One run over `raw_root`, writing under `out_root`.

    Each layer reads what the layer before stored, so a table is computed once and a
    failed run can be taken up at any layer. `as_of` stands for today. With a `database`,
    the typed and derived tables are also registered there, with comments and tags. `now` is the
    time alerts are evaluated at, the clock's by default. `loaded` counts the rows that the last
    refresh read of each fact. Raw files are ingested by a file stream, which knows them by name;
    with `changed_files` ("refuse" or "reload") a ledger knows them by length and time too, and
    each file's columns go by its own header.
    """

    spark: SparkSession
    raw_root: str
    out_root: str
    as_of: Column
    cutoff: Column | None = None
    rounding: Rounding = PUBLISHED
    raw_missing: str = "error"
    database: str | None = None
    written: dict[str, dict[str, DataFrame]] = field(default_factory=dict)
    registered: dict[str, str] = field(default_factory=dict)
    loaded: dict[str, int] = field(default_factory=dict)
    now: Column | None = None
    changed_files: str | None = None

    @property
    def rules_missing(self) -> str:
        """What rules do without their column: the same as typed tables."""
        return "skip" if self.raw_missing == "skip" else "raise"

    def stored(self, layer: str, names: Mapping | list) -> dict[str, DataFrame]:
        """Tables of a layer as written by this run or an earlier one."""
        known = self.written.get(layer, {})
        return {n: known[n] if n in known else self._stored(layer, n) for n in names}

    def _stored(self, layer: str, name: str) -> DataFrame:
        if layer == "bronze" and self.changed_files is not None and name in SOURCES:
            return loaded_rows(self.spark, name, *self.ledger_paths(name))
        return read_table(self.spark, self.out_root, layer, name)

    def ledger_paths(self, table: str) -> tuple[str, str]:
        """Where a raw table and its ledger of loaded files are kept."""
        return f"{self.out_root}/bronze/{table}", f"{self.out_root}/_loads/{table}"

    # -- layers ------------------------------------------------------------------------

    def bronze(self) -> dict[str, DataFrame]:
        if self.changed_files is None:
            raw = ingest_all_new_files(
                self.spark, self.raw_root, f"{self.out_root}/bronze", f"{self.out_root}/_ingest"
            )
        else:
            raw = load_all_new_files(
                self.spark, self.raw_root, f"{self.out_root}/bronze", f"{self.out_root}/_loads",
                changed=self.changed_files)
        log = write_table(
            validation_log(raw, self.as_of, missing=self.rules_missing), self.out_root, "bronze_checks", "validation_log")
        return {**raw, "validation_log": log}

    def silver(self) -> dict[str, DataFrame]:
        """Typed tables, and the rejected rows, which are counted while the typed tables are written."""
        raw = self.stored("bronze", list(SOURCES))
        check_columns(raw, self.rules_missing)
        seen = {name: Observation() for name in raw}
        read_once = {name: watched(name, frame, self.as_of, seen[name]) for name, frame in raw.items()}
        typed = metadata.tag_columns(conform_all(read_once, self.as_of, missing=self.raw_missing))
        tables = write_layer(typed, self.out_root, "silver")
        rejects, by_rule = rejects_seen(raw, seen)
        return tables | write_layer(
            {"validation_rejects": rejects, "rejects_by_rule": by_rule}, self.out_root, "silver")

    def star(self) -> dict[str, DataFrame]:
        return self.stored("silver", [s.typed for s in SOURCES.values()])

    def _derive(self, builders: Mapping[str, gold.Builder]) -> dict[str, DataFrame]:
        run = gold.context(self.star(), self.as_of, self.cutoff, self.rounding)
        for name, build in builders.items():
            # Stored at once, so that a table built on another reads it instead of recomputing it.
            run.made[name] = write_table(build(run), self.out_root, "gold", name)
        return {name: run.made[name] for name in builders}

    def tags(self) -> dict[str, DataFrame]:
        """Table properties, where tables are registered, and the list of tagged columns."""
        if self.database is not None:
            typed = [*(s.typed for s in SOURCES.values()), "validation_rejects", "rejects_by_rule"]
            for layer, names in {
                "bronze_checks": ["validation_log"], "silver": typed, "gold": list(gold.BUILDERS),
            }.items():
                self.register(layer, [n for n in names if n not in self.registered and self.exists(layer, n)])
        inventory = metadata.pii_inventory(self.spark, self.star())
        return write_layer({"pii_inventory": inventory}, self.out_root, "ops")

    def exists(self, layer: str, name: str) -> bool:
        """True if an earlier run or this one has stored the table."""
        try:
            read_table(self.spark, self.out_root, layer, name)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return False
        return True

    def register(self, layer: str, names: Iterable[str]) -> None:
        """Makes the current versions of a layer's tables known to the catalog, with comments and tags."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
        for name in names:
            path = current_path(self.spark, self.out_root, layer, name)
            self.spark.sql(f"DROP TABLE IF EXISTS `{self.database}`.`{name}`")
            self.spark.sql(f"CREATE TABLE `{self.database}`.`{name}` USING parquet LOCATION '{path}'")
            self.registered[name] = f"{self.database}.{name}"
        known = {n: self.registered[n] for n in names}
        metadata.comment_tables(self.spark, known)
        metadata.tag_tables(self.spark, known)

    # -- after the layers ------------------------------------------------------------------

    def history_path(self) -> str:
        return table_path(self.out_root, "ops", "metrics_history")

    def drift_check(self, run_id: str | None = None, threshold: float = 10.0, strict: bool = False) -> DataFrame:
        """Records the headline metrics and compares them with the previous run.

        The comparison is read from the history before this run's rows are appended.
        """
        now = datetime.now(timezone.utc)
        run = run_id or now.strftime("%Y%m%dT%H%M%SZ")
        # Read on demand: a table that is missing or unreadable costs its own metrics only.
        found = metrics.headline_metrics(
            self.spark, lambda name: self.stored("gold", [name])[name], rounding=self.rounding, isolate=True
        )
        rows = metrics.snapshot(found, run, F.lit(now))
        previous = metrics.metrics_previous(read_history(self.spark, self.history_path()), run)
        drift = write_table(
            metrics.metrics_drift(found, previous, threshold=threshold), self.out_root, "ops", "metrics_drift"
        )
        metrics_append(rows, self.history_path())
        if strict and not drift.where(F.col("flag") == "DRIFT").isEmpty():
            raise DriftDetected(f"a headline metric moved by {threshold} % or more")
        return drift


    def alerts_path(self) -> str:
        return table_path(self.out_root, "ops", "alert_history")

    def load_times(self) -> DataFrame:
        """(table_name, loaded_at): when each raw table last received a file, by the files' own times."""
        if self.changed_files is not None:
            newest = F.timestamp_micros(F.max("modified")).alias("loaded_at")
            return reduce(DataFrame.unionByName, [
                read_ledger(self.spark, self.ledger_paths(name)[1]).agg(newest).select(F.lit(name).alias("table_name"), "loaded_at")
                for name in SOURCES
            ])
        written = F.max(F.col("_metadata.file_modification_time"))
        parts = [
            frame.agg(written.alias("loaded_at")).select(F.lit(name).alias("table_name"), "loaded_at")
            for name, frame in self.stored("bronze", list(SOURCES)).items()
        ]
        return reduce(DataFrame.unionByName, parts)

    def alert_check(self, run_id: str | None = None, alerts: Sequence[metrics.Alert] | None = None) -> dict[str, DataFrame]:
        """Evaluates the alerts, keeps the evaluations, and returns them with the changes of state.

        Freshness counts from the last load, not from the latest order. The state of each alert
        is its newest evaluation by an earlier run; a run that is repeated replaces its own.
        """
        clock = datetime.now(timezone.utc)
        run = run_id or clock.strftime("%Y%m%dT%H%M%SZ")
        now = F.lit(clock) if self.now is None else self.now
        loads = write_table(self.load_times(), self.out_root, "ops", "load_times")
        wanted = metrics.standard_alerts(now, freshness_of=("load_times", "loaded_at")) if alerts is None else alerts
        found = metrics.alert_eval(
            lambda name: loads if name == "load_times" else self.stored("gold", [name])[name], wanted, rounding=self.rounding)
        current = write_table(
            found.withColumns({"evaluated_at": now.cast("timestamp"), "run_id": F.lit(run)}), self.out_root, "ops", "alert_evaluations")
        before = metrics.alerts_previous(read_history(self.spark, self.alerts_path(), current.schema), run)
        changed = metrics.alert_transitions(before.unionByName(current)).join(
            current.select("alert_name", "evaluated_at"), ["alert_name", "evaluated_at"], "left_semi")
        transitions = write_table(changed, self.out_root, "ops", "alert_transitions")
        metrics_append(current, self.alerts_path())
        return {"alert_evaluations": current, "alert_transitions": transitions}


LAYERS: dict[str, Callable[[Pipeline], dict[str, DataFrame]]] = {
    "bronze": Pipeline.bronze,
    "silver": Pipeline.silver,
    "gold": lambda p: p._derive(gold.GOLD),
    "opportunities": lambda p: p._derive(gold.OPPORTUNITIES),
    "tags": Pipeline.tags,
    "patterns": lambda p: p._derive(gold.PATTERNS),
    "forecast": lambda p: p._derive(gold.FORECAST),
}
STORED_AS = {"opportunities": "gold", "patterns": "gold", "forecast": "gold", "tags": "ops"}


def build_layers(pipeline: Pipeline, only: str | None = None) -> dict[str, dict[str, DataFrame]]:
    """Builds all layers in order, or the named one; the first failure stops the run.

    A full run ends with the drift check and the alerts.
    """
    if only is not None and only not in LAYERS:
        raise ValueError(f"unknown layer {only!r}; choose from {', '.join(LAYERS)}")
    built = {}
    for name, layer in LAYERS.items():
        if only is None or name == only:
            built[name] = layer(pipeline)
            layer_name = STORED_AS.get(name, name)
            pipeline.written.setdefault(layer_name, {}).update(built[name])
            if pipeline.database is not None and layer_name in ("silver", "gold"):
                pipeline.register(layer_name, list(built[name]))
            if pipeline.database is not None and name == "bronze":
                pipeline.register("bronze_checks", ["validation_log"])
    if only is None:
        built["drift"] = {"metrics_drift": pipeline.drift_check()}
        built["alerts"] = pipeline.alert_check()
    return built
