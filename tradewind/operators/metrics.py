"""Headline metrics, their history and drift, and threshold alerts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.functions.ledger import rows_from_columns
from tradewind.functions.measures import PUBLISHED, Rounding

Tables = Callable[[str], DataFrame]
Metric = Callable[[Tables, Rounding], DataFrame]

HISTORY_SCHEMA = "metric_name string, value double, snapshot_ts timestamp, run_id string"


@dataclass(frozen=True)
class TableMetric:
    """A metric that is one aggregate over one derived table, over its rows of `where` only.

    `value` builds the aggregate from the rounding and a function that gives a column by its
    name, null outside `where`; so metrics of one table can be taken in one pass.
    """

    table: str
    value: Callable[[Rounding, Callable[[str], Column]], Column]
    where: str | None = None

    def column(self, rounding: Rounding) -> Column:
        def of(name: str) -> Column:
            return F.col(name) if self.where is None else F.when(F.expr(self.where), F.col(name))

        return self.value(rounding, of).cast("double")

    def __call__(self, tables: Tables, rounding: Rounding) -> DataFrame:
        return tables(self.table).agg(self.column(rounding).alias("value"))


# The names of the headline metrics, and the labels they look up.
HEADLINE: dict[str, Metric] = {
    "total_orders": TableMetric("revenue_trends", lambda r, c: F.sum(c("orders"))),
    "total_revenue_cr": TableMetric("revenue_trends", lambda r, c: r.to_crore(F.sum(c("revenue")))),
    # Unweighted over warehouses: each warehouse's rate counts the same.
    "same_day_avg_delay_pct": TableMetric(
        "delivery_performance", lambda r, c: r.to_mean(F.avg(c("delay_rate_pct"))),
        "shipping_method = 'Same-Day'"),
    "avg_delay_rating": TableMetric(
        "delay_impact_on_experience", lambda r, c: F.max(c("avg_rating")),
        "delivery_outcome = 'Delayed'"),
    "targeting_precision_worst_pct": TableMetric(
        "campaign_targeting_precision", lambda r, c: F.min(c("targeting_precision_pct"))),
    "cancel_rate_no_discount_pct": TableMetric(
        "discount_effectiveness", lambda r, c: F.max(c("cancel_rate_pct")),
        "discount_band = '1. No discount'"),
    "cancel_rate_20pct_discount": TableMetric(
        "discount_effectiveness", lambda r, c: F.max(c("cancel_rate_pct")),
        "discount_band = '4. 20%+'"),
    "retention_m1_avg_pct": TableMetric("cohort_retention", lambda r, c: r.to_mean(F.avg(c("retention_m1_pct")))),
    "repeat_purchase_pct": TableMetric(
        "repeat_purchase_timing", lambda r, c: F.max(c("pct_repeat_at_least_once"))),
    "dq_worst_check_pct": TableMetric("data_quality", lambda r, c: F.max(c("pct_affected"))),
}


def _of_one_table(tables: Tables, table: str, metrics: Mapping[str, TableMetric], rounding: Rounding) -> DataFrame:
    """(metric_name, value) of metrics of one table, in one pass over it."""
    totals = tables(table).agg(*[m.column(rounding).alias(f"_{i}") for i, m in enumerate(metrics.values())])
    return rows_from_columns(
        totals, "metric_name", [(name, {"value": F.col(f"_{i}")}) for i, name in enumerate(metrics)])


def headline_metrics(
    spark: SparkSession,
    tables: Tables,
    *,
    metrics: Mapping[str, Metric] = HEADLINE,
    rounding: Rounding = PUBLISHED,
    isolate: bool = False,
) -> DataFrame:
    """(metric_name, value), one row per metric.

    Metrics of one table are one aggregate, so each derived table is built once. If that fails,
    each of them is taken by itself: a metric whose table or column is missing gives NULL and the
    others go on. With `isolate` each aggregate also runs by itself, so that one failing at run
    time does too, a job that aborts on an unreadable file included; only the single values
    then pass through the driver.
    """
    by_table: dict[str, dict[str, TableMetric]] = {}
    for name, metric in metrics.items():
        if isinstance(metric, TableMetric):
            by_table.setdefault(metric.table, {})[name] = metric
    parts, single = [], {n: m for n, m in metrics.items() if not isinstance(m, TableMetric)}

    def taken(found: DataFrame) -> DataFrame:
        found = found.select("metric_name", F.col("value").cast("double").alias("value"))
        if not isolate:
            return found
        return spark.createDataFrame([tuple(r) for r in found.collect()], "metric_name string, value double")

    for table, of_table in by_table.items():
        try:
            parts.append(taken(_of_one_table(tables, table, of_table, rounding)))
        except (PySparkException, Py4JJavaError, KeyError):
            single.update(of_table)
    for name, metric in single.items():
        try:
            parts.append(taken(metric(tables, rounding).withColumn("metric_name", F.lit(name))))
        except (PySparkException, Py4JJavaError, KeyError):
            parts.append(spark.createDataFrame([(name, None)], "metric_name string, value double"))
    return reduce(DataFrame.unionByName, parts)


def snapshot(metrics: DataFrame, run_id: str, taken_at: Column) -> DataFrame:
    """Metrics as rows for the history table."""
    return metrics.select(
        "metric_name", "value", taken_at.cast("timestamp").alias("snapshot_ts"), F.lit(run_id).alias("run_id")
    )


def metrics_previous(history: DataFrame, current_run: str) -> DataFrame:
    """Latest value of each metric from any other run.

    An aggregate rather than a window: only the best row per metric and map task is shuffled.
    """
    latest = F.max_by(F.struct("value"), F.struct("snapshot_ts", "run_id"))
    return (
        history.where(F.col("run_id") != current_run)
        .groupBy("metric_name")
        .agg(latest.alias("_latest"))
        .select("metric_name", F.col("_latest.value").alias("previous"))
    )


def metrics_drift(current: DataFrame, previous: DataFrame, *, threshold: float = 10.0) -> DataFrame:
    """Percent change of each metric against its previous value, flagged from `threshold` on.

    No previous value gives `baseline`, no current one `ERROR`. A change from 0 is infinite.
    The change is taken relative to the size of the old value, so its sign is the direction.
    """
    old, new = F.col("previous"), F.col("value")
    change = F.when(old != 0, (new - old) * 100.0 / F.abs(F.when(old != 0, old))).otherwise(
        F.when(new == old, F.lit(0.0)).otherwise(F.signum(new) * F.lit(float("inf")))
    )
    known = new.isNotNull() & old.isNotNull()
    flag = (
        F.when(new.isNull(), "ERROR")
        .when(old.isNull(), "baseline")
        .when(F.abs(F.col("change_pct")) >= threshold, "DRIFT")
        .otherwise("ok")
    )
    return (
        current.select("metric_name", "value")
        .join(previous, "metric_name", "left")
        .withColumn("change_pct", F.when(known, change))
        .select("metric_name", "previous", F.col("value").alias("current"), "change_pct", flag.alias("flag"))
    )


# -- alerts ----------------------------------------------------------------------------------

COMPARE: dict[str, Callable[[Column, float], Column]] = {
    "GREATER_THAN": lambda value, limit: value > limit,
    "LESS_THAN": lambda value, limit: value < limit,
}


@dataclass(frozen=True)
class Alert:
    """Breached when `value` of the derived tables compares to the threshold by `op`."""

    name: str
    metric: Metric
    op: str
    threshold: float


def freshness(table: str, column: str, now: Column) -> Metric:
    """Whole hours from the latest value of a date or timestamp column to `now`."""

    def hours(rounding: Rounding, of: Callable[[str], Column]) -> Column:
        return F.timestamp_diff("HOUR", F.max(of(column)).cast("timestamp"), now.cast("timestamp"))

    return TableMetric(table, hours)


def standard_alerts(now: Column, *, freshness_of: tuple[str, str] = ("revenue_trends", "month")) -> list[Alert]:
    """The three standing alerts.

    Freshness is measured on `freshness_of` (table, column). The default, the latest order
    month, counts from the start of that month and so is in breach on most days; give a
    load timestamp where the tables carry one.
    """
    # Thresholds of the alerts.
    return [
        Alert("gold_tables_stale", freshness(*freshness_of, now), "GREATER_THAN", 36.0),
        Alert("same_day_delay_rate", HEADLINE["same_day_avg_delay_pct"], "GREATER_THAN", 65.0),
        Alert("worst_quality_check", HEADLINE["dq_worst_check_pct"], "GREATER_THAN", 1.0),
    ]


def alert_eval(
    tables: Tables, alerts: Sequence[Alert], *, rounding: Rounding = PUBLISHED
) -> DataFrame:
    """(alert_name, value, op, threshold, breached), one row per alert; no value is no breach."""
    parts = [
        alert.metric(tables, rounding).select(
            F.lit(alert.name).alias("alert_name"),
            F.col("value").cast("double").alias("value"),
            F.lit(alert.op).alias("op"),
            F.lit(alert.threshold).alias("threshold"),
            F.coalesce(COMPARE[alert.op](F.col("value"), alert.threshold), F.lit(False)).alias("breached"),
        )
        for alert in alerts
    ]
    return reduce(DataFrame.unionByName, parts)


def alerts_previous(evaluations: DataFrame, run_id: str) -> DataFrame:
    """The newest evaluation of each alert by another run than `run_id`."""
    newest = F.row_number().over(Window.partitionBy("alert_name").orderBy(F.desc("evaluated_at"), F.desc("run_id")))
    return evaluations.where(F.col("run_id") != run_id).withColumn("_nth", newest).where("_nth = 1").drop("_nth")


def alert_transitions(evaluations: DataFrame) -> DataFrame:
    """Evaluations that changed an alert's state: breaches and recoveries.

    The first evaluation counts only if it is a breach. Expects (alert_name, evaluated_at,
    value, breached); a window holds one alert's evaluations, one per run.
    """
    before = F.lag("breached", 1, False).over(
        Window.partitionBy("alert_name").orderBy("evaluated_at")
    )
    return (
        evaluations.withColumn("_before", before)
        .where(F.col("breached") != F.col("_before"))
        .select(
            "alert_name",
            "evaluated_at",
            "value",
            F.when(F.col("breached"), "BREACH").otherwise("RECOVERY").alias("transition"),
        )
    )
