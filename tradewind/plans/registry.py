"""Every operator as a query over a folder of sample tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.measures import FINE
from tradewind.operators import audit, conform, descriptive, metrics, patterns, reports, rollups, rules
from tradewind.plans import gold
from tradewind.plans.sample_star import SampleStar
from tradewind.schema import SOURCES

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2001-08-01"
CUTOFF = "2001-01-01"


def _date(text: str):
    return F.lit(text).cast("date")


def gold_context(spark: SparkSession, folder: str) -> gold.Context:
    return gold.Context(SampleStar(spark, folder).star(), _date(AS_OF), _date(CUTOFF), FINE)


def _derived(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        result = gold_context(spark, folder).table(name)
        if name == "campaign_roi":
            # Kept unrounded in the table itself; engines differ in its last bits.
            return result.withColumn("roi", F.round("roi", 6))
        return result

    return run


def _typed(table: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        raw = SampleStar(spark, folder).raw()[table]
        typed = conform.conform(table, raw, _date(AS_OF), missing="skip")
        if "order_timestamp" in typed.columns:
            # Wall-clock time: independent of the session's time zone.
            return typed.withColumn("order_timestamp", F.col("order_timestamp").cast("timestamp_ntz"))
        return typed

    return run


def _raw_report(report: Callable[..., DataFrame]) -> Query:
    return lambda spark, folder: report(
        SampleStar(spark, folder).raw(), _date(AS_OF), missing="skip")


def _rfm_scores(spark: SparkSession, folder: str) -> DataFrame:
    scores = patterns.rfm_scores(SampleStar(spark, folder).fact_orders(), _date(AS_OF))
    return scores.withColumn("monetary", FINE.to_money(F.col("monetary")))


def _category_performance_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    star = SampleStar(spark, folder)
    return descriptive.category_performance(star.fact_order_items(), star.dim_product(), broadcast_rows=0, rounding=FINE)


def _category_affinity_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    star = SampleStar(spark, folder)
    return patterns.category_affinity(star.fact_order_items(), star.dim_product(), broadcast_rows=0)


# Loads that the incremental queries deal a fact's rows to.
LOADS = 3


def _incremental(name: str) -> Query:
    """A derived table from the partials of several loads, added up."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        star, rollup = SampleStar(spark, folder).star(), rollups.ROLLUPS[name]
        fact = star[rollup.fact]
        load = F.pmod(F.xxhash64(*[c for c in ("order_id", "product_id") if c in fact.columns]), F.lit(LOADS))
        return rollups.finished(rollups.partials_of_loads(fact, rollup, load), rollup, star=star, rounding=FINE)

    return run


# -- audit -----------------------------------------------------------------------------------

# The sample tables name their keys ...key and differently on both sides of a reference.
SAMPLE_PATTERNS = audit.Patterns(ids=r"(_id$|^id$|key$)")
SAMPLE_FOREIGN_KEYS = {
    ("nation", "n_regionkey"): ("region", "r_regionkey"),
    ("customer", "c_nationkey"): ("nation", "n_nationkey"),
    ("supplier", "s_nationkey"): ("nation", "n_nationkey"),
    ("orders", "o_custkey"): ("customer", "c_custkey"),
    ("lineitem", "l_orderkey"): ("orders", "o_orderkey"),
    ("lineitem", "l_partkey"): ("part", "p_partkey"),
    ("lineitem", "l_suppkey"): ("supplier", "s_suppkey"),
    ("events", "user_id"): ("customer", "c_custkey"),
    ("labels", "doc_id"): ("documents", "doc_id"),
}


def _audited(kind: str | None = None, summary: bool = False) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        star = SampleStar(spark, folder).star()
        found = audit.audit_model(star, _date(AS_OF), kinds=None if kind is None else [kind], write_once=True)
        return audit.audit_summary(found) if summary else found

    return run


def _audit_sample_tables(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audit_model(
        SampleStar(spark, folder).sample_tables(), _date(AS_OF),
        patterns=SAMPLE_PATTERNS, fk_map=SAMPLE_FOREIGN_KEYS,
    )


# -- metrics and alerts ------------------------------------------------------------------------

CURRENT_RUN = "2001-08"
NOW = "2001-08-02 12:00:00"


def _tables(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    """Derived tables by name, and typed tables for those who ask for one."""
    made = gold_context(spark, folder)
    return lambda name: made.star[name] if name in made.star else made.table(name)


def monthly_history(trend: DataFrame) -> DataFrame:
    """Each month of the revenue trend as one run of a metric history."""
    numbers = ["orders", "revenue", "avg_order_value", "delivered_pct"]
    return trend.select("month", *[F.col(n).cast("double").alias(n) for n in numbers]).unpivot(
        "month", numbers, "metric_name", "value"
    ).select(
        "metric_name",
        "value",
        F.col("month").cast("timestamp").alias("snapshot_ts"),
        F.date_format("month", "yyyy-MM").alias("run_id"),
    )


def _headline(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.headline_metrics(spark, _tables(spark, folder), rounding=FINE)


def _previous(spark: SparkSession, folder: str) -> DataFrame:
    history = monthly_history(_tables(spark, folder)("revenue_trends"))
    return metrics.metrics_previous(history, CURRENT_RUN)


def _drift(spark: SparkSession, folder: str) -> DataFrame:
    history = monthly_history(_tables(spark, folder)("revenue_trends"))
    current = history.where(F.col("run_id") == CURRENT_RUN)
    drift = metrics.metrics_drift(current, metrics.metrics_previous(history, CURRENT_RUN))
    return drift.withColumn("change_pct", F.round("change_pct", 6))


def _alerts(spark: SparkSession, folder: str) -> DataFrame:
    alerts = metrics.standard_alerts(F.lit(NOW))
    return metrics.alert_eval(_tables(spark, folder), alerts, rounding=FINE)


def _transitions(spark: SparkSession, folder: str) -> DataFrame:
    share = F.col("delivered_pct")
    evaluations = _tables(spark, folder)("revenue_trends").select(
        F.lit("delivered_share_low").alias("alert_name"),
        F.col("month").alias("evaluated_at"),
        share.alias("value"),
        metrics.COMPARE["LESS_THAN"](share, 33.0).alias("breached"),
    )
    return metrics.alert_transitions(evaluations)


def _report(name: str) -> Query:
    return lambda spark, folder: reports.report(name, spark, _tables(spark, folder), rounding=FINE)


def registered_queries() -> dict[str, Query]:
    found: dict[str, Query] = {f"silver_{s.typed}": _typed(raw) for raw, s in SOURCES.items()}
    found["bronze_validation_log"] = _raw_report(rules.validation_log)
    found["silver_validation_rejects"] = _raw_report(rules.validation_rejects)
    found["silver_rejects_by_rule"] = _raw_report(rules.rejects_by_rule)
    found.update({name: _derived(name) for name in gold.BUILDERS})
    found.update({f"incremental_{name}": _incremental(name) for name in rollups.ROLLUPS})
    found["category_performance_shuffled"] = _category_performance_shuffled
    found["category_affinity_shuffled"] = _category_affinity_shuffled
    found["rfm_scores"] = _rfm_scores
    found["profile_tables"] = lambda spark, folder: audit.profile_tables(
        SampleStar(spark, folder).sample_tables())
    found["profile_star"] = lambda spark, folder: audit.profile_tables(SampleStar(spark, folder).star())
    for kind in audit.SEVERITY:
        found[f"audit_{kind.lower().replace('-', '_')}"] = _audited(kind)
    found["audit_model"] = _audited()
    found["audit_summary"] = _audited(summary=True)
    found["audit_sample_tables"] = _audit_sample_tables
    found["headline_metrics"] = _headline
    found["metrics_previous"] = _previous
    found["metrics_drift"] = _drift
    found["alert_eval"] = _alerts
    found["alert_transitions"] = _transitions
    found.update({f"report_{name}": _report(name) for name in reports.REPORT_NAMES})
    return found


def run_query(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return registered_queries()[name](spark, folder)
