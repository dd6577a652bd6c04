"""Audit on planted faults; metrics, drift and alerts on hand-written histories."""

from __future__ import annotations

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tradewind.operators import audit, metrics, reports


@pytest.fixture(scope="module")
def tables(spark):
    customers = spark.createDataFrame(
        [(i, "x", None if i > 2 else "c", float(i), -1.0 if i == 3 else 1.0) for i in range(10)],
        "customer_id long, kind string, city string, loss_pct double, spend double")
    orders = spark.createDataFrame(
        [(i if i < 19 else 18, i % 12, 1 + i % 3, "2001-01-01" if i else "2999-01-01", 50.0 * i) for i in range(20)],
        "order_id long, customer_id long, line_id int, made string, discount_pct double",
    ).withColumn("made", F.col("made").cast("date"))
    visits = spark.createDataFrame([(i % 5, None) for i in range(8)], "customer_id long, note string")
    return {"customers": customers, "orders": orders, "visits": visits}


def found(frame):
    return {(r["kind"], r["table_name"], r["column_name"]): r["affected_rows"] for r in frame.collect()}


def test_planted_findings(tables, as_of):
    got = found(audit.audit_model(tables, as_of))
    assert got == {
        ("PK", "customers", "customer_id"): 10,
        ("PK", "customers", "loss_pct"): 10,
        ("CONSTANT", "customers", "kind"): 10,
        ("CONSTANT", "customers", "city"): 3,
        ("NULLS", "customers", "city"): 7,
        ("NEGATIVE", "customers", "spend"): 1,
        ("NO-PK", "visits", "-"): 8,
        ("NULLS", "visits", "note"): 8,
        ("NEAR-KEY", "orders", "order_id"): 1,
        ("FUTURE", "orders", "made"): 1,
        ("RANGE", "orders", "discount_pct"): 17,
        ("ORPHAN", "orders", "customer_id"): 2,
        ("FANOUT", "orders", "customer_id + line_id"): 8,
        ("CARTESIAN", "orders x visits", "customer_id"): None,
        ("PK", "orders", "discount_pct"): 20,
    }


def test_kinds_decide_what_is_counted_exactly(tables, as_of, monkeypatch):
    counted = []
    exactly = audit._column_counts
    monkeypatch.setattr(audit, "_column_counts", lambda t, frame, columns: (
        counted.extend(c.name for c in columns), exactly(t, frame, columns))[1])
    assert set(found(audit.audit_model(tables, as_of, kinds=["NULLS"]))) == {
        ("NULLS", "customers", "city"), ("NULLS", "visits", "note")}
    assert counted == []
    assert set(found(audit.audit_model(tables, as_of, kinds=["CONSTANT"]))) == {
        ("CONSTANT", "customers", "kind"), ("CONSTANT", "customers", "city")}
    assert "customer_id" not in counted


def test_hashes_prove_a_text_key_and_values_count_the_rest(spark, as_of, monkeypatch):
    frame = spark.range(2000).select(
        F.concat(F.lit("k-"), "id").alias("text_id"),
        F.concat(F.lit("k-"), F.greatest("id", F.lit(20))).alias("near_id"),
        (F.col("id") / 2).alias("half"), F.floor(F.col("id") / 2).cast("double").alias("twice"),
        F.when(F.col("id") > 0, F.col("id")).alias("gap"), (F.col("id") % 5).cast("string").alias("few"))
    counted = []
    exactly = audit._column_counts
    monkeypatch.setattr(audit, "_column_counts", lambda t, frame, columns: (
        counted.extend(c.name for c in columns), exactly(t, frame, columns))[1])
    got = found(audit.audit_model({"t": frame}, as_of, kinds=["PK", "NEAR-KEY", "CONSTANT", "NO-PK"]))
    assert got == {("PK", "t", "text_id"): 2000, ("PK", "t", "half"): 2000, ("NEAR-KEY", "t", "near_id"): 20}
    assert counted == ["near_id"]


def test_tables_are_written_once_with_the_columns_looked_at(tables, as_of):
    customers = tables["customers"].join(tables["orders"].groupBy("customer_id").count(), "customer_id", "left").drop("count")
    joined = {**tables, "customers": customers}
    assert found(audit.audit_model(joined, as_of, write_once=True)) == found(audit.audit_model(tables, as_of))
    orphans = audit.audit_model(joined, as_of, kinds=["ORPHAN"], write_once=True)
    assert found(orphans) == found(audit.audit_model(tables, as_of, kinds=["ORPHAN"]))
    written = audit._written(joined, audit.Patterns(), {("visits", "note"): ("customers", "kind")}, ids_only=True)
    assert written["customers"].columns == ["customer_id", "kind"] and written["visits"].columns == ["customer_id", "note"]
    plan = written["customers"]._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "FileScan" in plan


def test_worst_first_and_summary(tables, as_of):
    findings = audit.audit_model(tables, as_of)
    order = [r["severity"] for r in findings.collect()]
    assert order == sorted(order)
    summary = {r["kind"]: r["findings"] for r in audit.audit_summary(findings).collect()}
    assert summary["PK"] == 3 and summary["ORPHAN"] == 1


def test_strict_audit_fails_on_orphans(tables, as_of):
    with pytest.raises(audit.OrphansFound):
        audit.audit_model(tables, as_of, kinds=["ORPHAN"], strict=True)
    audit.audit_model({"customers": tables["customers"]}, as_of, kinds=["ORPHAN"], strict=True)
    with pytest.raises(ValueError):
        audit.audit_model(tables, as_of, kinds=["ODD"])


def test_empty_table_has_no_key(spark, as_of):
    empty = {"t": spark.createDataFrame([], "a_id long, b string")}
    assert found(audit.audit_model(empty, as_of)) == {("NO-PK", "t", "-"): 0}
    assert [(r["rows"], r["distinct"]) for r in audit.profile_tables(empty).collect()] == [(0, 0)] * 2


def test_profile_counts(spark):
    frame = spark.createDataFrame(
        [(0.0, "a" * 100, [1], b"x", True), (-0.0, "a" * 100, [1], b"x", None), (1.0, "a" * 99 + "b", None, b"y", True)],
        "d double, s string, l array<int>, b binary, f boolean")
    got = {r["column_name"]: (r["data_type"], r["rows"], r["non_null"], r["distinct"])
           for r in audit.profile_tables({"t": frame}).collect()}
    assert got == {
        "d": ("double", 3, 3, 2), "s": ("string", 3, 3, 2), "l": ("array", 3, 2, 1),
        "b": ("binary", 3, 3, 2), "f": ("boolean", 3, 2, 1),
    }


def test_drift(spark):
    now = spark.createDataFrame(
        [("up", 12.0), ("same", 5.0), ("new", 1.0), ("gone", None), ("from_zero", 3.0), ("zero", 0.0), ("debt", -5.0)],
        "metric_name string, value double")
    before = spark.createDataFrame(
        [("up", 10.0), ("same", 5.2), ("gone", 1.0), ("from_zero", 0.0), ("zero", 0.0), ("debt", -10.0)],
        "metric_name string, previous double")
    got = {r["metric_name"]: (r["change_pct"], r["flag"]) for r in metrics.metrics_drift(now, before).collect()}
    assert got["up"] == (20.0, "DRIFT") and got["same"][1] == "ok"
    assert got["new"] == (None, "baseline") and got["gone"] == (None, "ERROR")
    assert got["from_zero"] == (math.inf, "DRIFT") and got["zero"] == (0.0, "ok")
    assert got["debt"] == (50.0, "DRIFT")  # less debt is a rise


def test_previous_is_the_latest_other_run(spark):
    history = spark.createDataFrame([
        ("m", 1.0, datetime(2001, 1, 1), "a"), ("m", None, datetime(2001, 1, 2), "b"),
        ("m", 9.0, datetime(2001, 1, 3), "c"), ("k", 4.0, datetime(2001, 1, 1), "a"),
    ], metrics.HISTORY_SCHEMA)
    got = {r["metric_name"]: r["previous"] for r in metrics.metrics_previous(history, "c").collect()}
    assert got == {"m": None, "k": 4.0}


def test_failing_metrics_become_null(spark):
    trend = spark.createDataFrame([(5, 10.0)], "orders int, revenue double")

    def tables(name):
        return {"revenue_trends": trend}[name]

    def divides(tables, rounding):
        return tables("revenue_trends").agg((F.lit(1) / (F.max("orders") - 5)).alias("value"))

    listed = {**metrics.HEADLINE, "breaks": divides}
    got = {r["metric_name"]: r["value"]
           for r in metrics.headline_metrics(spark, tables, metrics=listed, isolate=True).collect()}
    assert got["total_orders"] == 5.0 and got["breaks"] is None and got["dq_worst_check_pct"] is None
    assert len(got) == 11


def test_alerts_and_transitions(spark):
    states = [True, True, False, True]
    rows = [("a", i, float(i), s) for i, s in enumerate(states)] + [("b", 0, 0.0, False), ("b", 1, 1.0, False)]
    evaluations = spark.createDataFrame(rows, "alert_name string, evaluated_at int, value double, breached boolean")
    got = [(r["evaluated_at"], r["transition"])
           for r in metrics.alert_transitions(evaluations).orderBy("evaluated_at").collect()]
    assert got == [(0, "BREACH"), (2, "RECOVERY"), (3, "BREACH")]


def test_freshness(spark):
    loads = spark.createDataFrame([(datetime(2001, 1, 1, 0, 30),)], "loaded_at timestamp")
    alert = metrics.Alert("stale", metrics.freshness("loads", "loaded_at", F.lit("2001-01-02 13:00:00")), "GREATER_THAN", 36.0)
    row = metrics.alert_eval(lambda name: loads, [alert]).first()
    assert (row["value"], row["breached"]) == (36.0, False)
    nothing = metrics.alert_eval(lambda name: loads.limit(0), [alert]).first()
    assert (nothing["value"], nothing["breached"]) == (None, False)


def test_unknown_report(spark):
    with pytest.raises(KeyError):
        reports.report("nothing", spark, lambda name: None)


def test_a_corrupt_table_isolates(spark, tmp_path):
    from tradewind.operators import metrics

    spark.range(3).withColumn("value", F.col("id").cast("double")).write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t"))
    for part in (tmp_path / "t").glob("*.parquet"):
        part.write_bytes(b"no parquet here")
    good = spark.createDataFrame([(2.0,)], "value double")
    found = metrics.headline_metrics(
        spark, lambda name: frame, isolate=True,
        metrics={"bad": lambda t, r: t("x").agg(F.sum("value").alias("value")), "good": lambda t, r: good})
    assert {r.metric_name: r.value for r in found.collect()} == {"bad": None, "good": 2.0}


def test_a_repeated_run_is_stored_once(spark, tmp_path):
    from tradewind.sources import layers

    path = str(tmp_path / "history")
    rows = spark.sql("select 'm' metric_name, 1.0D value, timestamp'2024-01-01' snapshot_ts, 'r1' run_id")
    for run in ("r1", "r2", "r1"):
        layers.metrics_append(rows.withColumn("run_id", F.lit(run)), path)
    assert layers.read_history(spark, path).count() == 2


def test_profile_reads_a_table_once(spark, sample):
    orders = spark.read.parquet(f"{sample}/orders.parquet")
    counts = audit._column_counts("orders", orders, orders.schema.fields)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2
