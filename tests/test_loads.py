"""The load ledger, key chains, pair counts and grouped metrics."""

from __future__ import annotations

import gzip
import os
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tradewind.operators import audit, metrics, quality
from tradewind.plans.pipeline import Pipeline, build_layers
from tradewind.plans.refresh import refresh
from tradewind.schema import SOURCES
from tradewind.sources import loads

NAMES = [f.name for f in SOURCES["payments"].fields]


def put(folder, name, rows, header=NAMES):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [",".join(header), *(",".join(r.get(n, "") for n in header) for r in rows)]
    (folder / name).write_text("\n".join(lines) + "\n")


def paid(number, amount):
    return {"payment_id": number, "order_id": f"o{number}", "amount_paid": amount}


def rows_of(frame):
    assert frame.columns == NAMES
    return sorted((r["payment_id"], r["order_id"], r["amount_paid"]) for r in frame.collect())


@pytest.fixture()
def load(spark, tmp_path):
    def run(**options):
        return loads.load_new_files(
            spark, "payments", str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ledger"), **options)

    return run


def test_columns_go_by_each_files_header(spark, tmp_path, load):
    folder = tmp_path / "in"
    folder.mkdir()
    assert rows_of(load()) == []
    put(folder, "a file.csv", [paid("p1", "1")])
    put(folder, "b.csv", [paid("p2", "2")], list(reversed(NAMES)))
    put(folder, "c.csv", [paid("p3", "3")], ["other", *NAMES[4:], "other", *NAMES[:4]])
    (folder / "d.csv").write_text("")
    put(folder, "e.csv", [paid("p5", "5")])
    (folder / "e.csv").write_text("\ufeff" + (folder / "e.csv").read_text())
    with gzip.open(folder / "f.csv.gz", "wt") as out:
        out.write(",".join(f'"{n}"' for n in NAMES) + "\np6,op6,,,,6,,\n")
    found = rows_of(load())
    assert found == [(f"p{i}", f"op{i}", str(i)) for i in (1, 2, 3, 5, 6)]
    assert loads.read_ledger(spark, str(tmp_path / "ledger")).count() == 5
    assert rows_of(load()) == found and not (tmp_path / "out" / "load=2").exists()
    for bad in (NAMES[1:], [*NAMES, NAMES[0]]):
        put(folder, "g.csv", [paid("p7", "7")], bad)
        with pytest.raises(ValueError, match="payment_id"):
            load()
    put(folder, "g.csv", [paid("p7", "7")])
    assert rows_of(load()) == sorted([*found, ("p7", "op7", "7")])


def test_changed_files(spark, tmp_path, load):
    folder = tmp_path / "in"
    put(folder, "a.csv", [paid("p1", "1"), paid("p2", "2")])
    put(folder, "b.csv", [paid("p3", "3")])
    load()
    put(folder, "a.csv", [paid("p1", "10")])
    put(folder, "c.csv", [paid("p4", "4")])
    with pytest.raises(loads.ChangedFiles, match="a.csv"):
        load()
    with pytest.raises(ValueError, match="refuse, reload"):
        load(changed="ignore")
    kept = [("p3", "op3", "3"), ("p4", "op4", "4")]
    assert rows_of(load(changed="reload")) == [("p1", "op1", "10"), *kept]
    # Same length, later time.
    put(folder, "a.csv", [paid("p1", "20")])
    os.utime(folder / "a.csv", (2_000_000_000, 2_000_000_000))
    assert rows_of(load(changed="reload")) == [("p1", "op1", "20"), *kept]
    (folder / "b.csv").unlink()
    assert rows_of(load()) == [("p1", "op1", "20"), *kept]


def test_a_load_that_died_is_done_again(spark, tmp_path, load):
    folder, ledger = tmp_path / "in", tmp_path / "ledger"
    put(folder, "a.csv", [paid("p1", "1")])
    load()
    put(folder, "b.csv", [paid("p2", "2")])
    load()
    # The second load's rows are there, its ledger entry is not.
    (ledger / "load=2").rename(tmp_path / "lost")
    seen = loads.loaded_rows(spark, "payments", str(tmp_path / "out"), str(ledger))
    assert rows_of(seen) == [("p1", "op1", "1")]
    assert rows_of(load()) == [("p1", "op1", "1"), ("p2", "op2", "2")]


def test_pipeline_by_ledger(spark, tmp_path):
    day = F.lit("2001-08-01").cast("date")
    for name, source in SOURCES.items():
        put(tmp_path / "raw" / name, "a.csv", [], [f.name for f in source.fields])
    put(tmp_path / "raw" / "payments", "a.csv", [paid("p1", "1"), paid("p2", "2")])

    def run():
        pipeline = Pipeline(spark, str(tmp_path / "raw"), str(tmp_path / "shop"), day, changed_files="reload")
        build_layers(pipeline, only="bronze")
        # Another run takes the silver layer up from what is stored.
        later = Pipeline(spark, str(tmp_path / "raw"), str(tmp_path / "shop"), day, changed_files="reload")
        build_layers(later, only="silver")
        return later

    assert run().star()["fact_payments"].count() == 2
    put(tmp_path / "raw" / "payments", "a.csv", [paid("p1", "1"), paid("p2", "2"), paid("p3", "3")], NAMES[::-1])
    later = run()
    assert later.star()["fact_payments"].count() == 3
    times = {r["table_name"]: r["loaded_at"] for r in later.load_times().collect()}
    assert len(times) == 9 and None not in times.values()
    with pytest.raises(ValueError, match="changed_files"):
        refresh(later)


# -- keys ------------------------------------------------------------------------------------

def plain_safety(rows, key):
    values = {tuple(r[c] for c in key) for r in rows}
    if len(key) == 1:
        values -= {(None,)}
    return len(rows), len(values), len(rows) - len(values)


@pytest.fixture(scope="module")
def keyed():
    rng = random.Random(4)
    pick = [None, 1, 1, 1, 2, 3]
    return [dict(a_id=rng.choice(pick), b_id=rng.choice([*pick, *range(9)]), c_id=rng.choice(["x", "y\\'", None, ""]),
                 d_id=rng.choice([0.0, -0.0, 1.5])) for _ in range(60)]


SCHEMA = "a_id int, b_id bigint, c_id string, d_id double"


def test_key_chains_count_like_single_keys(spark, keyed):
    frame = spark.createDataFrame([tuple(r.values()) for r in keyed], SCHEMA)
    keys = [("a_id",), ("a_id", "b_id", "c_id"), ("a_id", "b_id"), ("c_id",), ("b_id", "c_id"), ("b_id",)]
    found = quality.key_safety("t", frame, keys)
    assert {r["candidate_key"]: (r["rows"], r["distinct_keys"], r["fanout_rows"]) for r in found.collect()} == {
        " + ".join(k): plain_safety(keyed, k) for k in keys}
    assert quality.key_chains(keys) == [
        [("a_id", "b_id", "c_id"), ("a_id", "b_id"), ("a_id",)], [("b_id", "c_id"), ("c_id",)], [("b_id",)]]
    empty = quality.key_safety("t", frame.limit(0), keys).collect()
    assert [(r["rows"], r["distinct_keys"]) for r in empty] == [(0, 0)] * 6


def scans(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_join_safety_scans(star):
    keys = quality.JOIN_KEYS
    once = sum(scans(quality.key_safety(t, star[t], [k[0]])) * len(quality.key_chains(k)) for t, k in keys.items())
    assert scans(quality.join_safety(star)) == once and sum(len(quality.key_chains(k)) for k in keys.values()) == 7


@pytest.mark.parametrize("columns", [("a_id", "b_id"), ("a_id", "b_id", "c_id", "d_id")])
def test_all_pairs_in_one_shuffle(spark, keyed, columns, tmp_path):
    spark.createDataFrame([tuple(r.values()) for r in keyed], SCHEMA).write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t"))
    pairs = list(combinations(columns, 2))
    found = audit.pair_safety("t", frame, pairs)
    assert {r["candidate_key"]: (r["rows"], r["distinct_keys"], r["fanout_rows"]) for r in found.collect()} == {
        " + ".join(p): plain_safety(keyed, p) for p in pairs}
    assert scans(found) == 1
    # Few values: the sketch holds them all.
    near = audit.sketched_pairs("t", frame, pairs)
    assert {r["candidate_key"]: r["distinct_keys"] for r in near.collect()} == {
        " + ".join(p): plain_safety(keyed, p)[1] for p in pairs}


def test_fanout_by_sketch_finds_the_same_pairs(spark, as_of):
    rows = [(i % 50, i // 2, i % 7 if i else None) for i in range(4_000)]
    tables = {"t": spark.createDataFrame(rows, "x_id int, y_id int, z_id int")}
    exact = audit.audit_model(tables, as_of, kinds=["FANOUT"]).collect()
    near = audit.audit_model(tables, as_of, kinds=["FANOUT"], exact_fanout=False).collect()
    truth = {" + ".join(("xyz"[a] + "_id", "xyz"[b] + "_id")): len(rows) - len({(r[a], r[b]) for r in rows})
             for a, b in combinations(range(3), 2)}
    assert {r["column_name"]: r["affected_rows"] for r in exact} == {k: n for k, n in truth.items() if n}
    assert {r["column_name"] for r in near} == {r["column_name"] for r in exact}
    for r in near:
        if "estimated" not in r["detail"]:
            assert r["affected_rows"] == truth[r["column_name"]]
        assert abs(r["affected_rows"] - truth[r["column_name"]]) <= 0.1 * len(rows)
    assert any("estimated" in r["detail"] for r in near)


# -- metrics -----------------------------------------------------------------------------------

def test_metrics_of_a_table_are_one_pass(spark):
    asked = []
    trend = spark.createDataFrame([(1, 2.0, "a"), (5, None, "b")], "orders int, revenue double, kind string")

    def tables(name):
        asked.append(name)
        return {"t": trend, "u": trend}[name]

    listed = {
        "sum": metrics.TableMetric("t", lambda r, c: F.sum(c("orders"))),
        "best": metrics.TableMetric("t", lambda r, c: F.max(c("revenue")), "kind = 'b'"),
        "of_b": metrics.TableMetric("t", lambda r, c: F.avg(c("orders")), "kind = 'b'"),
        "lost": metrics.TableMetric("gone", lambda r, c: F.sum(c("orders"))),
        "good": metrics.TableMetric("u", lambda r, c: F.min(c("orders"))),
        "bad": metrics.TableMetric("u", lambda r, c: F.min(c("nothing"))),
    }
    want = {"sum": 6.0, "best": None, "of_b": 5.0, "lost": None, "good": 1.0, "bad": None}
    for isolate in (False, True):
        asked.clear()
        found = metrics.headline_metrics(spark, tables, metrics=listed, isolate=isolate)
        assert {r["metric_name"]: r["value"] for r in found.collect()} == want
        assert asked.count("t") == 1
