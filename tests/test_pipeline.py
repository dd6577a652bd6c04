"""Ingest, stored layers, metadata and the whole pipeline."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from tradewind.operators import metadata
from tradewind.plans.pipeline import DriftDetected, Pipeline, build_layers
from tradewind.plans.sample_star import SampleStar
from tradewind.schema import SOURCES
from tradewind.sources.layers import read_history, read_table, write_table
from tradewind.sources.raw import read_raw
from tradewind.streaming.ingest import ingest_new_files

PAYMENTS = "payment_id,order_id,payment_date,payment_method,payment_status,amount_paid,transaction_fee,refund_amount"


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def test_raw_csv_is_text_matched_by_header(spark, tmp_path):
    write(tmp_path / "p" / "a.csv", "order_id,payment_id," + PAYMENTS.split(",", 2)[2], "007,p1,,COD,Success,10.50,0,")
    row = read_raw(spark, "payments", str(tmp_path / "p")).first()
    assert row.asDict() == {
        "payment_id": "p1", "order_id": "007", "payment_date": None, "payment_method": "COD",
        "payment_status": "Success", "amount_paid": "10.50", "transaction_fee": "0", "refund_amount": None,
    }
    write(tmp_path / "q" / "a.csv", "payment_id", "p1")
    with pytest.raises(ValueError, match="lacks the columns"):
        read_raw(spark, "payments", str(tmp_path / "q"))


def test_incremental_ingest_loads_each_file_once(spark, tmp_path):
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    write(tmp_path / "in" / "a.csv", PAYMENTS, "p1,o1,,,,1,,", "p2,o2,,,,2,,")
    for expected in (2, 2):
        assert ingest_new_files(spark, "payments", source, target, marks).count() == expected
    write(tmp_path / "in" / "b.csv", PAYMENTS, "p3,o3,,,,3,,")
    loaded = ingest_new_files(spark, "payments", source, target, marks)
    assert sorted(r["payment_id"] for r in loaded.collect()) == ["p1", "p2", "p3"]


def test_written_tables_are_replaced(spark, tmp_path):
    for size in (5, 3):
        stored = write_table(spark.range(size), str(tmp_path), "gold", "t")
        assert stored.count() == size
    # A table may be made from itself; the version before stays readable.
    again = write_table(stored.where("id > 0"), str(tmp_path), "gold", "t")
    assert (again.count(), stored.count()) == (2, 3)
    assert len(list((tmp_path / "gold" / "t").iterdir())) == 2


def test_a_failed_rewrite_leaves_the_table(spark, tmp_path):
    root = str(tmp_path)
    write_table(spark.range(5), root, "gold", "t")
    with pytest.raises(Exception, match="broken row"):
        write_table(spark.range(9).withColumn("id", F.expr(
            "if(id = 8, cast(raise_error('broken row') as bigint), id)")), root, "gold", "t")
    assert read_table(spark, root, "gold", "t").count() == 5
    assert write_table(spark.range(2), root, "gold", "t").count() == 2
    assert read_table(spark, root, "gold", "t").count() == 2


def test_tags_follow_the_column(spark, tmp_path):
    frame = spark.createDataFrame([("c", "x", 1)], "customer_id string, city string, age int")
    tagged = metadata.tag_columns({"dim_customer": frame})
    kept = {"dim_customer": write_table(tagged["dim_customer"].where("age > 0").select("city", "age"), str(tmp_path), "s", "t")}
    assert [tuple(r) for r in metadata.pii_inventory(spark, kept).collect()] == [
        ("dim_customer", "city", "location", "internal")
    ]
    assert metadata.pii_inventory(spark, {"dim_customer": frame}).isEmpty()


@pytest.fixture(scope="module")
def built(spark, sample, tmp_path_factory):
    root = tmp_path_factory.mktemp("shop")
    raw = SampleStar(spark, sample).raw()
    for table, source in SOURCES.items():
        columns = [
            F.col(f.name) if f.name in raw[table].columns else F.lit(None).cast("string").alias(f.name)
            for f in source.fields
        ]
        raw[table].select(*columns).write.option("header", True).csv(f"{root}/raw/{table}")
    as_of = F.lit("2001-08-01").cast("date")
    pipeline = Pipeline(spark, f"{root}/raw", f"{root}/out", as_of, database="shop")
    return pipeline, build_layers(pipeline), root


def test_all_layers_are_built(built):
    _, made, _ = built
    assert {k: len(v) for k, v in made.items()} == {
        "bronze": 10, "silver": 11, "gold": 12, "opportunities": 5, "tags": 1, "patterns": 8,
        "forecast": 6, "drift": 1, "alerts": 2,
    }
    rejects = {r["silver_table"]: r for r in made["silver"]["validation_rejects"].collect()}
    for source in SOURCES.values():
        row = rejects[source.typed]
        assert row["bronze_rows"] == made["bronze"][source.raw].count()
        assert row["silver_rows"] == made["silver"][source.typed].count()


def test_catalog_carries_comments_and_properties(spark, built):
    described = {r[0]: r[1] for r in spark.sql("DESCRIBE TABLE EXTENDED shop.dim_customer").collect()}
    assert "contains_pii=true" in described["Table Properties"]
    described = {r[0]: r[1] for r in spark.sql("DESCRIBE TABLE EXTENDED shop.fact_order_items").collect()}
    assert described["Comment"].startswith("One row per order_item_id")
    assert spark.table("shop.revenue_trends").count() > 0


def test_rerun_changes_nothing(spark, built):
    first, made, root = built
    before = made["bronze"]["orders"].count()
    again = Pipeline(spark, f"{root}/raw", f"{root}/out", first.as_of)
    for layer in ("bronze", "silver", "gold"):
        built_again = build_layers(again, only=layer)
        assert list(built_again) == [layer]
    assert again.written["bronze"]["orders"].count() == before
    drift = again.drift_check(strict=True)
    assert drift.where("flag IN ('DRIFT', 'baseline')").isEmpty()
    with pytest.raises(DriftDetected):
        again.drift_check(threshold=0.0, strict=True)


def test_tags_alone_in_a_new_object(spark, built):
    first, _, root = built
    again = Pipeline(spark, f"{root}/raw", f"{root}/out", first.as_of, database="shop_again")
    build_layers(again, only="tags")
    described = {r[0]: r[1] for r in spark.sql("DESCRIBE TABLE EXTENDED shop_again.dim_customer").collect()}
    assert "contains_pii=true" in described["Table Properties"]
    described = {r[0]: r[1] for r in spark.sql("DESCRIBE TABLE EXTENDED shop_again.validation_log").collect()}
    assert described["Comment"].startswith("Raw rows that fail")


def test_drift_check_survives_missing_and_corrupt_tables(spark, built):
    first, _, root = built
    copy = root / "damaged"
    shutil.copytree(root / "out" / "gold", copy / "gold")
    (copy / "gold" / "data_quality").rename(copy / "data_quality")
    for part in (copy / "gold" / "cohort_retention").glob("v*/*.parquet"):
        part.write_bytes(b"no parquet")
        (part.parent / f".{part.name}.crc").unlink()
    again = Pipeline(spark, f"{root}/raw", str(copy), first.as_of)
    again.drift_check(run_id="damaged")
    values = {r["metric_name"]: r["value"] for r in read_history(spark, again.history_path()).collect()}
    whole = {r["metric_name"]: r["value"] for r in read_history(spark, first.history_path()).collect()}
    lost = {"dq_worst_check_pct", "retention_m1_avg_pct"}
    assert all(whole[n] is not None for n in lost)
    assert values == {n: None if n in lost else v for n, v in whole.items()}
    again.drift_check(run_id="damaged")
    assert read_history(spark, again.history_path()).count() == len(values)


def test_unknown_layer(built):
    with pytest.raises(ValueError, match="unknown layer"):
        build_layers(built[0], only="platinum")
