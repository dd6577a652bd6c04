"""Validation rules as data: one list drives the log, the filters and the reject counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tradewind.functions.ledger import rows_from_columns
from tradewind.functions.measures import not_blank, rows
from tradewind.schema import SOURCES


@dataclass(frozen=True)
class Rule:
    """What a raw column must satisfy.

    `logged` rules appear in the validation log. `filters` rules decide which rows the
    typed table keeps; there a NULL value fails too, unless `null_ok`.
    """

    table: str
    column: str
    kind: str
    logged: bool = True
    filters: bool = True
    null_ok: bool = False

    @property
    def label(self) -> str:
        return f"{self.column}:{self.kind}"


# The checked columns and the names of the rule kinds.
RULES: tuple[Rule, ...] = (
    Rule("customers", "customer_id", "not_null_or_blank"),
    Rule("customers", "customer_signup_date", "parses_as_date", filters=False),
    Rule("products", "product_id", "not_null_or_blank"),
    Rule("products", "price", "parses_as_nonneg_double"),
    Rule("products", "cost_price", "parses_as_nonneg_double"),
    Rule("orders", "order_id", "not_null_or_blank"),
    Rule("orders", "customer_id", "not_null_or_blank", logged=False),
    Rule("orders", "order_date", "parses_as_date"),
    Rule("orders", "order_date", "not_in_future", logged=False),
    Rule("orders", "final_amount", "parses_as_nonneg_double"),
    Rule("orders", "discount_percentage", "parses_as_pct_0_100"),
    Rule("order_items", "order_item_id", "not_null_or_blank"),
    Rule("order_items", "order_id", "not_null_or_blank", logged=False),
    Rule("order_items", "quantity", "parses_as_positive_int"),
    Rule("order_items", "unit_price", "parses_as_nonneg_double", logged=False),
    Rule("payments", "payment_id", "not_null_or_blank"),
    Rule("payments", "order_id", "not_null_or_blank"),
    Rule("payments", "amount_paid", "parses_as_nonneg_double", logged=False),
    Rule("shipments", "shipment_id", "not_null_or_blank"),
    Rule("shipments", "order_id", "not_null_or_blank", logged=False),
    Rule("shipments", "delivery_days", "parses_as_nonneg_double", null_ok=True),
    Rule("returns", "return_id", "not_null_or_blank"),
    Rule("returns", "order_id", "not_null_or_blank", logged=False),
    Rule("returns", "refund_amount", "parses_as_nonneg_double", logged=False, null_ok=True),
    Rule("customer_reviews", "review_id", "not_null_or_blank"),
    Rule("customer_reviews", "order_id", "not_null_or_blank", logged=False),
    Rule("customer_reviews", "rating", "parses_as_int_1_to_5"),
    Rule("marketing_campaigns", "campaign_id", "not_null_or_blank"),
)


def rules_of(table: str) -> list[Rule]:
    return [r for r in RULES if r.table == table]


def holds(rule: Rule, as_of: Column) -> Column:
    """True where the value satisfies the rule, False where it does not or is NULL."""
    raw = F.col(rule.column)
    if rule.kind == "not_null_or_blank":
        return not_blank(raw)
    number = raw.try_cast("double")
    # NaN compares as larger than any number, so it must be excluded by name; an infinite
    # amount would make every sum infinite.
    real = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))
    tests = {
        "parses_as_date": lambda: raw.try_cast("date").isNotNull(),
        "not_in_future": lambda: raw.try_cast("date") <= as_of,
        "parses_as_nonneg_double": lambda: real & (number >= 0),
        "parses_as_pct_0_100": lambda: real & number.between(0, 100),
        "parses_as_positive_int": lambda: raw.try_cast("int") > 0,
        "parses_as_int_1_to_5": lambda: raw.try_cast("int").between(1, 5),
    }
    if rule.kind not in tests:
        raise ValueError(f"unknown rule kind {rule.kind!r}")
    return F.coalesce(tests[rule.kind](), F.lit(False))


def log_failure(rule: Rule, as_of: Column) -> Column:
    """True where the log counts the row: a present value that fails, or a missing key."""
    failed = ~holds(rule, as_of)
    if rule.kind == "not_null_or_blank":
        return failed
    return F.col(rule.column).isNotNull() & failed


def filter_failure(rule: Rule, as_of: Column) -> Column:
    """True where the rule rejects the row from the typed table."""
    failed = ~holds(rule, as_of)
    return failed & F.col(rule.column).isNotNull() if rule.null_ok else failed


def check_columns(raw: Mapping[str, DataFrame], missing: str) -> None:
    """Raises for rules whose column a table lacks, unless `missing` is "skip"."""
    if missing not in ("raise", "skip"):
        raise ValueError(f"missing is 'raise' or 'skip', not {missing!r}")
    absent = [f"{t}.{r.column}" for t, f in raw.items() for r in rules_of(t) if r.column not in f.columns]
    if absent and missing == "raise":
        raise ValueError(f"rules for absent columns: {', '.join(dict.fromkeys(absent))}")


def active_rules(table: str, frame: DataFrame) -> list[Rule]:
    """The filtering rules of a table whose column the frame has."""
    return [r for r in rules_of(table) if r.filters and r.column in frame.columns]


def keep(table: str, frame: DataFrame, as_of: Column) -> Column:
    """True for the rows the typed table keeps."""
    passed = [~filter_failure(r, as_of) for r in active_rules(table, frame)]
    return reduce(lambda a, b: a & b, passed, F.lit(True))


def first_failure(rules: Sequence[Rule], as_of: Column) -> Column:
    """Number of the first rule that rejects the row; null if none does."""
    return F.coalesce(*[F.when(filter_failure(r, as_of), F.lit(i)) for i, r in enumerate(rules)], F.lit(None).cast("int"))


def watched(table: str, frame: DataFrame, as_of: Column, seen: Observation) -> DataFrame:
    """The frame; whatever action reads all of it also counts its rows, and those each rule rejects first.

    What is made from it should be written once: `seen` holds the counts of the first action. In a
    write without a shuffle every partition counts once, also if its task is repeated.
    """
    rules = active_rules(table, frame)
    return (
        frame.withColumn("_first_failure", first_failure(rules, as_of))
        .observe(seen, rows().alias("rows"), *[
            F.count_if(F.col("_first_failure") == i).alias(f"rule{i}") for i in range(len(rules))])
        .drop("_first_failure")
    )


def rejects_seen(raw: Mapping[str, DataFrame], seen: Mapping[str, Observation]) -> tuple[DataFrame, DataFrame]:
    """`validation_rejects` and `rejects_by_rule` from the counts of `watched` frames, without reading them again.

    Blocks until every watched frame was read. A table that is known to be empty counts 0.
    """
    spark = next(iter(raw.values())).sparkSession
    totals, by_rule = [], []
    for table, frame in raw.items():
        counts = seen[table].get
        name, total = SOURCES[table].typed, counts.get("rows", 0)
        failed = [(r, counts.get(f"rule{i}", 0)) for i, r in enumerate(active_rules(table, frame))]
        rejected = sum(n for _, n in failed)
        totals.append((name, total, total - rejected, rejected))
        by_rule += [(name, r.column, r.kind, n) for r, n in failed if n]
    return (
        spark.createDataFrame(
            totals, "silver_table string, bronze_rows bigint, silver_rows bigint, rejected_rows bigint"
        ).orderBy(F.desc("rejected_rows"), "silver_table"),
        spark.createDataFrame(by_rule, "silver_table string, column_name string, rule string, rejected_rows bigint"),
    )


def validation_log(raw: Mapping[str, DataFrame], as_of: Column, *, missing: str = "raise") -> DataFrame:
    """Failing rows per (source_table, column_name, rule): one pass over each table.

    A rule whose column is absent is an error unless `missing` is "skip".
    """
    check_columns(raw, missing)
    parts = []
    for table, frame in raw.items():
        rules = [r for r in rules_of(table) if r.logged and r.column in frame.columns]
        if not rules:
            continue
        counted = frame.agg(
            *[F.count_if(log_failure(r, as_of)).alias(f"_{i}") for i, r in enumerate(rules)]
        )
        parts.append(
            rows_from_columns(
                counted,
                "source_table",
                [
                    (table, {
                        "column_name": F.lit(r.column),
                        "rule": F.lit(r.kind),
                        "failed_rows": F.col(f"_{i}"),
                    })
                    for i, r in enumerate(rules)
                ],
            )
        )
    return reduce(DataFrame.unionByName, parts).orderBy(
        F.desc("failed_rows"), "source_table", "column_name", "rule"
    )


def validation_rejects(raw: Mapping[str, DataFrame], as_of: Column, *, missing: str = "raise") -> DataFrame:
    """Raw rows, kept rows and their difference per typed table, each table read once."""
    check_columns(raw, missing)
    parts = [
        frame.agg(rows().alias("_all"), F.count_if(keep(table, frame, as_of)).alias("_kept")).select(
            F.lit(SOURCES[table].typed).alias("silver_table"),
            F.col("_all").alias("bronze_rows"),
            F.col("_kept").alias("silver_rows"),
            (F.col("_all") - F.col("_kept")).alias("rejected_rows"),
        )
        for table, frame in raw.items()
    ]
    return reduce(DataFrame.unionByName, parts).orderBy(F.desc("rejected_rows"), "silver_table")


def rejects_by_rule(raw: Mapping[str, DataFrame], as_of: Column, *, missing: str = "raise") -> DataFrame:
    """Rejected rows by the first rule, in list order, that each row fails.

    Sums to `validation_rejects` per table, and also explains the rejects that the
    validation log cannot show: NULL values and the rules that are not logged. A table
    without an active rule has no rows here.
    """
    check_columns(raw, missing)
    parts = []
    for table, frame in raw.items():
        rules = active_rules(table, frame)
        names = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(k).alias("k"))
                          for c, k in [*((r.column, r.kind) for r in rules), ("", "")]])
        parts.append(
            frame.select(first_failure(rules, as_of).alias("_rule"))
            .where(F.col("_rule").isNotNull())
            .groupBy("_rule")
            .agg(rows().alias("rejected_rows"))
            .withColumn("_name", F.element_at(names, F.col("_rule") + 1))
            .select(
                F.lit(SOURCES[table].typed).alias("silver_table"),
                F.col("_name.c").alias("column_name"),
                F.col("_name.k").alias("rule"),
                "rejected_rows",
            )
        )
    return reduce(DataFrame.unionByName, parts)
