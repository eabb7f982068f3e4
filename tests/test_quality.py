"""Defect injection: a valid table passes every rule; each injected defect
trips exactly its rule (the reference's validator test style)."""

import pytest

from shelfscope.operators import quality as Q
from shelfscope.operators.quality import Rule

SCHEMA = "store_id long, fmt string, size double, tenure double, cost double, price double, parent long"
VALID = [(1, "urban", 100.0, 5.0, 2.0, 3.0, 10), (2, "rural", 50.0, 1.0, 1.0, 1.5, 10),
         (3, "suburban", 75.0, 0.0, 4.0, 4.0, 11)]
RULES = [
    Rule("t", "required", "required", ("store_id", "fmt")),
    Rule("t", "null_key", "not_null", ("store_id",)),
    Rule("t", "dup_key", "unique", ("store_id",)),
    Rule("t", "fmt_allowed", "allowed", ("fmt",), ("urban", "suburban", "rural")),
    Rule("t", "size_pos", "positive", ("size",)),
    Rule("t", "cost_nonneg", "non_negative", ("cost",)),
    Rule("t", "tenure_range", "range", ("tenure",), (0, 50)),
    Rule("t", "price_ge_cost", "column_order", ("price", "cost")),
    Rule("t", "parent_fk", "fk", ("parent",), ("p", "id")),
]


def _run(spark, rows):
    tables = {"t": spark.createDataFrame(rows, SCHEMA),
              "p": spark.createDataFrame([(10,), (11,)], "id long")}
    return {r["check_name"]: r["n_bad"] for r in Q.run_rules(tables, RULES).collect()}


def test_valid_rows_pass(spark):
    assert set(_run(spark, VALID).values()) == {0}


@pytest.mark.parametrize("row,check", [
    ((None, "urban", 1.0, 1.0, 1.0, 1.0, 10), "null_key"),
    ((1, "urban", 1.0, 1.0, 1.0, 1.0, 10), "dup_key"),
    ((4, "flagship", 1.0, 1.0, 1.0, 1.0, 10), "fmt_allowed"),
    ((4, None, 1.0, 1.0, 1.0, 1.0, 10), "fmt_allowed"),
    ((4, "urban", 0.0, 1.0, 1.0, 1.0, 10), "size_pos"),
    ((4, "urban", 1.0, 1.0, -1.0, 1.0, 10), "cost_nonneg"),
    ((4, "urban", 1.0, 51.0, 1.0, 1.0, 10), "tenure_range"),
    ((4, "urban", 1.0, 1.0, 5.0, 4.0, 10), "price_ge_cost"),
    ((4, "urban", 1.0, 1.0, 1.0, 1.0, 99), "parent_fk"),
    ((4, "urban", 1.0, 1.0, 1.0, 1.0, None), "parent_fk"),
])
def test_one_defect_one_failure(spark, row, check):
    bad = _run(spark, VALID + [row])
    assert bad[check] == 1
    assert all(v == 0 for k, v in bad.items() if k != check)


def test_missing_column_reported(spark):
    tables = {"t": spark.createDataFrame([(1,)], "store_id long")}
    res = Q.run_rules(tables, [Rule("t", "required", "required", ("store_id", "fmt"))]).first()
    assert res["n_bad"] == 1 and not res["passed"]


def test_profile_and_duplicates(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 1.0), (2, None), (3, 100.0), (4, 2.0)], "k long, v double")
    prof = {r["column_name"]: r for r in Q.profile_columns(df, "t", n_buckets=3).collect()}
    assert prof["v"]["null_count"] == 1 and prof["v"]["unique_count"] == 3
    assert prof["v"]["p50"] == pytest.approx(1.5)
    assert prof["v"]["outlier_count"] == 1  # 100 lies beyond p75 + 1.5 IQR
    tp = Q.profile_table(df, "t").first()
    assert tp["duplicate_row_count"] == 1 and tp["row_count"] == 5


def test_duplicate_rows_treat_nulls_and_arrays_by_value(spark):
    a = spark.createDataFrame([(1, None, [1.0, 2.0]), (1, None, [1.0, 2.0]), (None, 1, [1.0, 2.0]),
                               (1, None, [2.0, 1.0])], "x int, y int, v array<double>")
    b = spark.createDataFrame([(1,), (1,), (1,)], "k int")
    got = {r["table_name"]: r for r in Q.profile_table_many({"a": a, "b": b}).collect()}
    assert got["a"]["duplicate_row_count"] == 1 and got["a"]["row_count"] == 4
    assert got["b"]["duplicate_row_count"] == 2 and got["b"]["column_count"] == 1


def test_rule_errors_are_violations(spark):
    t = spark.createDataFrame([(1, "5", "a"), (2, "-1", "b"), (3, None, "a"), (4, "x", None)], "id long, amount string, kind string")
    clean = spark.createDataFrame([(1, "5"), (2, None)], "id long, amount string")
    rules = [
        Rule("t", "amount_positive", "positive", ("amount",)),
        Rule("t", "amount_known", "not_null", ("amount",)),
        Rule("clean", "amount_positive", "positive", ("amount",)),
        Rule("t", "no_column", "range", ("size",), (0, 1)),
        Rule("gone", "no_table", "unique", ("id",)),
        Rule("t", "no_parent", "fk", ("id",), ("gone", "id")),
        Rule("t", "no_kind", "odd", ("id",)),
        Rule("t", "required", "required", ("id", "size")),
    ]
    got = {(r.table_name, r.check_name): (r.n_checked, r.n_bad, r.passed, r.error) for r in Q.audit_rules({"t": t, "clean": clean}, rules).collect()}
    assert got == {
        ("t", "amount_positive"): (4, 1, False, "1 values are no number"),
        ("t", "amount_known"): (4, 1, False, None),
        ("clean", "amount_positive"): (2, 0, True, None),
        ("t", "no_column"): (None, None, False, "missing column t.size"),
        ("gone", "no_table"): (None, None, False, "missing table gone"),
        ("t", "no_parent"): (None, None, False, "missing table gone"),
        ("t", "no_kind"): (None, None, False, "unknown kind odd"),
        ("t", "required"): (2, 1, False, None),
    }
