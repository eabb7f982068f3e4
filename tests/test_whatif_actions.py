import numpy as np
import pandas as pd
import pytest

from shelfscope.functions import ranks
from shelfscope.operators import actions as O
from shelfscope.operators import whatif as W


def test_financial_impact_formulas(spark):
    df = spark.createDataFrame([(1_000.0, 1_500_000.0, 500_000.0, 6), (0.0, -10.0, 100.0, 3), (0.0, 5.0, 0.0, 0)],
                               "revenue_delta double, profit_delta double, implementation_cost double, "
                               "timeline_months int")
    rows = W.financial_impact(df).collect()
    r = rows[0]
    assert r["roi"] == pytest.approx(3.0)
    assert r["payback_months"] == int(500_000 / (1_500_000 / 12))
    npv = sum(1_500_000 / 1.1 ** (y + 0.5) for y in (1, 2, 3)) - 500_000
    assert r["npv_3yr"] == pytest.approx(npv)
    assert r["annualized_impact"] == pytest.approx((1_500_000 * 3 - 500_000) / 3)
    assert rows[1]["payback_months"] == 999 and rows[2]["payback_months"] == 0
    assert rows[2]["roi"] == float("inf")


def test_rice_rank_orders_by_score(spark):
    df = spark.createDataFrame([("A", 2000, 3.0, 0.8, 4), ("B", 1000, 1.0, 0.5, 0), ("C", 5000, 2.0, 0.7, 10)],
                               "rec_id string, reach long, impact_score double, confidence double, effort_weeks int")
    out = {r["rec_id"]: (r["rice_score"], r["rice_rank"]) for r in O.rice_rank(df).collect()}
    assert out["A"][0] == pytest.approx(2.0 * 3 * 0.8 / 4)
    assert out["B"][0] == pytest.approx(1.0 * 1 * 0.5 / 1)  # effort floored at 1
    assert [k for k, _ in sorted(out.items(), key=lambda kv: kv[1][1])] == ["A", "C", "B"]


def test_ranks_with_a_hot_value(spark):
    """One value holds a third of all rows: positions and quantiles stay exact."""
    rng = np.random.default_rng(11)
    vals = np.concatenate([np.full(400, 7.0), rng.normal(size=800).round(2)])
    rng.shuffle(vals)
    pdf = pd.DataFrame({"k": np.arange(len(vals)), "x": vals})
    df = spark.createDataFrame(pdf)
    got = {r["k"]: r["rank_first"] for r in ranks.first_ranks(df, "x", "k", n_buckets=16).collect()}
    exp = pdf.x.rank(method="first")
    assert all(got[k] == e for k, e in zip(pdf.k, exp))
    q = ranks.quantiles(df, "x", [0.5, 0.9], ["a", "b"], n_buckets=16).first()
    assert (q["a"], q["b"]) == pytest.approx((np.quantile(vals, 0.5), np.quantile(vals, 0.9)))


def test_classifier_lists_and_worst_tier(spark):
    from datetime import date
    from shelfscope.operators.kpi import churn_by_tier
    from shelfscope.operators.models import store_action_lists_classification
    scores = spark.createDataFrame([(k, k / 100) for k in range(100)], "store_id long, probability double")
    got = [(r.list_type, r["rank"], r.store_id) for r in store_action_lists_classification(scores, k=5).collect()]
    assert sorted(got) == [("invest", k + 1, 40 + k) for k in range(5)] + [("monitor", k + 1, k) for k in range(5)]
    tx = spark.createDataFrame([(1, date(2020, 1, 1)), (2, date(2024, 1, 1)), (3, date(2020, 1, 1))], "customer_id long, date date")
    people = spark.createDataFrame([(1, "b"), (2, "b"), (3, "c"), (4, "a")], "customer_id long, tier string")
    rows = {r.tier: r for r in churn_by_tier(tx, people).collect()}
    assert [t for t, r in rows.items() if r.is_most_churned] == ["c"] and rows["ALL"].churn_rate == 0.5


def test_audit_totals_count_violated_rules(spark):
    from shelfscope.operators.quality import audit_totals
    tables = spark.createDataFrame([("t", 5, 1), ("u", 7, 0)], "table_name string, row_count long, duplicate_row_count long")
    rules = spark.createDataFrame([("t", True), ("t", False), ("u", False)], "table_name string, passed boolean")
    assert tuple(audit_totals(tables, rules).first()) == (2, 12, 1, 3, 2)
    assert tuple(audit_totals(tables.limit(0), rules.limit(0)).first()) == (0, 0, 0, 0, 0)
