"""Steps that read their input once: prefix counts, profiles, store months, kept transactions, rules of uniqueness."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfscope.functions import ranks
from shelfscope.operators import features as L
from shelfscope.operators import models as M
from shelfscope.operators import quality as Q
from shelfscope.sources.retail import Retail


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _counting(spark, df, name):
    """The frame through a function that counts its rows as they are computed."""
    acc = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            acc.add(b.num_rows)
            yield b
    return df.mapInArrow(count, df.schema), acc


def test_grouped_quantiles_compute_their_input_once(spark):
    rows = [("a" if i % 3 else "b", float(i * 7 % 101)) for i in range(400)] + [(None, 1.0), ("a", None)]
    df, read = _counting(spark, spark.createDataFrame(rows, "g string, x double"), "x")
    got = {r.g: r.m for r in ranks.quantiles(df, "x", [0.5], ["m"], group=["g"], n_buckets=8).collect()}
    assert set(got) == {"a", "b"}
    assert read.value == len(rows)


def test_bucket_of_every_count_of_bounds(spark):
    df = spark.range(1000).select((F.col("id") % 97).cast("double").alias("x"))
    for n in (2, 3, 5, 16, 64, 65):
        b = [r[0] for r in ranks.range_bucket(df, "x", df, n).groupBy("x").agg(F.max("_bucket")).orderBy("x").select("max(_bucket)").collect()]
        bounds = df.agg(F.percentile_approx("x", [i / n for i in range(1, n)], ranks.SKETCH_ACCURACY)).first()[0]
        assert b == [sum(q < x for q in bounds) for x in map(float, range(97))]


def test_profile_tells_values_apart_that_doubles_do_not(spark):
    schema = "k long, z double, t timestamp_ntz, s string, d decimal(20,0)"
    big = 1 << 53
    rows = [(big, 0.0, dt.datetime(2020, 1, 1), "x", Decimal(big)), (big + 1, -0.0, dt.datetime(2020, 1, 2), "x", Decimal(big + 1)), (None, 1.0, None, None, None)]
    got = {r.column_name: r for r in Q.profile_columns(spark.createDataFrame(rows, schema), "t").collect()}
    assert {c: got[c].unique_count for c in got} == {"k": 2, "z": 3, "t": 2, "s": 1, "d": 2}
    assert got["z"].p50 == 0.0 and got["z"].outlier_count == 0 and got["s"].mean is None
    assert got["k"].null_count == 1 and got["k"].n_rows == 3


def test_profile_counts_its_numbers_in_one_pass(spark):
    rows = [(i, float(i % 13)) for i in range(500)]
    df, read = _counting(spark, spark.createDataFrame(rows, "a long, b double"), "p")
    got = {r.column_name: r for r in Q.profile_columns(df, "t").collect()}
    assert got["a"].p50 == 249.5 and got["b"].unique_count == 13
    assert read.value == 2 * len(rows)  # the moments and the counts


def _sales(spark):
    rows = [(s, dt.date(2020, m, 1), 10.0 * (s or 3) + m, 1.0 * m, 0.5 * (s or 3)) for s in (1, 2, None) for m in (1, 2, 3) for _ in range(2)]
    return spark.createDataFrame(rows, "store_id int, period date, gross_revenue double, gross_profit double, operating_cost double")


def test_store_features_read_the_transactions_once(spark):
    tx, read = _counting(spark, _sales(spark), "tx")
    stores = spark.createDataFrame([(1, 5.0, "ASIA"), (2, None, None)], "store_id int, size double, cluster string")
    r = Retail({}, tx)
    got = L.store_features(tx, stores, None, ["ASIA"], months=r.store_months).collect()
    assert read.value == 18
    tx2 = _sales(spark)
    costs = tx2.groupBy("store_id", "period").agg(F.sum("operating_cost").alias("total_operating_cost"))
    assert sorted(map(str, got)) == sorted(map(str, L.store_features(tx2, stores, costs, ["ASIA"]).collect()))


def test_kept_transactions_are_written_once(spark):
    tx, read = _counting(spark, _sales(spark), "tx")
    r = Retail({})
    r.__dict__["transactions"] = tx
    k = r.kept("store_id", "gross_revenue")
    assert k.transactions.columns == ["store_id", "gross_revenue"]
    assert k.transactions.groupBy("store_id").count().count() == 3 and k.transactions.count() == 18
    assert read.value == 18
    assert k.kept("store_id") is k


def test_unique_rule_spreads_keys_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(Q, "KEYS_A_TASK", 100)
    df = spark.createDataFrame([(i % 990,) for i in range(1000)] + [(None,), (None,)], "k int")
    out = Q.run_rules({"t": df}, [Q.Rule("t", "dup", "unique", ("k",))])
    row = out.first()
    assert (row.n_checked, row.n_bad, row.passed) == (1002, 11, False)
    assert "REPARTITION_BY_NUM" in _plan(out)


def test_permutation_importance_scores_all_mixes_in_one_pass(spark):
    rows = [(i, float(i % 10), float(i % 3), float(i % 10 > 4)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, x double, noise double, label double")

    class Model:
        def transform(self, d):
            from pyspark.ml.functions import array_to_vector
            return d.withColumn("probability", array_to_vector(F.array(1 - F.col("x") / 10, F.col("x") / 10)))
    kept = []

    def keep(d, name):
        kept.append(name)
        return d
    got = {r.feature: r.auc_loss for r in M.permutation_importance(Model(), df, ["x", "noise"], "label", "id", keep=keep).collect()}
    assert got["noise"] == pytest.approx(0.0) and got["x"] > 0.2
    assert "mixed-scores" in kept
