"""Plan-shape checks: column pruning and filter pushdown reach the scans."""

from conftest import SF001
from shelfscope.operators import features as L
from shelfscope.operators import kpi as P
from shelfscope.sources.retail import prepare_fact, retail


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lazy_fact_scan_reads_only_needed_columns(spark):
    r = retail(spark, SF001)
    plan = _plan(P.category_performance(r.transactions))
    li = [line for line in plan.split("\n") if "lineitem.parquet" in line]
    assert li, plan
    read = li[0][li[0].index("ReadSchema"):]
    assert "l_extendedprice" in read and "l_discount" in read
    assert "l_returnflag" not in read and "l_shipdate" not in read and "l_tax" not in read


def test_time_filter_is_pushed_to_the_prepared_fact(spark, tmp_path):
    r = retail(spark, SF001, prepare_fact(spark, SF001, f"file://{tmp_path}/fact"))
    plan = _plan(L.point_in_time_churn(r.transactions, "1998-01-01 00:00:00"))
    assert "PushedFilters: [IsNotNull(date), LessThanOrEqual(date" in plan or "LessThanOrEqual(date" in plan


def test_dimension_joins_happen_after_entity_aggregation(spark):
    from shelfscope.operators import segment as K
    r = retail(spark, SF001)
    text = K.tier_revenue(r.transactions, r.customers)._jdf.queryExecution().optimizedPlan().toString()
    # the customer join input is the per-customer aggregate, not raw rows
    join_at = text.index("Join")
    assert "Aggregate [customer_id" in text[join_at:]


def test_time_filter_reaches_orders_scan_through_the_lazy_join(spark):
    r = retail(spark, SF001)
    plan = _plan(L.point_in_time_churn(r.transactions, "1998-01-01 00:00:00"))
    orders_scan = [line for line in plan.split("\n") if "orders.parquet" in line]
    assert orders_scan and "LessThanOrEqual(o_orderdate" in orders_scan[0], plan


def _copy(spark, tmp_path, **changed):
    """A copy of the small tables with some of them replaced."""
    from shelfscope.sources.tables import TABLES
    for t in TABLES:
        df = spark.read.parquet(f"{SF001}/{t}.parquet")
        (changed[t](df) if t in changed else df).write.parquet(f"{tmp_path}/{t}.parquet")
    return str(tmp_path)


def test_orphans_stay_and_are_reported(spark, tmp_path):
    from pyspark.sql import functions as F

    from shelfscope.plans.catalog import run_query
    orphan = {
        "lineitem": lambda d: d.unionByName(d.limit(50).withColumn("l_partkey", F.lit(99_999_999).cast("long"))),
        "customer": lambda d: d.withColumn("c_nationkey", F.when(F.col("c_custkey") == 1, 99).otherwise(F.col("c_nationkey"))),
        "events": lambda d: d.unionByName(d.limit(20).withColumn("user_id", F.lit(99_999_999).cast("long"))),
    }
    d = _copy(spark, tmp_path, **orphan)
    n = spark.read.parquet(f"{SF001}/lineitem.parquet").count()
    r = retail(spark, d)
    assert r.transactions.count() == n + 50 and r.customers.count() == r.tables["customer"].count()
    bad = {(x.table_name, x.check_name): x.n_bad for x in run_query("dq_referential", spark, d).collect()}
    assert bad["transactions", "product_fk"] == 50 and bad["customer", "nation_fk"] >= 1 and bad["events", "user_fk"] >= 20
    total = spark.read.parquet(f"{d}/events.parquet").where("event_type <> 'purchase'").agg(F.sum("value")).first()[0]
    assert abs(r.marketing.agg(F.sum("spend")).first()[0] - total) < 1e-6 * abs(total)


def test_building_a_query_writes_nothing(spark):
    import os

    from shelfscope.plans.catalog import run_query
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = sorted(os.listdir(shared)) if os.path.isdir(shared) else []
    run_query("segment_counts", spark, SF001).collect()
    run_query("kpi_summary", spark, SF001).collect()
    assert before == (sorted(os.listdir(shared)) if os.path.isdir(shared) else [])


def test_nan_is_null(spark):
    from shelfscope.sources.retail import nan_to_null
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert [r.x for r in nan_to_null(df).collect()] == [1.0, None, None]


def test_fact_is_read_at_most_twice(spark):
    """One read writes the roll-ups (rice_rank: a second one the elasticities); the query's own plan holds the rest."""
    from shelfscope.plans.catalog import run_query
    for name, more in (("rice_rank", 0), ("whatif_batch", 1), ("customer_features", 1), ("rfm_summary", 0)):
        assert _plan(run_query(name, spark, SF001)).count("lineitem.parquet") <= more, name


def test_rollups_equal_direct_aggregates(spark):
    """Every roll-up derived from the written cells equals the one made from the transactions; orphans included."""
    from pyspark.sql import functions as F
    from shelfscope.operators import base
    tx = retail(spark, SF001).transactions
    orphan = tx.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name in (
        "customer_id", "category", "brand_type", "date", "period", "gross_profit", "margin") else F.col(f.name) for f in tx.schema.fields])
    tx = tx.unionByName(orphan).cache()
    lattice = base.Rollups(base.Rollups.build(tx).cache())

    def rows(df):
        return sorted([tuple(round(v, 4) if isinstance(v, float) else v for v in r) for r in df.collect()], key=str)
    for fn in (base.by_store, base.by_customer, base.by_category, base.portfolio, base.brand_margins):
        assert rows(fn(lattice)) == rows(fn(tx)), fn.__name__
    assert rows(base.customer_categories(lattice).distinct()) == rows(base.customer_categories(tx).distinct())
    one = spark.range(1)
    assert one.select(base.n_months(lattice)).first()[0] == one.select(base.n_months(tx)).first()[0]
    tx.unpersist(), lattice.cells.unpersist()


def test_scenario_names_are_found_in_any_case(spark):
    from shelfscope.operators.whatif import join_folded
    names = spark.createDataFrame([("PROMO", 1.0), ("Small", 2.0), ("SMALL", 3.0), (None, 4.0)], "category string, x double")
    asked = spark.createDataFrame([(1, "promo"), (2, "PROMO"), (3, "SMALL"), (4, "small"), (5, "other"), (6, None)], "i int, category string")
    got = {r.i: (r.category, r.x) for r in join_folded(asked, names, "category", "left").collect()}
    assert got == {1: ("PROMO", 1.0), 2: ("PROMO", 1.0), 3: ("Small", 2.0), 4: ("Small", 2.0), 5: ("other", None), 6: (None, None)}
    assert {r.i for r in join_folded(asked, names, "category").collect()} == {1, 2, 3, 4}
