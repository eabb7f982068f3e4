"""segmentation_all holds all three steps: store profiles, customer profiles and the RFM summary."""

import datetime as dt

import pytest

from shelfscope.operators import base
from shelfscope.operators import segment as K


def _tables(spark):
    rows = [(c, c % 3, dt.date(2020, 1, 1 + (c * 7) % 28), 10.0 * c + k, 2.0 * c) for c in range(1, 31) for k in range(1 + c % 6)]
    rows += [(None, 1, dt.date(2020, 3, 1), 5.0, 1.0)]  # a sale without a customer sets the reference date
    tx = spark.createDataFrame(rows, "customer_id long, store_id long, date date, gross_revenue double, gross_profit double")
    stores = spark.createDataFrame([(0, "ASIA"), (1, "EUROPE"), (2, None)], "store_id long, cluster string")
    customers = spark.createDataFrame([(c, "AB"[c % 2]) for c in range(1, 31)], "customer_id long, tier string")
    return tx, stores, customers


def test_all_three_steps_are_there(spark):
    tx, stores, customers = _tables(spark)
    got = K.segmentation_all(tx, stores, customers, base.by_customer(tx)).collect()
    by = {t: {r.segment_name: r for r in got if r.segment_type == t} for t in ("store", "customer", "rfm")}
    assert set(by["store"]) == {"ASIA", "EUROPE"} and set(by["customer"]) == {"A", "B"}
    rfm = tx.where("customer_id IS NOT NULL").toPandas().groupby("customer_id").agg(
        r=("date", lambda d: (dt.date(2020, 3, 1) - d.max()).days), f=("date", "count"), m=("gross_revenue", "sum"))
    assert sum(r.n_members for r in by["rfm"].values()) == len(rfm) == 30
    for column, of in (("avg_monetary", "m"), ("avg_frequency", "f"), ("avg_recency_days", "r")):
        assert sum(r.n_members * r[column] for r in by["rfm"].values()) == pytest.approx(rfm[of].sum())
    assert all(r.avg_revenue is None for r in by["rfm"].values())
    assert all(r.avg_monetary is None and r.avg_revenue > 0 for t in ("store", "customer") for r in by[t].values())


def test_registered_rows_are_those_of_the_sql(spark, tmp_path):
    import duckdb

    import __spark_entry__ as e
    from shelfscope.sources.tables import TABLES
    from tools.check_oracle import digest
    source = "/root/testdata/sf0.001"
    for t in TABLES:
        if t != "orders":
            (tmp_path / f"{t}.parquet").symlink_to(f"{source}/{t}.parquet")
    duckdb.sql(f"COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_custkey END AS o_custkey) FROM '{source}/orders.parquet') "
               f"TO '{tmp_path}/orders.parquet' (FORMAT parquet)")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet')")
    df = e.queries()["segmentation_all"](spark, str(tmp_path))
    res = con.execute(e.oracle_sql()["segmentation_all"])
    names, rows = [d[0] for d in res.description], res.fetchall()
    assert sorted(df.columns) == sorted(names) and {r[names.index("segment_type")] for r in rows} == {"store", "customer", "rfm"}
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(names, rows)[0]
