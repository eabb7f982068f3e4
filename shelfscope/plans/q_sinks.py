"""Registered sink / store queries (A4-A8) and set / sampling verbs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import features as L
from ..operators import models as M
from ..operators import quality as Q
from ..sources import sinks as S
from ..sources.retail import Retail
from ..sources.tables import SCHEMAS, table_path
from .q_describe import TIER_ORDER
from .q_kpi import CLUSTERS
from .q_quality import PART_TYPES, RULES
from .registry import register
from .sql import TX, with_


@register("feature_store_manifest", survey_id="A5,A6,A8",
          sql="SELECT 'customer_features' AS name, count(DISTINCT o_custkey) AS n_rows FROM lineitem "
              "JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey "
              "UNION ALL SELECT 'product_features', count(DISTINCT l_partkey) FROM lineitem "
              "JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey "
              "UNION ALL SELECT 'store_features', count(DISTINCT l_suppkey) FROM lineitem "
              "JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey")
def feature_store_manifest(r: Retail):
    """Writes the three feature tables to a feature store on shared storage
    and returns the manifest row counts read back from the written tables."""
    spark = r.transactions.sparkSession
    r = r.kept("store_id", "customer_id", "product_id", "date", "period", "quantity", "discount_pct", "unit_price", "gross_revenue",
               "gross_profit", "operating_cost")
    fs = S.FeatureStore(spark, S.shared_root(spark, "features"))
    fs.save("customer_features", L.customer_features(r.transactions, r.customers, r.stores, TIER_ORDER, CLUSTERS, r.customer_totals))
    fs.save("store_features", L.store_features(r.transactions, r.stores, None, CLUSTERS, months=r.store_months))
    fs.save("product_features", L.product_features(r.transactions, r.products, list(PART_TYPES)))
    return fs.manifest().select("name", "n_rows")


@register("lineage_record", survey_id="A4,A7",
          sql="\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows, "
                                   f"CAST({len(s.fields)} AS BIGINT) AS n_columns FROM {t}"
                                   for t, s in SCHEMAS.items()))
def lineage_record(r: Retail):
    """Lineage rows of every input table, appended as JSON to shared storage,
    then read back."""
    spark = r.transactions.sparkSession
    rec = S.lineage_records(r.tables.every(), {t: table_path(r.tables.sf_dir, t) for t in r.tables.names}, "0.1.0")
    path = S.write_json(rec, S.shared_root(spark, "lineage"))
    return spark.read.json(path).select("table_name", "n_rows", "n_columns")


ALLOWED = [x for x in RULES if x.kind == "allowed"]


@register("dq_offending_values", survey_id="F4,G4",
          sql="\nUNION ALL\n".join(
              f"SELECT '{x.table}' AS table_name, '{x.check}' AS check_name, "
              f"CAST({x.cols[0]} AS VARCHAR) AS offending_value, count(*) AS n FROM {x.table} WHERE "
              f"{x.cols[0]} IS NULL OR NOT ({x.cols[0]} IN ({', '.join(repr(v) for v in x.args[:-1])})) GROUP BY {x.cols[0]}"
              for x in ALLOWED))
def dq_offending_values(r: Retail):
    """Observed − allowed values, one row per value with its count.  Each rule is checked against its domain without the
    last value, so that the query shows values on clean tables too."""
    parts = []
    for x in ALLOWED:
        c = F.col(x.cols[0])
        parts.append(Q.offending_values(r.tables[x.table], x.cols[0], list(x.args[:-1])).select(
            F.lit(x.table).alias("table_name"), F.lit(x.check).alias("check_name"), c.cast("string").alias("offending_value"), "n"))
    return reduce(DataFrame.unionByName, parts)


@register("stratified_split", survey_id="F8,M4",
          sql=with_(TX) + """, c AS (SELECT customer_id, CAST(count_if(date > TIMESTAMP '2000-06-30 00:00:00' AND date <= TIMESTAMP '2000-06-30 00:00:00' + INTERVAL 90 DAY) = 0 AS INT) AS is_churned
  FROM tx GROUP BY customer_id HAVING count_if(date <= TIMESTAMP '2000-06-30 00:00:00') > 0),
n AS (SELECT is_churned, count(*) AS n, CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS n_test FROM c GROUP BY is_churned)
SELECT 'test' AS split, is_churned, n_test AS n FROM n WHERE n_test > 0 UNION ALL SELECT 'train', is_churned, n - n_test FROM n WHERE n > n_test""")
def stratified_split(r: Retail):
    """Deterministic stratified 80/20 split of the point-in-time churn table: counts per split and label."""
    f = L.point_in_time_churn(r.transactions, "2000-06-30 00:00:00")
    train, test = M.hash_split(f, "customer_id", 0.2, label="is_churned")
    return (train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
            .groupBy("split", "is_churned").agg(F.count(F.lit(1)).alias("n")))


@register("seeded_sample", survey_id="F8",
          sql="SELECT c_custkey FROM customer WHERE CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR) || '-42'), 1, 8) AS UBIGINT) < 0.1 * pow(2, 32)")
def seeded_sample(r: Retail):
    return M.seeded_sample(r.tables["customer"].select("c_custkey"), "c_custkey", 0.1)
