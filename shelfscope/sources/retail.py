"""Retail roles over the driver's star schema.

The reference works on stores / customers / products / transactions /
marketing tables.  On the TPC-H-like tables the roles map as:

* transaction  = lineitem, left-joined to orders and part (orphans stay, with NULL attributes)
* date/period  = o_orderdate / first day of its month
* revenue      = l_extendedprice * (1 - l_discount); cogs = l_quantity * p_retailprice
* store        = supplier, cluster = region name, size attribute = s_acctbal
* customer     = o_custkey, tier = c_mktsegment
* product      = part, category = p_type, subcategory = p_brand,
                 private label = p_type 'PROMO'
* marketing    = events: one row per (customer nation, day, channel=event_type)
                 with spend = Σ value over non-purchase events; the response
                 is Σ value of purchase events.  Unknown users are the NULL market.

Every frame is a lazy plan, built when it is first asked for.  Only ``rollups``,
``customer_totals`` and ``store_months`` are written, once, on first use, and the columns that ``kept`` is asked for.  ``prepare_fact`` writes the joined transactions to a folder of
the caller's choice, and ``retail(..., fact_path=...)`` reads them from there.
NaN becomes NULL at ingest.  No join carries a hint: sizes decide.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.base import Rollups, customer_totals
from ..operators.features import store_months
from .sinks import shared_root, write_table, written
from .tables import TABLES, scan_table

PRIVATE_LABEL_TYPE = "PROMO"
PURCHASE_EVENT = "purchase"


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes NULL, so one NaN cannot poison a sum."""
    return df.select(*[
        F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        else F.col(f.name) for f in df.schema.fields])


class Tables(dict):
    """Table scans by name, made when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str, names=TABLES):
        super().__init__()
        self.spark, self.sf_dir, self.names = spark, sf_dir, tuple(names)

    def __missing__(self, name: str) -> DataFrame:
        if name not in self.names:
            raise KeyError(name)
        self[name] = nan_to_null(scan_table(self.spark, self.sf_dir, name))
        return self[name]

    def every(self) -> dict[str, DataFrame]:
        return {n: self[n] for n in self.names}


class Retail:
    """Role frames; each is planned on first use only."""

    def __init__(self, tables: dict, fact: DataFrame | None = None):
        self.tables = tables
        self._fact = fact

    @cached_property
    def transactions(self) -> DataFrame:
        return self._fact if self._fact is not None else transactions(self.tables)

    @cached_property
    def rollups(self) -> Rollups:
        """The lattice of the transactions, written to the shared folder when it is first asked for."""
        spark = self.transactions.sparkSession
        path = write_table(Rollups.build(self.transactions), shared_root(spark, "rollups"), ["grain"])
        return Rollups(spark.read.parquet(path))

    @cached_property
    def customer_totals(self) -> DataFrame:
        """One row per customer, written to the shared folder when it is first asked for."""
        return written(customer_totals(self.transactions), "customers")

    @cached_property
    def store_months(self) -> DataFrame:
        """One row per store and month, written to the shared folder when it is first asked for."""
        return written(store_months(self.transactions), "store-months")

    def kept(self, *columns: str) -> Retail:
        """The same roles over transactions whose given columns are written once: queries that group them
        several ways join the tables a single time."""
        return self if self._fact is not None else Retail(self.tables, written(self.transactions.select(*columns), "transactions"))

    @cached_property
    def stores(self) -> DataFrame:
        return stores(self.tables)

    @cached_property
    def customers(self) -> DataFrame:
        return customers(self.tables)

    @cached_property
    def products(self) -> DataFrame:
        return products(self.tables)

    @cached_property
    def marketing(self) -> DataFrame:
        return marketing(self.tables)

    @cached_property
    def response(self) -> DataFrame:
        return response(self.tables)

    @cached_property
    def store_costs(self) -> DataFrame:
        return store_costs(self.transactions)


def _geo(tables) -> DataFrame:
    return tables["nation"].join(tables["region"], F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        "n_nationkey", "n_name", "r_name")


def _brand_type():
    return F.when(F.col("p_type") == PRIVATE_LABEL_TYPE, "private_label").when(F.col("p_type").isNotNull(), "national_brand")


def transactions(tables) -> DataFrame:
    li, o, p = tables["lineitem"], tables["orders"], tables["part"]
    rev = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    cogs = F.col("l_quantity") * F.col("p_retailprice")
    return (
        li.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(p, F.col("l_partkey") == F.col("p_partkey"), "left")
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("store_id"),
            F.col("o_orderdate").alias("date"),
            F.col("l_shipdate").alias("ship_date"),
            F.trunc(F.col("o_orderdate"), "month").alias("period"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_discount").alias("discount_pct"),
            rev.alias("gross_revenue"),
            cogs.alias("cogs"),
            (rev - cogs).alias("gross_profit"),
            F.try_divide(rev - cogs, rev).alias("margin"),
            F.try_divide(rev, F.col("l_quantity")).alias("unit_price"),
            (F.col("l_extendedprice") * F.col("l_tax")).alias("operating_cost"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("subcategory"),
            _brand_type().alias("brand_type"),
        )
    )


def stores(tables) -> DataFrame:
    s = tables["supplier"]
    return s.join(_geo(tables), F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("s_suppkey").alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("n_name").alias("store_nation"),
        F.col("r_name").alias("cluster"),
        F.col("s_acctbal").alias("size"),
    )


def customers(tables) -> DataFrame:
    c = tables["customer"]
    return c.join(_geo(tables), F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("tier"),
        F.col("n_name").alias("customer_nation"),
        F.col("r_name").alias("customer_region"),
        F.col("c_acctbal").alias("acctbal"),
    )


def products(tables) -> DataFrame:
    p = tables["part"]
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        _brand_type().alias("brand_type"),
        F.col("p_retailprice").alias("unit_cost"),
        F.col("p_size").alias("size"),
    )


def _events_by_nation(tables) -> DataFrame:
    e, c = tables["events"], tables["customer"]
    return e.join(c.select("c_custkey", "c_nationkey"),
                  F.col("user_id") == F.col("c_custkey"), "left").join(
        _geo(tables), F.col("c_nationkey") == F.col("n_nationkey"), "left")


def marketing(tables) -> DataFrame:
    """Marketing spend rows: (market, period=day, channel, spend)."""
    ev = _events_by_nation(tables).where(F.col("event_type") != PURCHASE_EVENT)
    return ev.groupBy(
        F.col("n_name").alias("market"),
        F.to_date("ts").alias("period"),
        F.col("event_type").alias("channel"),
    ).agg(F.sum("value").alias("spend"))


def response(tables) -> DataFrame:
    """Marketing response rows: (market, period=day, revenue)."""
    ev = _events_by_nation(tables).where(F.col("event_type") == PURCHASE_EVENT)
    return ev.groupBy(F.col("n_name").alias("market"), F.to_date("ts").alias("period")).agg(
        F.sum("value").alias("revenue"))


def store_costs(tx: DataFrame) -> DataFrame:
    """Operating cost per (store, period): Σ l_extendedprice·l_tax."""
    return tx.groupBy("store_id", "period").agg(F.sum("operating_cost").alias("total_operating_cost"))


def prepare_fact(spark: SparkSession, sf_dir: str, path: str, partitions: int | None = None) -> str:
    """Write the joined transactions as Parquet to ``path`` (shared storage): analyses
    that read them with ``fact_path`` scan just their columns instead of joining again.  ``partitions`` deals the
    rows out anew, for inputs of a single file; shuffled joins of large inputs need none."""
    tx = transactions(Tables(spark, sf_dir))
    (tx if partitions is None else tx.repartition(partitions)).write.parquet(path)
    return path


def retail(spark: SparkSession, sf_dir: str, fact_path: str | None = None) -> Retail:
    """Role-mapped frames for ``sf_dir``; transactions come from ``fact_path`` when one was prepared."""
    fact = None if fact_path is None else spark.read.parquet(fact_path)
    return Retail(Tables(spark, sf_dir), fact)
