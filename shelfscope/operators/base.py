"""Shared base aggregates.  Many operators start from the
same few roll-ups of the transaction fact.  Each function takes the
transactions themselves or ``Rollups``, a written lattice from which every
coarser roll-up is derived without reading the transactions again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import div


def _sums(*extra):
    return [F.sum("gross_revenue").alias("revenue"), F.sum("gross_profit").alias("profit"),
            F.count(F.lit(1)).alias("n_txns"), *extra]


class Rollups:
    """Cells of two grains, made by one GROUPING SETS pass over the transactions: customer × category × brand type
    and store × month.  Their states (sums, row counts, last date, sum and count of row margins) merge, so
    totals by store, customer, category, brand type, month and overall are sums of cells.  The cells grow with
    customers and store-months, not with rows."""

    GRAINS = (("customer_id", "category", "brand_type"), ("store_id", "period"))
    STATES = ("revenue", "profit", "n_txns", "units", "margin_sum", "margin_n")

    def __init__(self, cells: DataFrame):
        self.cells = cells
        self.sparkSession = cells.sparkSession

    @classmethod
    def build(cls, tx: DataFrame) -> DataFrame:
        """The cells as a lazy plan; ``grain`` (customer or store) names the grouping set.  Write them (partitioned
        by grain) and open them with ``Rollups``."""
        keys = [k for g in cls.GRAINS for k in g]
        margin = div("gross_profit", "gross_revenue")
        cells = tx.groupingSets([list(g) for g in cls.GRAINS], *keys).agg(
            F.when(F.grouping("store_id") == 1, "customer").otherwise("store").alias("grain"),
            *_sums(F.sum("quantity").alias("units"), F.max("date").alias("last_date"),
                   F.sum(margin).alias("margin_sum"), F.count(margin).alias("margin_n")))
        return cells.select("grain", *keys, *cls.STATES, "last_date")

    def by(self, *keys: str) -> DataFrame:
        """States per ``keys``, all of one grain."""
        grain = next(name for name, g in zip(("customer", "store"), self.GRAINS) if set(keys) <= set(g))
        return self.cells.where(F.col("grain") == grain).groupBy(*keys).agg(
            *[F.sum(s).alias(s) for s in self.STATES], F.max("last_date").alias("last_date"))


def by_store(tx: DataFrame | Rollups) -> DataFrame:
    if isinstance(tx, Rollups):
        return tx.by("store_id").select("store_id", "revenue", "profit", "n_txns")
    return tx.groupBy("store_id").agg(*_sums())


def by_customer(tx: DataFrame | Rollups) -> DataFrame:
    if isinstance(tx, Rollups):
        return tx.by("customer_id").select("customer_id", "revenue", "profit", "n_txns", "last_date")
    return tx.groupBy("customer_id").agg(*_sums(F.max("date").alias("last_date")))


def n_months(tx: DataFrame | Rollups) -> Column:
    """Number of distinct months as a scalar."""
    if isinstance(tx, Rollups):
        return tx.by("period").agg(F.count("period")).scalar()
    return tx.agg(F.count_distinct("period")).scalar()


def portfolio(tx: DataFrame | Rollups) -> DataFrame:
    """One row: revenue and profit of all transactions and the last date."""
    if isinstance(tx, Rollups):
        return tx.by().select("revenue", "profit", "last_date")
    return tx.agg(F.sum("gross_revenue").alias("revenue"), F.sum("gross_profit").alias("profit"), F.max("date").alias("last_date"))


def customer_categories(tx: DataFrame | Rollups) -> DataFrame:
    """(customer_id, category) pairs that occur."""
    rows = tx.by("customer_id", "category") if isinstance(tx, Rollups) else tx
    return rows.select("customer_id", "category")


def brand_margins(tx: DataFrame | Rollups) -> DataFrame:
    """One row: mean row margin of private labels (pl) and of national brands (nb)."""
    if isinstance(tx, Rollups):
        b = tx.by("brand_type")
        return b.agg(*[div(F.sum(F.when(F.col("brand_type") == t, F.col("margin_sum"))),
                           F.sum(F.when(F.col("brand_type") == t, F.col("margin_n")))).alias(c)
                       for t, c in (("private_label", "pl"), ("national_brand", "nb"))])
    margin = div("gross_profit", "gross_revenue")
    return tx.agg(F.avg(F.when(F.col("brand_type") == "private_label", margin)).alias("pl"),
                  F.avg(F.when(F.col("brand_type") == "national_brand", margin)).alias("nb"))


def by_customer_month(tx: DataFrame) -> DataFrame:
    return tx.groupBy("customer_id", "period").agg(*_sums())


def by_product(tx: DataFrame) -> DataFrame:
    return tx.groupBy("product_id").agg(*_sums(F.sum("quantity").alias("units")))


def by_category(tx: DataFrame | Rollups) -> DataFrame:
    if isinstance(tx, Rollups):
        return tx.by("category").select("category", "revenue", "profit", "n_txns", "units")
    return tx.groupBy("category").agg(*_sums(F.sum("quantity").alias("units")))


def by_month(tx: DataFrame) -> DataFrame:
    return tx.groupBy("period").agg(*_sums())


def customer_totals(tx: DataFrame) -> DataFrame:
    """One row per customer with what the customer features, RFM and churn rows need."""
    return tx.groupBy("customer_id").agg(
        F.max("date").alias("last_purchase"), F.min("date").alias("first_purchase"),
        F.count(F.lit(1)).alias("n_txns"), F.sum("gross_revenue").alias("total_spend"),
        F.sum("gross_profit").alias("total_profit"), F.count_distinct("product_id").alias("n_products"),
        F.avg("discount_pct").alias("avg_discount"))
