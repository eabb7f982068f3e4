"""K-family: segment profiles, RFM base / quintile scores / labels /
summary, segment counts, tier revenue and cluster statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import clip_lower, div
from ..functions.ranks import quintile_scores_multi
from . import base


def segment_profile(entity: DataFrame, segment: str, segment_type: str,
                    key: str) -> DataFrame:
    """K1/K2: per segment n_members, % of entities, mean revenue / profit /
    margin (profit / max(revenue, 1)), revenue and profit share.  Shares use
    totals over all entities, including ones without a segment.

    ``entity``: one row per entity with ``revenue``, ``profit`` and segment."""
    e = entity.withColumn("_m", F.col("profit") / clip_lower("revenue", 1.0) * 100)
    g = e.groupBy(segment).agg(
        F.count(F.lit(1)).alias("n_members"), F.sum("revenue").alias("_r"), F.sum("profit").alias("_p"),
        F.avg("revenue").alias("avg_revenue"), F.avg("profit").alias("avg_profit"),
        F.avg("_m").alias("avg_margin_pct"))
    # totals over all entities (incl. those without a segment) as one scalar
    # subquery: no window, however many segments there are
    tot = g.agg(F.struct(F.sum("n_members").alias("n"), F.sum("_r").alias("r"), F.sum("_p").alias("p"))).scalar()
    return (g.withColumn("_t", tot).withColumn("_n", F.col("_t.n")).withColumn("_tr", F.col("_t.r"))
            .withColumn("_tp", F.col("_t.p"))
            .where(F.col(segment).isNotNull())
            .select(F.lit(segment_type).alias("segment_type"), F.col(segment).cast("string").alias("segment_name"),
                    "n_members",
                    (F.col("n_members") / F.greatest(F.col("_n"), F.lit(1)) * 100).alias("pct_of_total"),
                    "avg_revenue", "avg_profit", "avg_margin_pct",
                    (F.col("_r") / clip_lower("_tr", 1.0) * 100).alias("revenue_share_pct"),
                    (F.col("_p") / clip_lower("_tp", 1.0) * 100).alias("profit_share_pct")))


def store_cluster_profile(tx: DataFrame, stores: DataFrame, cluster: str = "cluster") -> DataFrame:
    e = base.by_store(tx).join(stores.select("store_id", cluster), "store_id", "left")
    return segment_profile(e, cluster, "store", "store_id")


def customer_segment_profile(tx: DataFrame, customers: DataFrame, tier: str = "tier", totals: DataFrame | None = None) -> DataFrame:
    """``totals``: a written ``base.by_customer`` to read instead of the transactions."""
    e = (base.by_customer(tx) if totals is None else totals).join(customers.select("customer_id", tier), "customer_id", "left")
    return segment_profile(e, tier, "customer", "customer_id")


def rfm_base(tx: DataFrame, reference_date=None, totals: DataFrame | None = None) -> DataFrame:
    """K3: recency_days (reference date − last purchase; default the latest
    date in the data), frequency (rows), monetary (Σ revenue).  ``totals``: a
    written ``base.customer_totals`` to read instead of the transactions."""
    t = tx.groupBy("customer_id").agg(
        F.max("date").alias("last_purchase"), F.count(F.lit(1)).alias("n_txns"),
        F.sum("gross_revenue").alias("total_spend")) if totals is None else totals
    ref = (F.lit(reference_date).cast("date") if reference_date is not None
           else F.to_date(t.agg(F.max("last_purchase")).scalar()))
    return t.select("customer_id", F.datediff(ref, F.to_date("last_purchase")).alias("recency_days"),
                    F.col("n_txns").alias("frequency"), F.col("total_spend").alias("monetary"))


def rfm_scores(rfm: DataFrame) -> DataFrame:
    """K4: quintile scores 1..5 (recency reversed) and the 3-digit code."""
    scores = quintile_scores_multi(rfm, "customer_id", {
        "recency_score": ("recency_days", True), "frequency_score": ("frequency", False),
        "monetary_score": ("monetary", False)})
    out = rfm.join(scores, "customer_id", "left")
    return out.withColumn("rfm_score", F.concat(
        F.col("recency_score").cast("string"), F.col("frequency_score").cast("string"),
        F.col("monetary_score").cast("string")))


def rfm_label(r="recency_score", f="frequency_score", m="monetary_score"):
    """K5: first matching rule wins.  Labels and score bounds are fixed values."""
    r, f, m = F.col(r), F.col(f), F.col(m)
    return (F.when((r == 5) & (f == 5) & (m == 5), "Champions")
            .when((r >= 4) & (f >= 4) & (m >= 4), "Loyal Customers")
            .when((r >= 4) & (f >= 2) & (m >= 2), "Potential Loyalists")
            .when((r >= 4) & (f <= 2) & (m <= 2), "Recent Customers")
            .when((r <= 2) & (f >= 4) & (m >= 3), "At Risk")
            .when((r == 1) & (f <= 2), "Lost")
            .when((r >= 3) & (f >= 3) & (m >= 3), "Promising")
            .otherwise("Needs Attention"))


def rfm_segments(scores: DataFrame) -> DataFrame:
    return scores.withColumn("segment_label", rfm_label())


def rfm_summary(segments: DataFrame) -> DataFrame:
    """K6: per label n_customers and mean monetary / frequency / recency."""
    return segments.groupBy("segment_label").agg(
        F.count(F.lit(1)).alias("n_customers"), F.avg("monetary").alias("avg_monetary"),
        F.avg("frequency").alias("avg_frequency"), F.avg("recency_days").alias("avg_recency_days"))


def segmentation_all(tx: DataFrame, stores: DataFrame, customers: DataFrame, totals: DataFrame) -> DataFrame:
    """Store profiles (K1), customer profiles (K2) and the RFM summary (K3-K6) as rows of ``segment_type`` store,
    customer and rfm.  RFM rows have the label as ``segment_name`` and their means in columns of their own, which are NULL for
    profiles, as the profiles' are for RFM rows.  Rows without a customer count for the reference date only.
    ``totals``: a written ``base.by_customer``, which profile and scores share."""
    purchases = totals.select("customer_id", F.col("last_date").alias("last_purchase"), "n_txns", F.col("revenue").alias("total_spend"))
    rfm = rfm_summary(rfm_segments(rfm_scores(rfm_base(tx, totals=purchases).where(F.col("customer_id").isNotNull()))))
    rows = rfm.select(F.lit("rfm").alias("segment_type"), F.col("segment_label").alias("segment_name"),
                      F.col("n_customers").alias("n_members"), "avg_monetary", "avg_frequency", "avg_recency_days")
    return store_cluster_profile(tx, stores).unionByName(customer_segment_profile(tx, customers, totals=totals)).unionByName(
        rows, allowMissingColumns=True)


def segment_counts(df: DataFrame, col: str) -> DataFrame:
    """Value counts, descending."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col(col))


def tier_revenue(tx: DataFrame, customers: DataFrame, tier: str = "tier") -> DataFrame:
    """K8: revenue, profit, distinct customers, margin % and revenue share by tier."""
    # one row per customer before the join: a customer holding a third of
    # all rows is a single row here, so the join cannot be skewed
    j = base.by_customer(tx).join(customers.select("customer_id", tier), "customer_id", "left")
    # NULL tiers are dropped, as pandas groupby drops NaN keys
    g = j.where(F.col(tier).isNotNull()).groupBy(tier).agg(
        F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"), F.count(F.lit(1)).alias("n_customers"))
    return (g.withColumn("margin_pct", div("profit", "revenue") * 100)
            .withColumn("revenue_share_pct", div(F.col("revenue"), g.agg(F.sum("revenue")).scalar()) * 100))


def cluster_stats(tx: DataFrame, stores: DataFrame, cluster: str = "cluster") -> DataFrame:
    """K9: transactions, revenue, profit, margin, shares and store count by cluster."""
    j = base.by_store(tx).join(stores.select("store_id", cluster), "store_id", "left")
    g = j.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(
        F.sum("n_txns").alias("n_txns"), F.sum("revenue").alias("revenue"),
        F.sum("profit").alias("profit"), F.count(F.lit(1)).alias("n_stores"))
    tot = g.agg(F.struct(F.sum("revenue").alias("r"), F.sum("profit").alias("p"))).scalar()
    return (g.withColumn("_t", tot).withColumn("margin_pct", div("profit", "revenue") * 100)
            .withColumn("revenue_share_pct", div(F.col("revenue"), F.col("_t.r")) * 100)
            .withColumn("profit_share_pct", div(F.col("profit"), F.col("_t.p")) * 100).drop("_t"))
