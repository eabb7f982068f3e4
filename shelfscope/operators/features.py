"""L-family: customer / store / product feature tables, churn labels and
marketing-efficiency features.  One row per entity, explicit key column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ranks
from ..functions.expr import clip_lower, div, whole_months_between
from . import base, segment


def one_hot(df: DataFrame, col: str, levels: list[str], prefix: str) -> DataFrame:
    """0/1 indicator per level (levels fixed up front so the schema
    does not depend on the data)."""
    return df.withColumns({f"{prefix}_{lv.lower().replace(' ', '_')}": (F.col(col) == lv).cast("int")
                           for lv in levels})


def customer_features(tx: DataFrame, customers: DataFrame, stores: DataFrame, tier_levels: list[str],
                      region_levels: list[str], totals: DataFrame | None = None) -> DataFrame:
    """L1 (``totals``: a written ``base.customer_totals`` to read instead of the transactions): purchase behaviour, RFM scores, preferred store cluster (mode,
    smallest on ties), tenure in months, tier code and dummies; customers
    without purchases get 0 / NULL-safe fills."""
    agg = base.customer_totals(tx) if totals is None else totals
    ref = agg.agg(F.max("last_purchase")).scalar()
    rfm = segment.rfm_scores(segment.rfm_base(tx, totals=totals)).select(
        "customer_id", "recency_score", "frequency_score", "monetary_score")
    # preferred cluster = the mode of the cluster over the customer's rows
    # (smallest on ties), from (customer, store) counts so that no row-level
    # join with the store dimension is needed
    cs = tx.groupBy("customer_id", "store_id").agg(F.count(F.lit(1)).alias("_n"))
    cc = (cs.join(stores.select("store_id", "cluster"), "store_id", "left")
          .groupBy("customer_id", "cluster").agg(F.sum("_n").alias("_n")))
    w = Window.partitionBy("customer_id").orderBy(F.col("_n").desc(), F.col("cluster").asc_nulls_last())
    pref = (cc.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") == 1)
            .select("customer_id", F.col("cluster").alias("preferred_cluster")))
    agg = agg.join(pref, "customer_id", "left")
    # ordinal code of the tier, 0-based (0 also for unknown tiers, as the source)
    tier_code = F.create_map(*[x for i, lv in enumerate(tier_levels) for x in (F.lit(lv), F.lit(i))])
    # one row per buying customer (as the source's RFM frame), customer
    # attributes joined on
    c = (agg.join(customers.select("customer_id", "tier", "customer_region"), "customer_id", "left")
         .join(rfm, "customer_id", "left")
         .withColumn("recency_days", F.datediff(F.to_date(F.lit(ref)), F.to_date("last_purchase")))
         .withColumn("avg_basket", div("total_spend", F.greatest(F.col("n_txns"), F.lit(1))))
         .withColumn("months_as_customer", whole_months_between(F.lit(ref), "first_purchase"))
         .withColumn("tier_code", tier_code[F.col("tier")]))
    c = one_hot(c, "tier", tier_levels, "tier")
    c = one_hot(c, "customer_region", region_levels, "region")
    c = c.drop("first_purchase")
    # numeric gaps → 0, text gaps → "unknown" (as the source)
    numeric = [f.name for f in c.schema.fields
               if f.dataType.typeName() in ("integer", "long", "double") and f.name != "customer_id"]
    text = [f.name for f in c.schema.fields if f.dataType.typeName() == "string"]
    return c.fillna(0, subset=numeric).fillna("unknown", subset=text)


def churn_label(features: DataFrame, days: int = 90) -> DataFrame:
    """L2 (literal form): churned when recency ≥ ``days`` (customers without
    purchases count as churned)."""
    return features.withColumn("is_churned", F.coalesce(F.col("recency_days") >= days, F.lit(True)).cast("int"))


def point_in_time_churn(tx: DataFrame, cutoff: str, horizon_days: int = 90) -> DataFrame:
    """L2 (leak-free form): features from purchases up to ``cutoff``; label 1
    when the customer buys nothing in the next ``horizon_days``."""
    cut = F.to_timestamp_ntz(F.lit(cutoff))
    hist = tx.where(F.col("date") <= cut)
    fut = tx.where((F.col("date") > cut) & (F.col("date") <= cut + F.expr(f"INTERVAL {horizon_days} DAYS")))
    f = hist.groupBy("customer_id").agg(
        F.datediff(F.to_date(cut), F.to_date(F.max("date"))).alias("recency_days"),
        F.count(F.lit(1)).alias("n_txns"), F.sum("gross_revenue").alias("total_spend"),
        F.avg("discount_pct").alias("avg_discount"))
    active = fut.select("customer_id").distinct().withColumn("_active", F.lit(1))
    return f.join(active, "customer_id", "left").withColumn(
        "is_churned", F.when(F.col("_active").isNull(), 1).otherwise(0)).drop("_active")


def store_months(tx: DataFrame) -> DataFrame:
    """Revenue, profit and operating cost per (store, month)."""
    return tx.groupBy("store_id", "period").agg(
        F.sum("gross_revenue").alias("rev"), F.sum("gross_profit").alias("prof"),
        F.sum("operating_cost").alias("total_operating_cost"))


def store_revenue_slope(tx: DataFrame, months: DataFrame | None = None) -> DataFrame:
    """L4 (``months``: written ``store_months`` to read instead of the transactions): OLS slope of monthly revenue on 0..n−1 per store (0 when fewer than
    2 months or constant).  The window is per store over its months."""
    m = (tx.groupBy("store_id", "period").agg(F.sum("gross_revenue").alias("revenue")) if months is None
         else months.select("store_id", "period", F.col("rev").alias("revenue")))
    m = m.withColumn("x", (F.row_number().over(Window.partitionBy("store_id").orderBy("period")) - 1).cast("double"))
    return m.groupBy("store_id").agg(F.coalesce(F.regr_slope("revenue", "x"), F.lit(0.0)).alias("revenue_slope"))


def store_features(tx: DataFrame, stores: DataFrame, costs: DataFrame | None, cluster_levels: list[str],
                   months: DataFrame | None = None) -> DataFrame:
    """Monthly revenue / profit means and volatility, active months,
    margin ratio, revenue slope, mean monthly operating cost and its ratio to
    revenue, store attributes, cluster code and dummies.  ``months``: written
    ``store_months`` to read instead of the transactions; they hold the costs where ``costs`` is None."""
    monthly = tx.groupBy("store_id", "period").agg(F.sum("gross_revenue").alias("rev"),
                                                   F.sum("gross_profit").alias("prof")) if months is None else months
    m = monthly.groupBy("store_id").agg(
        F.avg("rev").alias("avg_monthly_revenue"), F.avg("prof").alias("avg_monthly_profit"),
        F.stddev_samp("rev").alias("revenue_volatility"), F.count(F.lit(1)).alias("active_months"),
        F.sum("prof").alias("_p"), F.sum("rev").alias("_r"))
    costs = months if costs is None else costs
    cost = costs.groupBy("store_id").agg(F.avg("total_operating_cost").alias("avg_monthly_cost"))
    # 0-based cluster code, −1 when unknown (as the source)
    code = F.create_map(*[x for i, lv in enumerate(cluster_levels) for x in (F.lit(lv), F.lit(i))])
    # one row per store with transactions (the source's monthly frame), attributes joined on
    s = (m.join(stores.select("store_id", "size", "cluster"), "store_id", "left")
         .join(store_revenue_slope(tx, months), "store_id", "left").join(cost, "store_id", "left")
         .withColumn("margin_ratio", F.col("_p") / clip_lower("_r", 1.0))
         .withColumn("cost_ratio", F.col("avg_monthly_cost") / clip_lower("avg_monthly_revenue", 1.0))
         .withColumn("cluster_code", F.coalesce(code[F.col("cluster")], F.lit(-1)))
         .drop("_p", "_r"))
    s = one_hot(s, "cluster", cluster_levels, "cluster")
    numeric = [f.name for f in s.schema.fields
               if f.dataType.typeName() in ("integer", "long", "double") and f.name != "store_id"]
    return s.fillna(0, subset=numeric)


def top_performer_label(features: DataFrame, col: str = "avg_monthly_profit", q: float = 0.8) -> DataFrame:
    """1 when ``col`` ≥ its p80 across entities."""
    thr = ranks.quantiles(features, col, [q], ["t"]).scalar()
    return features.withColumn("is_top_performer", F.coalesce(F.col(col) >= thr, F.lit(False)).cast("int"))


def market_marketing_features(marketing: DataFrame, response: DataFrame, digital: str = "click") -> DataFrame:
    """Total spend, digital share (÷ max(total, 1)), mean daily revenue
    and marketing efficiency = mean revenue per period ÷ total spend."""
    s = marketing.groupBy("market").agg(
        F.sum("spend").alias("total_spend"),
        F.sum(F.when(F.col("channel") == digital, F.col("spend")).otherwise(0.0)).alias("_d"))
    r = response.groupBy("market").agg(F.avg("revenue").alias("avg_period_revenue"))
    return (s.join(r, "market", "left")
            .withColumn("digital_share", F.col("_d") / clip_lower("total_spend", 1.0))
            .withColumn("marketing_efficiency", F.col("avg_period_revenue") / clip_lower("total_spend", 1.0))
            .drop("_d"))


def dense_code(df: DataFrame, col: str, out: str) -> DataFrame:
    """0-based code of ``col`` in the sorted list of its distinct
    values (−1 for NULL).  The code table has one row per distinct value."""
    codes = (df.select(col).where(F.col(col).isNotNull()).distinct()
             .withColumn(out, (F.dense_rank().over(Window.orderBy(col)) - 1).cast("int")))
    return df.join(codes, col, "left").withColumn(out, F.coalesce(F.col(out), F.lit(-1)))


def product_features(tx: DataFrame, products: DataFrame, category_levels: list[str]) -> DataFrame:
    """Units, revenue, profit, rows, mean unit price, mean discount, price
    std, margin % (÷ max(revenue, 1)), % share of the category's revenue
    (÷ max(category revenue, 1)), brand code and category dummies; one row
    per product with sales, catalogue attributes joined on, numeric gaps 0."""
    p = tx.groupBy("product_id").agg(
        F.sum("quantity").alias("units"), F.sum("gross_revenue").alias("revenue"),
        F.sum("gross_profit").alias("profit"), F.count(F.lit(1)).alias("n_txns"),
        F.avg("unit_price").alias("avg_price"), F.avg("discount_pct").alias("avg_discount"),
        F.stddev_samp("unit_price").alias("price_std"))
    b = p.join(products.select("product_id", "category", "subcategory", "brand_type", "unit_cost"),
               "product_id", "left")
    # category totals as an aggregate + join (a window per category would put
    # every product of a category into one task)
    cat = b.groupBy("category").agg(F.sum("revenue").alias("_cat_rev"))
    out = (b.join(cat, "category", "left")
           .withColumn("margin_pct", F.col("profit") / clip_lower("revenue", 1.0) * 100)
           .withColumn("category_share_pct", F.col("revenue") / clip_lower("_cat_rev", 1.0) * 100).drop("_cat_rev")
           .withColumn("is_private_label", (F.col("brand_type") == "private_label").cast("int")))
    out = dense_code(out, "brand_type", "brand_type_code")
    out = one_hot(out, "category", category_levels, "cat")
    numeric = [f.name for f in out.schema.fields
               if f.dataType.typeName() in ("integer", "long", "double") and f.name != "product_id"]
    return out.fillna(0, subset=numeric)
