"""P-family: KPI roll-ups (headline totals, financial summary, churn,
store performance, category views, basket and brand margins)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ranks
from ..functions.expr import div, month_index, one_row_join
from . import base


def n_distinct(df: DataFrame, col: str):
    """Exact distinct count of one column as a scalar subquery: a map-side
    de-duplicated aggregate over the single pruned column (several of these
    avoid the row-multiplying Expand of multiple count-distinct aggregates)."""
    return (df.select(col).where(F.col(col).isNotNull()).distinct()
            .agg(F.count(F.lit(1))).scalar())


def kpi_summary(tx: DataFrame) -> DataFrame:
    """Revenue, profit, margin, row / customer / store / product counts,
    date range, month count and the sorted category list."""
    cats = (tx.select("category").where(F.col("category").isNotNull()).distinct()
            .agg(F.array_sort(F.collect_list("category"))).scalar())
    return tx.agg(
        F.sum("gross_revenue").alias("total_revenue"), F.sum("gross_profit").alias("total_profit"),
        F.count(F.lit(1)).alias("n_transactions"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
    ).select(
        "total_revenue", "total_profit", "n_transactions",
        n_distinct(tx, "customer_id").alias("n_customers"), n_distinct(tx, "store_id").alias("n_stores"),
        n_distinct(tx, "product_id").alias("n_products"), "first_date", "last_date",
        n_distinct(tx, "period").alias("n_months"), cats.alias("categories"),
        (div("total_profit", "total_revenue") * 100).alias("margin_pct"))


def with_month_num(tx: DataFrame) -> DataFrame:
    """1-based month number from the first month in the data."""
    first = tx.agg(F.min("period")).scalar()
    return tx.withColumn("month_num", month_index("period", first))


def financial_summary(tx: DataFrame, early_months: int = 3, late_months: int = 3) -> DataFrame:
    """Totals, annualised totals (÷ months/12), margin of the first vs
    the last months (ratio of sums; falls back to the overall margin)."""
    t = with_month_num(tx)
    last = t.agg(F.max("month_num")).scalar()
    early = F.col("month_num") <= early_months
    late = F.col("month_num") > last - late_months
    a = t.agg(
        F.sum("gross_revenue").alias("total_revenue"), F.sum("gross_profit").alias("total_profit"),
        F.count(F.lit(1)).alias("n_transactions"),
        F.sum(F.when(early, F.col("gross_profit"))).alias("_ep"), F.sum(F.when(early, F.col("gross_revenue"))).alias("_er"),
        F.sum(F.when(late, F.col("gross_profit"))).alias("_lp"), F.sum(F.when(late, F.col("gross_revenue"))).alias("_lr")
    ).withColumns({"n_months": n_distinct(tx, "period"), "n_customers": n_distinct(tx, "customer_id"),
                   "n_stores": n_distinct(tx, "store_id")})
    avg_m = F.when(F.col("total_revenue") > 0, F.col("total_profit") / F.col("total_revenue")).otherwise(0.0)
    ms = F.coalesce(div("_ep", "_er"), avg_m)
    me = F.coalesce(div("_lp", "_lr"), avg_m)
    years = F.col("n_months") / 12
    return a.select("total_revenue", "total_profit",
                    (F.col("total_revenue") / years).alias("annualised_revenue"),
                    (F.col("total_profit") / years).alias("annualised_profit"),
                    (avg_m * 100).alias("avg_margin_pct"), (ms * 100).alias("margin_start_pct"),
                    (me * 100).alias("margin_end_pct"), ((me - ms) * 100).alias("margin_change_pp"),
                    "n_stores", "n_customers", "n_transactions", "n_months")


def churn_by_tier(tx: DataFrame, customers: DataFrame, days: int = 180, tier: str = "tier") -> DataFrame:
    """Customers whose last purchase is more than ``days`` before the
    latest date are churned; per tier counts, rate and whether it is the worst tier (of equal rates the first by
    name), plus an ALL row whose denominator is every customer (buyers or not)."""
    max_date = tx.agg(F.max("date")).scalar()
    last = tx.groupBy("customer_id").agg(F.max("date").alias("_last"))
    c = customers.select("customer_id", tier).join(last, "customer_id", "left").withColumn(
        "_churned", F.coalesce(F.col("_last") < max_date - F.expr(f"INTERVAL {days} DAYS"), F.lit(False)))
    per = c.groupBy(tier).agg(F.count(F.lit(1)).alias("n_customers"), F.count_if("_churned").alias("n_churned"))
    allr = c.agg(F.count(F.lit(1)).alias("n_customers"), F.count_if("_churned").alias("n_churned")).select(
        F.lit("ALL").alias(tier), "n_customers", "n_churned")
    rate = F.when(F.col("n_customers") > 0, F.col("n_churned") / F.col("n_customers")).otherwise(0.0)
    worst = F.row_number().over(Window.orderBy(F.col("churn_rate").desc(), F.col(tier).asc_nulls_last())) == 1  # a row per tier
    per = per.withColumn("churn_rate", rate).withColumn("is_most_churned", worst)
    return per.unionByName(allr.withColumn("churn_rate", rate).withColumn("is_most_churned", F.lit(False)))


def tier_activity_shift(tx: DataFrame, customers: DataFrame, focus: str, split_month: int = 24,
                        days: int = 180, tier: str = "tier") -> DataFrame:
    """P3 (focus tier): inactive share of the tier before / after the split
    month, annual revenue per tier customer and revenue at risk of its
    churners."""
    max_date = tx.agg(F.max("date")).scalar()
    ids = customers.where(F.col(tier) == focus).select("customer_id")
    cm = with_month_num(tx.groupBy("customer_id", "period").agg(
        F.max("date").alias("_d"), F.sum("gross_revenue").alias("_r")))
    per_c = cm.join(ids, "customer_id", "left_semi").groupBy("customer_id").agg(
        F.max(F.when(F.col("month_num") <= split_month, 1)).alias("_pre"),
        F.max(F.when(F.col("month_num") > split_month, 1)).alias("_post"),
        F.max("_d").alias("_last"), F.sum("_r").alias("_rev"))
    n_months = tx.agg(F.count_distinct("period")).scalar()
    a = ids.join(per_c, "customer_id", "left").agg(
        F.count(F.lit(1)).alias("n_customers"), F.count("_pre").alias("_npre"), F.count("_post").alias("_npost"),
        F.count_if(F.coalesce(F.col("_last") < max_date - F.expr(f"INTERVAL {days} DAYS"), F.lit(False)))
        .alias("n_churners"), F.sum("_rev").alias("_rev"))
    n = F.col("n_customers")
    per_cust = F.when(n > 0, F.coalesce(F.col("_rev"), F.lit(0.0)) / (n_months / 12) / n).otherwise(0.0)
    pre, post = 1 - div("_npre", n), 1 - div("_npost", n)
    return a.select(F.lit(focus).alias("tier"), "n_customers", "n_churners",
                    pre.alias("churn_pre"), post.alias("churn_post"),
                    ((post - pre) * 100).alias("churn_acceleration_pp"),
                    per_cust.alias("annual_revenue_per_customer"),
                    (per_cust * F.col("n_churners")).alias("revenue_at_risk"))


def store_performance(tx: DataFrame, stores: DataFrame, top_n: int = 10) -> DataFrame:
    """Revenue share of the top ``top_n`` stores, mean margin (%) of the
    bottom-quartile stores (margin ≤ p25), stores at or below break-even and
    the store count (margins as fractions, as the source)."""
    s = base.by_store(tx).withColumn("margin", div("profit", "revenue"))
    top = ranks.top_k_sum(s, "revenue", k=top_n).select(
        div("top_sum", "total").alias("top_stores_revenue_share"))
    p25 = ranks.quantiles(s, "margin", [0.25], ["p25"]).scalar()
    low = s.withColumn("_p25", p25).agg(
        (F.avg(F.when(F.col("margin") <= F.col("_p25"), F.col("margin"))) * 100).alias("bottom_quartile_avg_margin_pct"),
        F.count_if(F.col("margin") <= 0).alias("stores_below_breakeven"))
    return one_row_join(top, low).withColumn("total_stores", stores.agg(F.count(F.lit(1))).scalar())


def category_performance(tx: DataFrame) -> DataFrame:
    """Revenue, profit, margin and revenue share per category."""
    c = base.by_category(tx.where(F.col("category").isNotNull()))
    return (c.withColumn("margin_pct", div("profit", "revenue") * 100)
            .withColumn("revenue_share_pct", div(F.col("revenue"), c.agg(F.sum("revenue")).scalar()) * 100)
            .select("category", "revenue", "profit", "margin_pct", "revenue_share_pct"))


def margin_matrix(tx: DataFrame, stores: DataFrame, rows: str = "category", cols: str = "cluster",
                  values: list[str] | None = None) -> DataFrame:
    """Margin % pivot, ``rows`` × ``cols`` (ratio of sums)."""
    part = tx.groupBy(rows, "store_id").agg(F.sum("gross_profit").alias("_p"), F.sum("gross_revenue").alias("_r"))
    j = part.join(stores.select("store_id", cols), "store_id", "left")
    g = j.groupBy(rows, cols).agg((div(F.sum("_p"), F.sum("_r")) * 100).alias("m"))
    return g.groupBy(rows).pivot(cols, values).agg(F.first("m"))


def avg_basket(tx: DataFrame) -> DataFrame:
    """Key financial metrics of the report: totals, annualised revenue /
    profit (÷ months/12), average margin, transaction rows and the average
    basket = mean revenue per transaction row (a transaction is one line)."""
    years = n_distinct(tx, "period") / 12
    a = tx.agg(F.sum("gross_revenue").alias("total_revenue"), F.sum("gross_profit").alias("total_profit"),
               F.count(F.lit(1)).alias("n_transactions"), F.avg("gross_revenue").alias("avg_basket_value"))
    return a.select("total_revenue", "total_profit", (F.col("total_revenue") / years).alias("annual_revenue"),
                    (F.col("total_profit") / years).alias("annual_profit"),
                    (div("total_profit", "total_revenue") * 100).alias("avg_margin_pct"),
                    "n_transactions", "avg_basket_value")


def brand_margin(tx: DataFrame, brand: str = "brand_type", reference: str = "national_brand") -> DataFrame:
    """P10: mean product margin by brand type and its ratio to the
    ``reference`` brand's mean (private label ÷ national brand)."""
    pm = (tx.groupBy("product_id", brand).agg(F.sum("gross_profit").alias("p"), F.sum("gross_revenue").alias("r"))
          .withColumn("m", div("p", "r") * 100))
    g = pm.groupBy(brand).agg(F.avg("m").alias("mean_margin_pct"), F.count(F.lit(1)).alias("n_products"))
    ref = g.where(F.col(brand) == reference).agg(F.max("mean_margin_pct")).scalar()
    return g.withColumn("ratio_to_national_brand", div(F.col("mean_margin_pct"), ref))


def discount_leaders(tx: DataFrame, k: int = 3) -> DataFrame:
    """The k categories with the highest mean discount (ties by name)."""
    g = tx.groupBy("category").agg((F.avg("discount_pct") * 100).alias("avg_discount_pct"))
    return g.orderBy(F.col("avg_discount_pct").desc(), "category").limit(k)


def private_label_mix(tx: DataFrame, elasticities: DataFrame | None = None, brand: str = "brand_type",
                      pl: str = "private_label", nb: str = "national_brand", price_up: float = 0.05) -> DataFrame:
    """Private-label vs national-brand margin (ratio of sums), premium
    multiple, private-label revenue mix and the annual revenue opportunity of
    a +5 % price on inelastic categories (|ε| < 1)."""
    a = tx.agg(
        F.sum(F.when(F.col(brand) == pl, F.col("gross_profit"))).alias("_pp"),
        F.sum(F.when(F.col(brand) == pl, F.col("gross_revenue"))).alias("_pr"),
        F.sum(F.when(F.col(brand) == nb, F.col("gross_profit"))).alias("_np"),
        F.sum(F.when(F.col(brand) == nb, F.col("gross_revenue"))).alias("_nr"))
    plm = F.when(F.col("_pr") > 0, F.col("_pp") / F.col("_pr")).otherwise(0.0)
    nbm = F.when(F.col("_nr") > 0, F.col("_np") / F.col("_nr")).otherwise(0.0)
    out = a.select((plm * 100).alias("pl_margin_pct"), (nbm * 100).alias("nb_margin_pct"),
                   F.when(nbm > 0, plm / nbm).alias("pl_margin_premium_mult"),
                   (div(F.col("_pr"), F.col("_pr") + F.col("_nr")) * 100).alias("pl_revenue_share_pct"))
    if elasticities is None:
        return out
    years = tx.agg(F.count_distinct("period") / 12).scalar()
    inel = elasticities.where(F.abs("elasticity") < 1).select("category", "elasticity")
    opp = (tx.groupBy("category").agg(F.sum("gross_revenue").alias("_r")).join(inel, "category")
           .agg(F.sum(F.col("_r") / years * ((1 + price_up) * (1 + F.col("elasticity") * price_up) - 1))))
    return out.withColumn("inelastic_revenue_opportunity", F.coalesce(opp.scalar(), F.lit(0.0)))
