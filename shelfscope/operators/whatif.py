"""What-if impact tables.  Instead of one interactive call per
scenario, a *scenario table* (one row per scenario) is joined with
Spark-computed baselines; the heavy part is the baseline aggregate, the
light part is column arithmetic on the joined rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ranks
from ..functions.expr import div
from . import base


def annual_factor(tx: DataFrame | base.Rollups):
    """Column: 12 / number of distinct months (annualisation, D17)."""
    return F.lit(12.0) / base.n_months(tx)


def join_folded(scenarios: DataFrame, t: DataFrame, col: str, how: str = "inner") -> DataFrame:
    """``scenarios`` joined with ``t`` (one row per name) on the lower case of ``col``, which takes its spelling from
    ``t``; of names that differ in case alone the greatest counts, unknown names stay as they are."""
    others = [c for c in t.columns if c != col]
    folded = (t.groupBy(F.lower(col).alias("_low")).agg(F.max_by(F.struct(F.col(col).alias("_name"), *others), col).alias("_r"))
              .select("_low", "_r.*"))
    return (scenarios.join(folded, F.lower(col) == F.col("_low"), how)
            .withColumn(col, F.coalesce("_name", col)).drop("_low", "_name"))


def whatif_price(tx: DataFrame | base.Rollups, scenarios: DataFrame, elasticities: DataFrame,
                 default_elasticity: float = -1.0) -> DataFrame:
    """O1: scenarios (scenario_id, category, price_change_pct,
    elasticity_override) → annual baseline vs projected portfolio revenue /
    profit; projected category profit = projected revenue × baseline margin;
    confidence 0.80 when |ε| < 1 else 0.70.  Categories are looked up without
    regard to case."""
    af = annual_factor(tx)
    cat = base.by_category(tx).select("category", (F.col("revenue") * af).alias("cat_rev"),
                                      (F.col("profit") * af).alias("cat_profit"))
    tot = baseline(tx)
    s = (join_folded(scenarios, cat, "category").join(elasticities.select("category", "elasticity"), "category", "left")
         .withColumn("_t", tot))
    e = F.coalesce(F.col("elasticity_override"), F.col("elasticity"), F.lit(default_elasticity))
    dp = F.col("price_change_pct")
    margin = F.when(F.col("cat_rev") > 0, F.col("cat_profit") / F.col("cat_rev")).otherwise(0.0)
    proj_cat_rev = F.col("cat_rev") * (1 + dp) * (1 + e * dp)
    proj_rev = F.col("_t.rev") - F.col("cat_rev") + proj_cat_rev
    proj_profit = F.col("_t.profit") - F.col("cat_profit") + proj_cat_rev * margin
    return s.select(
        "scenario_id", F.lit("price_change").alias("scenario_type"), "category", "price_change_pct",
        e.alias("elasticity_used"), F.col("_t.rev").alias("baseline_revenue"),
        F.col("_t.profit").alias("baseline_profit"), proj_rev.alias("projected_revenue"),
        proj_profit.alias("projected_profit"), (proj_rev - F.col("_t.rev")).alias("revenue_delta"),
        (proj_profit - F.col("_t.profit")).alias("profit_delta"),
        F.when(F.abs(e) < 1.0, 0.80).otherwise(0.70).alias("confidence"))


def baseline(tx: DataFrame | base.Rollups):
    """Annual portfolio revenue and profit as one scalar-subquery struct."""
    af = annual_factor(tx)
    return base.portfolio(tx).select(F.struct((F.col("revenue") * af).alias("rev"),
                                              (F.col("profit") * af).alias("profit")).alias("b")).scalar()


def _projection(df: DataFrame, revenue_gain, profit_gain, confidence: float) -> DataFrame:
    """Baseline vs projected portfolio columns with the reference's profit
    floor: projected profit ≥ 0.5 × baseline profit."""
    base_rev, base_profit = F.col("_b.rev"), F.col("_b.profit")
    proj_rev = base_rev + revenue_gain
    proj_profit = F.greatest(base_profit + profit_gain, base_profit * 0.5)
    return (df.withColumn("baseline_revenue", base_rev).withColumn("baseline_profit", base_profit)
            .withColumn("projected_revenue", proj_rev).withColumn("projected_profit", proj_profit)
            .withColumn("revenue_delta", proj_rev - base_rev).withColumn("profit_delta", proj_profit - base_profit)
            .withColumn("confidence", F.lit(confidence)))


PROJECTION_COLS = ["baseline_revenue", "baseline_profit", "projected_revenue", "projected_profit",
                   "revenue_delta", "profit_delta"]


def whatif_store_investment(tx: DataFrame | base.Rollups, scenarios: DataFrame, q: float = 0.2) -> DataFrame:
    """Scenarios (scenario_id, n_stores, investment_per_store,
    revenue_uplift_pct).  Among stores with margin ≤ p20 take the n worst by
    margin (ties by store id); uplift = their annual revenue × pct, earning
    the portfolio margin; the investment (requested n × per-store) is
    amortised over 3 years; profit floor 0.5 × baseline; confidence 0.65.
    The largest n of the scenarios bounds a distributed top-k; its running revenue is looked up
    at each scenario's n."""
    af = annual_factor(tx)
    s = base.by_store(tx).withColumn("margin", div("profit", "revenue"))
    p = ranks.quantiles(s, "margin", [q], ["p"]).scalar()
    most = int(scenarios.agg(F.max("n_stores")).first()[0] or 0)  # a parameter, not data
    worst = s.where(F.col("margin") <= p).orderBy("margin", "store_id").limit(most)
    order = Window.orderBy("margin", "store_id")  # over the k survivors
    ranked = worst.select(F.row_number().over(order).alias("worst_rank"), (F.sum("revenue").over(order) * af).alias("_rev"))
    found = ranked.agg(F.count(F.lit(1))).scalar()
    at = scenarios.withColumn("stores_selected", F.least(F.col("n_stores").cast("long"), found))
    x = at.join(ranked, F.col("stores_selected") == F.col("worst_rank"), "left").withColumn("_b", baseline(tx))
    margin = F.when(F.col("_b.rev") > 0, F.col("_b.profit") / F.col("_b.rev")).otherwise(0.0)
    uplift = F.coalesce(F.col("_rev"), F.lit(0.0)) * F.col("revenue_uplift_pct")
    cost = F.col("n_stores") * F.col("investment_per_store")
    out = _projection(x.withColumn("implementation_cost", cost), uplift, uplift * margin - cost / 3, 0.65)
    return out.select("scenario_id", F.lit("store_investment").alias("scenario_type"), "stores_selected",
                      *PROJECTION_COLS, "implementation_cost", "confidence")


DEFAULT_CHURN_RATE = 0.18


def whatif_retention(tx: DataFrame | base.Rollups, customers: DataFrame, scenarios: DataFrame, rates: dict[str, float] | None = None,
                     days: int = 180, tier: str = "tier", all_label: str = "All") -> DataFrame:
    """O3: scenarios (scenario_id, tier | 'All', churn_reduction_pct,
    intervention_cost).  Customers at risk = the tier's customers; annual
    value = the tier's annual profit ÷ customers; churn rate = ``rates`` by tier (0.18 for
    others), or without ``rates`` the tier's observed rate (no purchase in ``days``; 0.18 when unknown); churners =
    floor(n · rate); impact = churners · reduction · annual value, net of the
    intervention cost; profit floor 0.5 × baseline; confidence 0.75.  Tiers are looked up without regard to case."""
    af = annual_factor(tx)
    max_date = base.portfolio(tx).select("last_date").scalar()
    per_c = base.by_customer(tx).select("customer_id", F.col("last_date").alias("_last"), F.col("profit").alias("_p"))
    c = customers.select("customer_id", tier).join(per_c, "customer_id", "left")
    churned = F.coalesce(F.col("_last") < max_date - F.expr(f"INTERVAL {days} DAYS"), F.lit(False))
    stats = [F.count(F.lit(1)).alias("n_customers"), F.count_if(churned).alias("_ch"),
             F.sum(F.coalesce(F.col("_p"), F.lit(0.0))).alias("_profit")]
    t = c.groupBy(tier).agg(*stats).unionByName(c.agg(*stats).select(F.lit(all_label).alias(tier), "*"))
    x = join_folded(scenarios, t, tier, "left").withColumn("_b", baseline(tx))
    n = F.coalesce(F.col("n_customers"), F.lit(0))
    if rates is None:
        rate = F.coalesce(div("_ch", "n_customers"), F.lit(DEFAULT_CHURN_RATE))
    else:
        table = F.create_map(*[v for k, x_ in rates.items() for v in (F.lit(k), F.lit(float(x_)))])
        rate = F.coalesce(F.try_element_at(table, F.col(tier)), F.lit(DEFAULT_CHURN_RATE))
    value = F.coalesce(div(F.col("_profit") * af, F.col("n_customers")), F.lit(0.0))
    churners = F.floor(n * rate)
    impact = churners * F.col("churn_reduction_pct") * value
    x = (x.withColumn("churn_rate", rate).withColumn("annual_value_per_customer", value)
         .withColumn("n_churners", churners.cast("long")).withColumn("value_at_risk", churners * value)
         .withColumn("implementation_cost", F.col("intervention_cost")))
    out = _projection(x, impact, impact - F.col("intervention_cost"), 0.75)
    return out.select("scenario_id", F.lit("retention").alias("scenario_type"), tier,
                      n.cast("long").alias("n_customers"), "churn_rate", "annual_value_per_customer", "n_churners", "value_at_risk",
                      *PROJECTION_COLS, "implementation_cost", "confidence")


def financial_impact(df: DataFrame, revenue: str = "revenue_delta", profit: str = "profit_delta",
                     cost: str = "implementation_cost", months: str = "timeline_months",
                     rate: float = 0.10) -> DataFrame:
    """ROI, payback months (capped at 999), 3-year NPV with the ramp
    delay, annualised impact."""
    p, c = F.col(profit), F.col(cost)
    monthly = p / 12.0
    payback = (F.when(c <= 0, F.lit(0))
               .when(monthly > 0, F.least(F.floor(c / monthly), F.lit(999)))
               .otherwise(F.lit(999))).cast("int")
    ramp = F.col(months) / 12.0
    npv = reduce(lambda a, b: a + b, [p / F.pow(F.lit(1 + rate), F.lit(y) + ramp) for y in (1, 2, 3)]) - c
    roi = F.when(c > 0, p / c).when(p > 0, F.lit(float("inf"))).otherwise(0.0)
    return df.withColumns({"roi": roi, "payback_months": payback, "npv_3yr": npv,
                           "annualized_impact": (p * 3 - c) / 3})
