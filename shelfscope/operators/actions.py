"""Data-derived recommendations, RICE ranking, filters and
the action summary.  Each recommendation row is computed from Spark
aggregates; the catalogue parameters (impact score, effort, cost, timeline)
are a small parameter table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ranks
from ..functions.expr import div
from . import base
from .whatif import annual_factor, baseline, financial_impact, whatif_retention


def _row(df: DataFrame, rec_id: str, reach, revenue_delta, profit_delta) -> DataFrame:
    return df.select(F.lit(rec_id).alias("rec_id"), reach.cast("long").alias("reach"),
                     revenue_delta.cast("double").alias("revenue_delta"),
                     profit_delta.cast("double").alias("profit_delta"))


# Fixed values of the recommendation rules (must equal the reference's).
PRICE_UP = 0.05               # REC-001: +5 % price on inelastic categories
PL_SHARE_POINTS = 0.05        # REC-002: private-label share +5 points of revenue
PL_REVENUE_FACTOR = 0.5       # REC-002: half of the shifted revenue is incremental
REVENUE_PER_CUSTOMER = 150.0  # REC-002: reach proxy, customers touched per $150
DISCOUNT_CUT = 0.03           # REC-003: discounts −3 points of revenue
CHURN_REDUCTION = 0.30        # REC-006: churn reduced by 30 %
RETENTION_COST = 500_000.0    # REC-006: intervention cost
ASSUMED_CHURN = 0.20          # REC-006: reach = 20 % of the tier
OPS_UPLIFT = 0.10             # REC-007: +10 % revenue on mid-margin stores
STORE_COST = 800_000.0        # REC-008: annual operating cost per store
CLOSURE_NET = 0.30            # REC-008: 30 % of that cost is a net gain
CLOSURE_REVENUE_LOSS = 0.5    # REC-008: half of the closed stores' revenue is lost


def recommendations(tx: DataFrame | base.Rollups, customers: DataFrame, elasticities: DataFrame, params: DataFrame,
                    focus_tier: str, rates: dict[str, float] | None = None, marketing: DataFrame | None = None,
                    tier: str = "tier") -> DataFrame:
    """``marketing`` holds O2 rows named REC-004 / REC-005 (with n_stores), ``rates`` the churn table.  One row per recommendation (reach, annual revenue / profit
    deltas) computed from Spark aggregates, joined with the catalogue
    parameters (category, impact score, confidence, effort, cost, ROI
    fallback, priority, timeline); ROI = profit ÷ cost when positive else
    the fallback; O6 payback / NPV / annualised impact."""
    af = annual_factor(tx)
    b = baseline(tx)
    base_rev = b.getField("rev")
    base_margin = div(b.getField("profit"), b.getField("rev"))
    one = tx.sparkSession.range(1)  # a row to carry scalars
    # REC-001: price +5 % on inelastic categories (|ε| < 1), O1 deltas summed
    inel = elasticities.where(F.abs("elasticity") < 1).select("category", "elasticity")
    mult = (1 + PRICE_UP) * (1 + F.col("elasticity") * PRICE_UP) - 1
    r1 = base.by_category(tx).join(inel, "category").agg(
        F.sum(F.col("revenue") * af * mult).alias("rd"), F.sum(F.col("profit") * af * mult).alias("pd"))
    pairs = base.customer_categories(tx)
    reach1 = n_distinct_customers(pairs.join(inel, "category", "left_semi"))
    rec1 = _row(r1, "REC-001", F.coalesce(reach1, F.lit(0)), F.coalesce(F.col("rd"), F.lit(0.0)),
                F.coalesce(F.col("pd"), F.lit(0.0)))
    # REC-002: private-label share +5 points at the private-label margin premium
    m = base.brand_margins(tx)
    rec2 = _row(m, "REC-002", F.floor(base_rev * PL_SHARE_POINTS / REVENUE_PER_CUSTOMER),
                base_rev * PL_SHARE_POINTS * PL_REVENUE_FACTOR,
                base_rev * PL_SHARE_POINTS * (F.col("pl") - F.col("nb")))
    # REC-003: discount −3 points, revenue neutral
    rec3 = _row(one, "REC-003", n_distinct_customers(pairs), F.lit(0.0), base_rev * DISCOUNT_CUT)
    # REC-006: O3 on the focus tier
    spark = tx.sparkSession
    sc = spark.createDataFrame([("REC-006", focus_tier, CHURN_REDUCTION, RETENTION_COST)],
                               f"scenario_id string, {tier} string, churn_reduction_pct double, intervention_cost double")
    ret = whatif_retention(tx, customers, sc, rates, tier=tier)
    rec6 = _row(ret, "REC-006", F.floor(F.col("n_customers") * ASSUMED_CHURN), F.col("revenue_delta"),
                F.col("profit_delta"))
    # REC-007: mid-margin stores (p25 ≤ margin ≤ p75): +10 % revenue at the portfolio margin
    s = base.by_store(tx).withColumn("margin", div("profit", "revenue"))
    q = ranks.quantiles(s, "margin", [0.25, 0.75, 0.05], ["a", "b", "c"]).select(F.struct("*")).scalar()
    sq = s.withColumn("_q", q)
    mid = sq.where((F.col("margin") >= F.col("_q.a")) & (F.col("margin") <= F.col("_q.b")))
    r7 = mid.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("revenue") * af).alias("r"))
    up = F.coalesce(F.col("r"), F.lit(0.0)) * OPS_UPLIFT
    rec7 = _row(r7, "REC-007", F.col("n"), up, up * base_margin)
    # REC-008: close stores at or below the margin p5
    low = sq.where(F.col("margin") <= F.col("_q.c"))
    r8 = low.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("revenue") * af).alias("r"))
    rec8 = _row(r8, "REC-008", F.col("n"), -F.coalesce(F.col("r"), F.lit(0.0)) * CLOSURE_REVENUE_LOSS,
                F.col("n") * STORE_COST * CLOSURE_NET)
    parts = [rec1, rec2, rec3, rec6, rec7, rec8]
    if marketing is not None:  # REC-004 / REC-005: O2 on the segment, profit at the portfolio margin
        parts.append(marketing.select(F.col("scenario_id").alias("rec_id"), F.col("n_stores").cast("long").alias("reach"),
                                      "revenue_delta", (F.col("revenue_delta") * base_margin).alias("profit_delta")))
    out = financial_impact(reduce(DataFrame.unionByName, parts).join(params, "rec_id"))
    p, c = F.col("profit_delta"), F.col("implementation_cost")
    ratio = F.when((p > 0) | F.col("roi_fallback").isNull(), div(p, c)).otherwise(F.col("roi_fallback"))
    return out.withColumn("roi", ratio).drop("roi_fallback")


def n_distinct_customers(df: DataFrame):
    return df.select("customer_id").distinct().agg(F.count(F.lit(1))).scalar()


def rice_rank(recs: DataFrame) -> DataFrame:
    """RICE = reach/1000 · impact · confidence ÷ max(effort, 1), ranked
    descending (ties by rec_id).  One row per recommendation: a small table."""
    score = (F.col("reach") / 1000.0 * F.col("impact_score") * F.col("confidence")
             / F.greatest(F.col("effort_weeks"), F.lit(1)))
    r = recs.withColumn("rice_score", score)
    return r.withColumn("rice_rank", F.row_number().over(Window.orderBy(F.col("rice_score").desc(), "rec_id"))
                        .cast("long"))


def filter_actions(ranked: DataFrame, priorities=None, categories=None, timelines=None) -> DataFrame:
    """Conjunctive multi-select filter."""
    out = ranked
    for col, vals in (("priority", priorities), ("category", categories), ("timeline", timelines)):
        if vals:
            out = out.where(F.col(col).isin(list(vals)))
    return out


TIMELINES = {"n_immediate": "0-30 days", "n_short_term": "1-3 months", "n_medium_term": "3-6 months",
             "n_long_term": "6-12 months"}


def action_summary(ranked: DataFrame, top: int = 3, top_profit: int = 6) -> DataFrame:
    """Totals, count of critical actions, counts per timeline bucket and
    the top rec ids by RICE and by profit (recommendation-grained input)."""
    by_profit = F.row_number().over(Window.orderBy(F.col("profit_delta").desc(), "rec_id"))
    r = ranked.withColumn("_pr", by_profit)
    return r.agg(
        F.count(F.lit(1)).alias("n_actions"), F.sum("profit_delta").alias("total_profit_delta"),
        F.sum("revenue_delta").alias("total_revenue_delta"),
        F.sum("implementation_cost").alias("total_cost"),
        F.count_if(F.col("priority") == "Critical").alias("n_critical"),
        *[F.count_if(F.col("timeline") == v).alias(k) for k, v in TIMELINES.items()],
        F.array_sort(F.collect_list(F.when(F.col("rice_rank") <= top, F.struct("rice_rank", "rec_id"))))
        .alias("_top_rice"),
        F.array_sort(F.collect_list(F.when(F.col("_pr") <= top_profit, F.struct("_pr", "rec_id")))).alias("_top_profit"),
    ).select("*", F.col("_top_rice.rec_id").alias("top_by_rice"),
             F.col("_top_profit.rec_id").alias("top_by_profit")).drop("_top_rice", "_top_profit")
