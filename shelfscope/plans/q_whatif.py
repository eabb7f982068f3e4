"""Registered what-if, recommendation and ranking queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import actions as O
from ..operators import elasticity as E
from ..operators import whatif as W
from ..sources.retail import Retail
from ..sources.sinks import written
from ..operators import base, mix
from .q_inference import URBAN_REGION
from .q_kpi import FOCUS_TIER
from .q_mix import ELAST_SQL, segmented
from .registry import MONEY, STAT, UNIT, register
from .sql import CUSTOMERS, MARKETING, STORES, TX, with_

# Scenario parameters, one row per scenario; X1-X6 are the six presets, mapped to values of these tables
PRICE_SCENARIOS = [("P1", "PROMO", 0.05, None), ("P2", "STANDARD", -0.05, None), ("P3", "LARGE", 0.10, -1.2), ("P4", "Economy", 0.05, None),
                   ("X1", "LARGE", 0.05, None), ("X5", "SMALL", 0.05, None), ("X6", "MEDIUM", 0.05, None)]
RETENTION_SCENARIOS = [("R1", FOCUS_TIER, 0.30, 50000.0), ("R2", "MACHINERY", 0.10, 20000.0), ("R3", "All", 0.05, 0.0), ("R4", "furniture", 0.20, 10000.0),
                       ("X3", FOCUS_TIER, 0.30, 500000.0)]
STORE_SCENARIOS = [("S1", 5, 25000.0, 0.08), ("S2", 10, 15000.0, 0.05), ("X4", 50, 150000.0, 0.15)]
MARKETING_SCENARIOS = [("M1", "all", {"click": 0.5, "view": 0.2, "signup": 0.2, "error": 0.1}),
                       ("M2", "all", {"click": 0.7, "view": 0.7, "signup": 0.3, "error": 0.3}),
                       ("X2", URBAN_REGION, {"click": 0.55, "view": 0.15, "signup": 0.20, "error": 0.05, "instore_promo": 0.05})]
# the two marketing recommendations are O2 scenarios of the urban segment
REC_MARKETING = [("REC-004", URBAN_REGION, {"click": 0.55, "view": 0.15, "signup": 0.20, "error": 0.05, "instore_promo": 0.05}),
                 ("REC-005", URBAN_REGION, {"click": 0.45, "view": 0.10, "signup": 0.25, "error": 0.10, "instore_promo": 0.10})]
# Months until the effect, by scenario type (fixed values)
TIMELINE_MONTHS = {"price_change": 6, "marketing_reallocation": 6, "retention": 12, "store_investment": 18}
# Annual churn by tier (fixed values, on the tiers in their order; others 0.18)
CHURN_RATES = {"AUTOMOBILE": 0.25, "BUILDING": 0.20, "FURNITURE": 0.10, "All": 0.18}
# Revenue per unit of spend by store format and channel (fixed values); regions stand for formats, event types for channels
CHANNEL_ROI = {
    "urban": {"digital": 3.0, "tv": 0.8, "email": 1.5, "print": 0.6, "instore_promo": 1.2},
    "rural": {"digital": 0.8, "tv": 2.5, "email": 1.2, "print": 1.8, "instore_promo": 1.5},
    "suburban": {"digital": 1.5, "tv": 1.5, "email": 1.3, "print": 1.1, "instore_promo": 1.3},
}
REGION_FORMAT = {URBAN_REGION: "urban", "ASIA": "rural"}
CHANNEL_OF = {"digital": "click", "tv": "view", "email": "signup", "print": "error"}
ROI_ROWS = [(region, CHANNEL_OF.get(c, c), v) for region in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
            for c, v in CHANNEL_ROI[REGION_FORMAT.get(region, "suburban")].items()]
# Recommendation catalogue (fixed values that must equal the reference's):
# rec_id, category, impact_score, confidence, effort_weeks, implementation_cost (ROI divisor),
# roi_fallback (ROI when profit ≤ 0), timeline_months (O6 ramp: upper end of the timeline bucket),
# priority, timeline
REC_PARAMS = [
    ("REC-001", "Pricing", 8.0, 0.82, 2, 200000.0, 1.5, 3, "High", "1-3 months"),
    ("REC-002", "Pricing", 8.5, 0.72, 16, 800000.0, 1.0, 6, "High", "3-6 months"),
    ("REC-003", "Pricing", 9.0, 0.85, 4, 150000.0, 5.0, 1, "Critical", "0-30 days"),
    ("REC-004", "Marketing", 7.5, 0.78, 6, 200000.0, None, 6, "High", "3-6 months"),
    ("REC-005", "Marketing", 6.0, 0.72, 4, 50000.0, None, 3, "Medium", "1-3 months"),
    ("REC-006", "Retention", 9.5, 0.80, 3, 500000.0, 2.0, 1, "Critical", "0-30 days"),
    ("REC-007", "Operations", 7.0, 0.68, 12, 1000000.0, 1.5, 6, "Medium", "3-6 months"),
    ("REC-008", "Store Portfolio", 7.0, 0.70, 26, 2000000.0, 1.0, 12, "Medium", "6-12 months"),
]


def _price_scenarios(spark):
    return spark.createDataFrame(PRICE_SCENARIOS, "scenario_id string, category string, price_change_pct double, "
                                                  "elasticity_override double")


def _whatif_price(r: Retail):
    spark = r.transactions.sparkSession
    return W.whatif_price(r.rollups, _price_scenarios(spark), E.category_elasticity(r.transactions))


PRICE_DIGITS = {c: MONEY for c in ("baseline_revenue", "baseline_profit", "projected_revenue", "projected_profit",
                                   "revenue_delta", "profit_delta")}
PRICE_DIGITS.update(elasticity_used=STAT, confidence=STAT)


def _sql_values(rows) -> str:
    def lit(v):
        if v is None:
            return "CAST(NULL AS DOUBLE)"
        return f"'{v}'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)"
    return ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)


@register("whatif_price", survey_id="O1", digits=PRICE_DIGITS,
          sql=with_(TX, ELAST_SQL) + f""", raw(scenario_id, category, price_change_pct, elasticity_override) AS
  (VALUES {_sql_values(PRICE_SCENARIOS)}),
sc AS (SELECT raw.* REPLACE (coalesce(names.category, raw.category) AS category) FROM raw
  LEFT JOIN (SELECT DISTINCT category FROM tx) names ON lower(names.category) = lower(raw.category)),
af AS (SELECT 12.0 / count(DISTINCT period) AS f FROM tx),
cat AS (SELECT category, sum(gross_revenue) * (SELECT f FROM af) AS cat_rev, sum(gross_profit) * (SELECT f FROM af)
  AS cat_profit FROM tx GROUP BY category),
tot AS (SELECT sum(gross_revenue) * (SELECT f FROM af) AS rev, sum(gross_profit) * (SELECT f FROM af) AS profit FROM tx),
x AS (SELECT sc.*, cat_rev, cat_profit, coalesce(elasticity_override, e.elasticity, -1.0) AS eu,
  CASE WHEN cat_rev > 0 THEN cat_profit / cat_rev ELSE 0.0 END AS m, tot.rev, tot.profit
  FROM sc JOIN cat USING (category) LEFT JOIN (SELECT category, elasticity FROM el WHERE n >= 30 AND sdp >= 1e-6) e
  USING (category), tot),
y AS (SELECT *, cat_rev * (1 + price_change_pct) * (1 + eu * price_change_pct) AS pcr FROM x)
SELECT scenario_id, 'price_change' AS scenario_type, category, price_change_pct, eu AS elasticity_used,
  rev AS baseline_revenue, profit AS baseline_profit, rev - cat_rev + pcr AS projected_revenue,
  profit - cat_profit + pcr * m AS projected_profit, rev - cat_rev + pcr - rev AS revenue_delta,
  profit - cat_profit + pcr * m - profit AS profit_delta,
  CASE WHEN abs(eu) < 1.0 THEN 0.80 ELSE 0.70 END AS confidence FROM y""")
def whatif_price(r: Retail):
    return _whatif_price(r)


def _whatif_retention(r: Retail, rates=CHURN_RATES):
    spark = r.transactions.sparkSession
    sc = spark.createDataFrame(RETENTION_SCENARIOS, "scenario_id string, tier string, churn_reduction_pct double, "
                                                    "intervention_cost double")
    return W.whatif_retention(r.rollups, r.customers, sc, rates)


PROJ_DIGITS = {c: MONEY for c in ("baseline_revenue", "baseline_profit", "projected_revenue", "projected_profit",
                                  "revenue_delta", "profit_delta", "implementation_cost")}
PROJ_DIGITS["confidence"] = STAT

BASE_SQL = ("b AS (SELECT sum(gross_revenue) * (SELECT 12.0 / count(DISTINCT period) FROM tx) AS brev, "
            "sum(gross_profit) * (SELECT 12.0 / count(DISTINCT period) FROM tx) AS bprof FROM tx)")


def _proj_sql(rev_gain: str, profit_gain: str, confidence: float) -> str:
    return (f"brev AS baseline_revenue, bprof AS baseline_profit, brev + ({rev_gain}) AS projected_revenue, "
            f"greatest(bprof + ({profit_gain}), bprof * 0.5) AS projected_profit, "
            f"brev + ({rev_gain}) - brev AS revenue_delta, "
            f"greatest(bprof + ({profit_gain}), bprof * 0.5) - bprof AS profit_delta")


RATE_CASE = "CASE tier " + " ".join(f"WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in CHURN_RATES.items()) + " ELSE CAST(0.18 AS DOUBLE) END"
OBSERVED = "coalesce(CASE WHEN n_customers <> 0 THEN chn / n_customers END, 0.18)"


def _retention_sql(scenarios, rate: str) -> str:
    return with_(TX, CUSTOMERS, BASE_SQL) + f""", raw(scenario_id, tier, churn_reduction_pct, intervention_cost) AS
  (VALUES {_sql_values(scenarios)}),
pc AS (SELECT customer_id, max(date) AS l, sum(gross_profit) AS p FROM tx GROUP BY customer_id),
c AS (SELECT tier, coalesce(l < (SELECT max(date) FROM tx) - INTERVAL 180 DAY, false) AS ch, coalesce(p, 0.0) AS p
  FROM customers LEFT JOIN pc USING (customer_id)),
t AS (SELECT tier, count(*) AS n_customers, count_if(ch) AS chn, sum(p) AS profit FROM c GROUP BY tier
  UNION ALL SELECT 'All', count(*), count_if(ch), sum(p) FROM c),
sc AS (SELECT raw.* REPLACE (coalesce(t.tier, raw.tier) AS tier) FROM raw LEFT JOIN t ON lower(t.tier) = lower(raw.tier)),
x AS (SELECT sc.*, coalesce(n_customers, 0) AS n, {rate} AS rate,
  coalesce(CASE WHEN n_customers <> 0 THEN profit * (SELECT 12.0 / count(DISTINCT period) FROM tx) / n_customers END,
    0.0) AS val FROM sc LEFT JOIN t USING (tier)),
y AS (SELECT *, floor(n * rate) AS churners, floor(n * rate) * churn_reduction_pct * val AS impact FROM x, b)
SELECT scenario_id, 'retention' AS scenario_type, tier, CAST(n AS BIGINT) AS n_customers, rate AS churn_rate,
  val AS annual_value_per_customer, CAST(churners AS BIGINT) AS n_churners, churners * val AS value_at_risk,
  {_proj_sql("impact", "impact - intervention_cost", 0.75)}, intervention_cost AS implementation_cost,
  0.75 AS confidence FROM y"""


RETENTION_SQL = _retention_sql(RETENTION_SCENARIOS, RATE_CASE)
RET_DIGITS = dict(PROJ_DIGITS, churn_rate=STAT, annual_value_per_customer=UNIT, value_at_risk=MONEY)


@register("whatif_retention", survey_id="O3,O9", digits=RET_DIGITS, sql=RETENTION_SQL)
def whatif_retention(r: Retail):
    return _whatif_retention(r)


@register("whatif_retention_observed", survey_id="O3", digits=RET_DIGITS, sql=_retention_sql(RETENTION_SCENARIOS, OBSERVED))
def whatif_retention_observed(r: Retail):
    return _whatif_retention(r, None)


def _whatif_marketing(r: Retail, scenarios=None) -> DataFrame:
    spark = r.transactions.sparkSession
    rows = [(i, seg, ch, float(v)) for i, seg, shares in scenarios or MARKETING_SCENARIOS for ch, v in shares.items()]
    sc = spark.createDataFrame(rows, "scenario_id string, segment string, channel string, new_share double")
    roi = spark.createDataFrame(ROI_ROWS, "segment string, channel string, roi double")
    by_store = base.by_store(r.rollups).join(r.stores.select("store_id", "cluster"), "store_id")
    baseline = by_store.groupBy(F.col("cluster").alias("segment")).agg(
        F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"), F.count(F.lit(1)).alias("n_stores"))
    spend = segmented(r, r.marketing).where("segment <> 'all'")
    out = mix.whatif_marketing(sc, spend, baseline, roi, W.annual_factor(r.rollups))
    return out.join(baseline.select("segment", "n_stores"), "segment", "left")


def _marketing_sql(scenarios) -> str:
    rows = ", ".join(f"('{i}', '{seg}', '{ch}', CAST({v} AS DOUBLE))" for i, seg, shares in scenarios for ch, v in shares.items())
    roi = ", ".join(f"('{a}', '{b}', CAST({v} AS DOUBLE))" for a, b, v in ROI_ROWS)
    return with_(TX, STORES, MARKETING) + f""", sc(scenario_id, segment, channel, new_share) AS (VALUES {rows}),
roi(segment, channel, roi) AS (VALUES {roi}),
geo AS (SELECT n_name AS market, r_name AS segment FROM nation JOIN region ON n_regionkey = r_regionkey),
af AS (SELECT 12.0 / count(DISTINCT period) AS f FROM tx),
base AS (SELECT cluster AS segment, sum(gross_revenue) AS revenue, sum(gross_profit) AS profit, count(DISTINCT store_id) AS n_stores
  FROM tx JOIN stores USING (store_id) GROUP BY cluster),
seg AS (SELECT segment, revenue, profit FROM base UNION ALL SELECT 'all', sum(revenue), sum(profit) FROM base),
per AS (SELECT segment, channel, sum(spend) AS spend FROM mkt JOIN geo USING (market) GROUP BY ALL
  UNION ALL SELECT 'all', channel, sum(spend) FROM mkt JOIN geo USING (market) GROUP BY channel),
rates AS (SELECT * FROM roi UNION ALL SELECT 'all', channel, sum(roi * n_stores) / sum(n_stores) FROM roi JOIN base USING (segment) GROUP BY channel),
bud AS (SELECT segment, sum(spend) AS budget FROM per GROUP BY segment),
cur AS (SELECT segment, sum(spend / budget * coalesce(roi, 1.0)) AS current_roi, max(budget) AS budget
  FROM per JOIN bud USING (segment) LEFT JOIN rates USING (segment, channel) GROUP BY segment),
tot AS (SELECT scenario_id, sum(new_share) AS share_sum FROM sc GROUP BY scenario_id),
nw AS (SELECT scenario_id, segment, max(share_sum) AS share_sum, sum(CASE WHEN abs(share_sum - 1) > 0.02 THEN new_share / share_sum
  ELSE new_share END * coalesce(roi, 1.0)) AS new_roi FROM sc JOIN tot USING (scenario_id) LEFT JOIN rates USING (segment, channel) GROUP BY ALL),
z AS (SELECT nw.*, current_roi, budget * f * (new_roi - current_roi) AS lift, revenue * f AS rev, profit * f AS prof,
  (SELECT sum(revenue) FROM base) * f AS trev, (SELECT sum(profit) FROM base) * f AS tprof FROM nw JOIN cur USING (segment) JOIN seg USING (segment), af),
zz AS (SELECT *, (rev + lift) * CASE WHEN rev > 0 THEN prof / rev ELSE 0.0 END - prof AS gain FROM z)
SELECT scenario_id, 'marketing_reallocation' AS scenario_type, zz.segment, share_sum, current_roi, new_roi, trev AS baseline_revenue,
  tprof AS baseline_profit, trev + lift AS projected_revenue, tprof + gain AS projected_profit, lift AS revenue_delta, gain AS profit_delta,
  0.72 AS confidence, n_stores FROM zz LEFT JOIN base ON base.segment = zz.segment"""


@register("whatif_marketing", survey_id="O2", sql=_marketing_sql(MARKETING_SCENARIOS),
          digits={**{k: v for k, v in PROJ_DIGITS.items() if k != "implementation_cost"}, "current_roi": STAT, "new_roi": STAT, "share_sum": STAT})
def whatif_marketing(r: Retail):
    return _whatif_marketing(r)


def _whatif_store(r: Retail):
    spark = r.transactions.sparkSession
    sc = spark.createDataFrame(STORE_SCENARIOS, "scenario_id string, n_stores int, investment_per_store double, "
                                                "revenue_uplift_pct double")
    return W.whatif_store_investment(r.rollups, sc)


@register("whatif_store_investment", survey_id="O4", digits=PROJ_DIGITS)
def whatif_store_investment(r: Retail):
    return _whatif_store(r)


@register("whatif_batch", survey_id="O5,O6",
          digits={"revenue_delta": MONEY, "profit_delta": MONEY, "implementation_cost": MONEY, "roi": STAT,
                  "npv_3yr": MONEY, "annualized_impact": MONEY})
def whatif_batch(r: Retail):
    cols = ["scenario_id", "scenario_type", "revenue_delta", "profit_delta", "implementation_cost"]
    price = _whatif_price(r).withColumn("implementation_cost", F.lit(0.0)).select(*cols)
    ret = _whatif_retention(r).select(*cols)
    store = _whatif_store(r).select(*cols)
    marketing = _whatif_marketing(r).withColumn("implementation_cost", F.lit(0.0)).select(*cols)
    months = F.create_map(*[x for k, v in TIMELINE_MONTHS.items() for x in (F.lit(k), F.lit(v))])
    allr = price.unionByName(ret).unionByName(store).unionByName(marketing)
    return W.financial_impact(allr.withColumn("timeline_months", months[F.col("scenario_type")]))


def _params(spark) -> DataFrame:
    return spark.createDataFrame(REC_PARAMS, "rec_id string, category string, impact_score double, "
                                             "confidence double, effort_weeks int, implementation_cost double, "
                                             "roi_fallback double, timeline_months int, priority string, "
                                             "timeline string")


def _recs(r: Retail):
    spark = r.transactions.sparkSession
    # two recommendations use the elasticities: one row per category, written once
    elasticities = written(E.category_elasticity(r.transactions), "elasticities")
    return O.recommendations(r.rollups, r.customers, elasticities,
                             _params(spark), FOCUS_TIER, CHURN_RATES, _whatif_marketing(r, REC_MARKETING))


REC_DIGITS = {"revenue_delta": MONEY, "profit_delta": MONEY, "roi": STAT, "npv_3yr": MONEY, "annualized_impact": MONEY}


@register("recommendations", survey_id="O7-O11", digits=REC_DIGITS)
def recommendations(r: Retail):
    return _recs(r)


@register("rice_rank", survey_id="O12", digits=dict(REC_DIGITS, rice_score=STAT))
def rice_rank(r: Retail):
    return O.rice_rank(_recs(r))


@register("filter_actions", survey_id="O13", digits=dict(REC_DIGITS, rice_score=STAT))
def filter_actions(r: Retail):
    return O.filter_actions(O.rice_rank(_recs(r)), priorities=["Critical", "High"],
                            timelines=["0-30 days", "1-3 months"])


@register("action_summary", survey_id="P11",
          digits={"total_profit_delta": MONEY, "total_revenue_delta": MONEY, "total_cost": MONEY})
def action_summary(r: Retail):
    return O.action_summary(O.rice_rank(_recs(r)))


# ---- DuckDB twins of the store-investment what-if and the recommendations --

AF = "(SELECT 12.0 / count(DISTINCT period) FROM tx)"
STORE_MARGIN = ("sm AS (SELECT store_id, sum(gross_revenue) AS revenue, sum(gross_profit) AS profit, "
                "CASE WHEN sum(gross_revenue) <> 0 THEN sum(gross_profit) / sum(gross_revenue) END AS margin "
                "FROM tx GROUP BY store_id)")

STORE_INV_SQL = with_(TX, STORE_MARGIN, BASE_SQL) + f""", sc(scenario_id, n_stores, investment_per_store,
  revenue_uplift_pct) AS (VALUES {", ".join(f"('{a}', {b}, CAST({c} AS DOUBLE), CAST({d} AS DOUBLE))"
                                           for a, b, c, d in STORE_SCENARIOS)}),
low AS (SELECT *, row_number() OVER (ORDER BY margin, store_id) AS worst_rank FROM sm
        WHERE margin <= (SELECT quantile_cont(margin, 0.2) FROM sm)),
agg AS (SELECT scenario_id, count(*) AS stores_selected, sum(revenue * {AF}) AS rv
        FROM low JOIN sc ON worst_rank <= n_stores GROUP BY scenario_id),
x AS (SELECT sc.*, coalesce(stores_selected, 0) AS stores_selected, coalesce(rv, 0.0) * revenue_uplift_pct AS ur,
        CASE WHEN brev > 0 THEN bprof / brev ELSE 0.0 END AS m, n_stores * investment_per_store AS cost, brev, bprof
        FROM sc LEFT JOIN agg USING (scenario_id), b)
SELECT scenario_id, 'store_investment' AS scenario_type, stores_selected,
  {_proj_sql("ur", "ur * m - cost / 3", 0.65)}, cost AS implementation_cost, 0.65 AS confidence FROM x"""


def _impact_sql(src: str) -> str:
    """O6 over ``src`` (profit_delta, implementation_cost, timeline_months)."""
    return f"""SELECT *, CASE WHEN implementation_cost > 0 THEN profit_delta / implementation_cost
    WHEN profit_delta > 0 THEN CAST('inf' AS DOUBLE) ELSE 0.0 END AS roi,
  CAST(CASE WHEN implementation_cost <= 0 THEN 0 WHEN profit_delta / 12.0 > 0
    THEN least(floor(implementation_cost / (profit_delta / 12.0)), 999) ELSE 999 END AS INTEGER) AS payback_months,
  profit_delta / pow(CAST(1.1 AS DOUBLE), 1 + timeline_months / 12.0)
    + profit_delta / pow(CAST(1.1 AS DOUBLE), 2 + timeline_months / 12.0)
    + profit_delta / pow(CAST(1.1 AS DOUBLE), 3 + timeline_months / 12.0) - implementation_cost AS npv_3yr,
  (profit_delta * 3 - implementation_cost) / 3 AS annualized_impact FROM {src}"""


def _params_values() -> str:
    return ", ".join(f"('{a}', '{b}', CAST({c} AS DOUBLE), CAST({d} AS DOUBLE), {e}, CAST({f} AS DOUBLE), "
                     f"CAST({'NULL' if g is None else g} AS DOUBLE), {h}, '{i}', '{j}')" for a, b, c, d, e, f, g, h, i, j in REC_PARAMS)


def _rec_retention_sql() -> str:
    """REC-006 = O3 for the focus tier (reduction 0.30, cost 500k)."""
    return _retention_sql([("REC-006", FOCUS_TIER, 0.3, 500000.0)], RATE_CASE)


RECS_CTE = f"""{STORE_MARGIN},
bl AS (SELECT sum(gross_revenue) * {AF} AS brev, sum(gross_profit) * {AF} AS bprof FROM tx),
inel AS (SELECT category, elasticity FROM el WHERE n >= 30 AND sdp >= 1e-6 AND abs(elasticity) < 1),
cat AS (SELECT category, sum(gross_revenue) AS revenue, sum(gross_profit) AS profit FROM tx GROUP BY category),
r1 AS (SELECT 'REC-001' AS rec_id,
  CAST(coalesce((SELECT count(DISTINCT customer_id) FROM tx WHERE category IN (SELECT category FROM inel)), 0) AS BIGINT)
    AS reach,
  coalesce(sum(revenue * {AF} * ((1 + 0.05) * (1 + elasticity * 0.05) - 1)), 0.0) AS revenue_delta,
  coalesce(sum(profit * {AF} * ((1 + 0.05) * (1 + elasticity * 0.05) - 1)), 0.0) AS profit_delta
  FROM cat JOIN inel USING (category)),
m AS (SELECT avg(CASE WHEN brand_type = 'private_label' THEN
               CASE WHEN gross_revenue <> 0 THEN gross_profit / gross_revenue END END) AS pl,
             avg(CASE WHEN brand_type = 'national_brand' THEN
               CASE WHEN gross_revenue <> 0 THEN gross_profit / gross_revenue END END) AS nb FROM tx),
r2 AS (SELECT 'REC-002', CAST(floor(brev * 0.05 / 150.0) AS BIGINT), brev * 0.05 * 0.5, brev * 0.05 * (pl - nb)
  FROM m, bl),
r3 AS (SELECT 'REC-003', (SELECT count(DISTINCT customer_id) FROM tx), 0.0, brev * 0.03 FROM bl),
ret AS (SELECT * FROM ({_rec_retention_sql()})),
r6 AS (SELECT 'REC-006', CAST(floor(n_customers * 0.2) AS BIGINT), revenue_delta, profit_delta FROM ret),
q AS (SELECT quantile_cont(margin, 0.25) AS a, quantile_cont(margin, 0.75) AS b, quantile_cont(margin, 0.05) AS c5
  FROM sm),
r7 AS (SELECT 'REC-007', count(*), coalesce(sum(revenue * {AF}), 0.0) * 0.1,
  coalesce(sum(revenue * {AF}), 0.0) * 0.1 * (SELECT CASE WHEN brev <> 0 THEN bprof / brev END FROM bl)
  FROM sm, q WHERE margin >= a AND margin <= b),
r8 AS (SELECT 'REC-008', count(*), -coalesce(sum(revenue * {AF}), 0.0) * 0.5,
  CAST(count(*) AS DOUBLE) * CAST(800000.0 AS DOUBLE) * CAST(0.3 AS DOUBLE)
  FROM sm, q WHERE margin <= c5),
r45 AS (SELECT scenario_id, CAST(n_stores AS BIGINT), revenue_delta,
  revenue_delta * (SELECT CASE WHEN brev <> 0 THEN bprof / brev END FROM bl) FROM ({_marketing_sql(REC_MARKETING)})),
recs AS (SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3 UNION ALL SELECT * FROM r45 UNION ALL SELECT * FROM r6
  UNION ALL SELECT * FROM r7 UNION ALL SELECT * FROM r8),
params(rec_id, category, impact_score, confidence, effort_weeks, implementation_cost, roi_fallback,
  timeline_months, priority, timeline) AS (VALUES {_params_values()}),
rj0 AS ({_impact_sql("(SELECT * FROM recs JOIN params USING (rec_id))")}),
rj AS (SELECT * EXCLUDE (roi, roi_fallback), CASE WHEN profit_delta > 0 OR roi_fallback IS NULL THEN
  CASE WHEN implementation_cost <> 0 THEN profit_delta / implementation_cost END ELSE roi_fallback END AS roi FROM rj0),
rr AS (SELECT *, reach / 1000.0 * impact_score * confidence / greatest(effort_weeks, 1) AS rice_score FROM rj),
rk AS (SELECT *, row_number() OVER (ORDER BY rice_score DESC, rec_id) AS rice_rank FROM rr)"""

REC_SQL_HEAD = with_(TX, CUSTOMERS, ELAST_SQL, RECS_CTE)

# attach oracles to the already-registered builders
from .registry import REGISTRY  # noqa: E402

REGISTRY["whatif_store_investment"].sql = STORE_INV_SQL
REGISTRY["recommendations"].sql = REC_SQL_HEAD + "SELECT * EXCLUDE (rice_score) FROM rr"
REGISTRY["rice_rank"].sql = REC_SQL_HEAD + "SELECT * FROM rk"
REGISTRY["filter_actions"].sql = (REC_SQL_HEAD + "SELECT * FROM rk WHERE priority IN ('Critical', 'High') "
                                  "AND timeline IN ('0-30 days', '1-3 months')")
REGISTRY["action_summary"].sql = REC_SQL_HEAD + """, pr AS (SELECT *, row_number() OVER (ORDER BY profit_delta DESC, rec_id)
  AS profit_rank FROM rk)
SELECT count(*) AS n_actions, sum(profit_delta) AS total_profit_delta, sum(revenue_delta) AS total_revenue_delta,
  sum(implementation_cost) AS total_cost, count_if(priority = 'Critical') AS n_critical,
  count_if(timeline = '0-30 days') AS n_immediate, count_if(timeline = '1-3 months') AS n_short_term,
  count_if(timeline = '3-6 months') AS n_medium_term, count_if(timeline = '6-12 months') AS n_long_term,
  list(rec_id ORDER BY rice_rank) FILTER (WHERE rice_rank <= 3) AS top_by_rice,
  list(rec_id ORDER BY profit_rank) FILTER (WHERE profit_rank <= 6) AS top_by_profit FROM pr"""

_PRICE_SQL = REGISTRY["whatif_price"].sql
_RET_SQL = REGISTRY["whatif_retention"].sql
REGISTRY["whatif_batch"].sql = _impact_sql(f"""(SELECT *, CASE scenario_type WHEN 'retention' THEN 12
    WHEN 'store_investment' THEN 18 ELSE 6 END AS timeline_months FROM (
  SELECT scenario_id, scenario_type, revenue_delta, profit_delta, 0.0 AS implementation_cost FROM ({_PRICE_SQL})
  UNION ALL SELECT scenario_id, scenario_type, revenue_delta, profit_delta, implementation_cost FROM ({_RET_SQL})
  UNION ALL SELECT scenario_id, scenario_type, revenue_delta, profit_delta, implementation_cost FROM ({STORE_INV_SQL})
  UNION ALL SELECT scenario_id, scenario_type, revenue_delta, profit_delta, 0.0 FROM ({_marketing_sql(MARKETING_SCENARIOS)})))""")
