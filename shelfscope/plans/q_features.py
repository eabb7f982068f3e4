"""Registered feature-table queries."""

from __future__ import annotations

from ..operators import features as L
from ..sources.retail import Retail
from .q_describe import TIER_ORDER
from .q_kpi import CLUSTERS
from .q_quality import PART_TYPES
from .q_segment import RFM_SCORES_SQL
from .registry import MONEY, STAT, UNIT, register
from .sql import CUSTOMERS, MARKETING, PRODUCTS, STORES, TX, with_


def _dummies_sql(col: str, levels, prefix: str) -> str:
    return ", ".join(f"CAST({col} = '{lv}' AS INT) AS {prefix}_{lv.lower().replace(' ', '_')}" for lv in levels)


def _code_sql(col: str, levels, unknown: int | None = None) -> str:
    other = f" ELSE {unknown}" if unknown is not None else ""
    return "CASE " + col + " " + " ".join(f"WHEN '{lv}' THEN {i}" for i, lv in enumerate(levels)) + other + " END"


def _customer_features(r: Retail):
    return L.customer_features(r.transactions, r.customers, r.stores, TIER_ORDER, CLUSTERS, r.customer_totals)


CF_SQL = with_(TX, CUSTOMERS, STORES, RFM_SCORES_SQL) + f""", ag AS (SELECT customer_id, max(date) AS last_purchase,
  min(date) AS first_purchase, count(*) AS n_txns, sum(gross_revenue) AS total_spend, sum(gross_profit) AS total_profit,
  count(DISTINCT product_id) AS n_products, avg(discount_pct) AS avg_discount,
  mode() WITHIN GROUP (ORDER BY cluster) AS preferred_cluster
  FROM tx LEFT JOIN stores USING (store_id) GROUP BY customer_id),
mx AS (SELECT max(date) AS ref FROM tx),
c AS (SELECT ag.customer_id, tier, customer_region, last_purchase, first_purchase, n_txns, total_spend,
  total_profit, n_products, avg_discount, preferred_cluster, recency_score, frequency_score, monetary_score,
  CAST(datediff('day', CAST(last_purchase AS DATE), CAST(ref AS DATE)) AS INT) AS recency_days,
  total_spend / greatest(n_txns, 1) AS avg_basket,
  greatest(0, (year(ref) - year(first_purchase)) * 12 + month(ref) - month(first_purchase)) AS months_as_customer,
  {_code_sql("tier", TIER_ORDER)} AS tier_code
  FROM ag LEFT JOIN customers USING (customer_id) LEFT JOIN rs USING (customer_id), mx)
SELECT customer_id, coalesce(tier, 'unknown') AS tier, coalesce(customer_region, 'unknown') AS customer_region,
  last_purchase, coalesce(n_txns, 0) AS n_txns, coalesce(total_spend, 0.0) AS total_spend,
  coalesce(total_profit, 0.0) AS total_profit, coalesce(n_products, 0) AS n_products,
  coalesce(avg_discount, 0.0) AS avg_discount, coalesce(preferred_cluster, 'unknown') AS preferred_cluster,
  coalesce(recency_score, 0) AS recency_score, coalesce(frequency_score, 0) AS frequency_score,
  coalesce(monetary_score, 0) AS monetary_score, coalesce(recency_days, 0) AS recency_days,
  coalesce(avg_basket, 0.0) AS avg_basket, CAST(coalesce(months_as_customer, 0) AS INT) AS months_as_customer,
  coalesce(tier_code, 0) AS tier_code,
  {", ".join(f"coalesce(CAST(tier = '{lv}' AS INT), 0) AS tier_{lv.lower().replace(' ', '_')}" for lv in TIER_ORDER)},
  {", ".join(f"coalesce(CAST(customer_region = '{lv}' AS INT), 0) AS region_{lv.lower().replace(' ', '_')}"
             for lv in CLUSTERS)}
FROM c"""

CF_DIGITS = {"total_spend": MONEY, "total_profit": MONEY, "avg_discount": STAT, "avg_basket": UNIT}


@register("customer_features", survey_id="L1", digits=CF_DIGITS, sql=CF_SQL)
def customer_features(r: Retail):
    return _customer_features(r)


@register("churn_label", survey_id="L2", digits=CF_DIGITS,
          sql=f"SELECT *, CAST(coalesce(recency_days >= 90, true) AS INT) AS is_churned FROM ({CF_SQL})")
def churn_label(r: Retail):
    return L.churn_label(_customer_features(r))


# point-in-time churn: features up to the cutoff, label from the next 90 days
CUTOFF = "2000-06-30 00:00:00"


@register("churn_label_point_in_time", survey_id="L2", digits={"total_spend": MONEY, "avg_discount": STAT},
          sql=with_(TX) + f""", h AS (SELECT customer_id,
  CAST(datediff('day', CAST(max(date) AS DATE), DATE '{CUTOFF[:10]}') AS INT) AS recency_days,
  count(*) AS n_txns, sum(gross_revenue) AS total_spend, avg(discount_pct) AS avg_discount FROM tx
  WHERE date <= TIMESTAMP '{CUTOFF}' GROUP BY customer_id),
f AS (SELECT DISTINCT customer_id FROM tx WHERE date > TIMESTAMP '{CUTOFF}'
      AND date <= TIMESTAMP '{CUTOFF}' + INTERVAL 90 DAY)
SELECT h.*, CASE WHEN f.customer_id IS NULL THEN 1 ELSE 0 END AS is_churned
FROM h LEFT JOIN f USING (customer_id)""")
def churn_label_point_in_time(r: Retail):
    return L.point_in_time_churn(r.transactions, CUTOFF)


@register("store_revenue_slope", survey_id="L4", digits={"revenue_slope": UNIT},
          sql=with_(TX) + """, m AS (SELECT store_id, period, sum(gross_revenue) AS revenue FROM tx GROUP BY ALL),
x AS (SELECT *, CAST(row_number() OVER (PARTITION BY store_id ORDER BY period) - 1 AS DOUBLE) AS x FROM m)
SELECT store_id, coalesce(regr_slope(revenue, x), 0.0) AS revenue_slope FROM x GROUP BY store_id""")
def store_revenue_slope(r: Retail):
    return L.store_revenue_slope(r.transactions)


SF_DIGITS = {"size": UNIT, "avg_monthly_revenue": UNIT, "avg_monthly_profit": UNIT, "revenue_volatility": UNIT,
             "revenue_slope": UNIT, "avg_monthly_cost": UNIT, "margin_ratio": STAT, "cost_ratio": STAT}

SF_SQL = with_(TX, STORES) + f""", mo AS (SELECT store_id, period, sum(gross_revenue) AS rev, sum(gross_profit) AS prof
  FROM tx GROUP BY ALL),
m AS (SELECT store_id, avg(rev) AS avg_monthly_revenue, avg(prof) AS avg_monthly_profit,
  stddev_samp(rev) AS revenue_volatility, count(*) AS active_months, sum(prof) AS p, sum(rev) AS r FROM mo GROUP BY store_id),
x AS (SELECT *, CAST(row_number() OVER (PARTITION BY store_id ORDER BY period) - 1 AS DOUBLE) AS x FROM mo),
sl AS (SELECT store_id, coalesce(regr_slope(rev, x), 0.0) AS revenue_slope FROM x GROUP BY store_id),
co AS (SELECT store_id, avg(c) AS avg_monthly_cost FROM (SELECT store_id, period, sum(operating_cost) AS c FROM tx
  GROUP BY ALL) GROUP BY store_id)
SELECT store_id, coalesce(size, 0.0) AS size, cluster, avg_monthly_revenue, avg_monthly_profit,
  coalesce(revenue_volatility, 0.0) AS revenue_volatility, active_months, coalesce(revenue_slope, 0.0) AS revenue_slope,
  coalesce(avg_monthly_cost, 0.0) AS avg_monthly_cost, p / greatest(r, 1) AS margin_ratio,
  coalesce(avg_monthly_cost / greatest(avg_monthly_revenue, 1), 0.0) AS cost_ratio,
  {_code_sql("cluster", CLUSTERS, -1)} AS cluster_code,
  {", ".join(f"coalesce(CAST(cluster = '{lv}' AS INT), 0) AS cluster_{lv.lower().replace(' ', '_')}" for lv in CLUSTERS)}
FROM m LEFT JOIN stores USING (store_id) LEFT JOIN sl USING (store_id) LEFT JOIN co USING (store_id)"""


def _store_features(r: Retail):
    return L.store_features(r.transactions, r.stores, None, CLUSTERS, months=r.store_months)


@register("store_features", survey_id="L3,L6", digits=SF_DIGITS, sql=SF_SQL)
def store_features(r: Retail):
    return _store_features(r)


@register("top_performer_label", survey_id="L7", digits=SF_DIGITS,
          sql=f"""WITH sf AS ({SF_SQL}) SELECT *, CAST(coalesce(avg_monthly_profit >=
  (SELECT quantile_cont(avg_monthly_profit, 0.8) FROM sf), false) AS INT) AS is_top_performer FROM sf""")
def top_performer_label(r: Retail):
    return L.top_performer_label(_store_features(r))


@register("marketing_features", survey_id="L5,L9",
          digits={"total_spend": MONEY, "avg_period_revenue": UNIT, "digital_share": STAT,
                  "marketing_efficiency": STAT},
          sql=with_(MARKETING) + """, s AS (SELECT market, sum(spend) AS total_spend,
  sum(CASE WHEN channel = 'click' THEN spend ELSE 0.0 END) AS d FROM mkt GROUP BY market),
rv AS (SELECT market, avg(revenue) AS avg_period_revenue FROM resp GROUP BY market)
SELECT market, total_spend, avg_period_revenue, d / greatest(total_spend, 1) AS digital_share,
  avg_period_revenue / greatest(total_spend, 1) AS marketing_efficiency FROM s LEFT JOIN rv USING (market)""")
def marketing_features(r: Retail):
    return L.market_marketing_features(r.marketing, r.response)


@register("product_features", survey_id="L8",
          digits={"units": UNIT, "revenue": MONEY, "profit": MONEY, "avg_price": UNIT, "avg_discount": STAT,
                  "price_std": UNIT, "margin_pct": STAT, "category_share_pct": STAT, "unit_cost": UNIT},
          sql=with_(TX, PRODUCTS) + f""", p AS (SELECT product_id, sum(quantity) AS units, sum(gross_revenue) AS revenue,
  sum(gross_profit) AS profit, count(*) AS n_txns, avg(unit_price) AS avg_price, avg(discount_pct) AS avg_discount,
  stddev_samp(unit_price) AS price_std FROM tx GROUP BY product_id),
b AS (SELECT p.*, category, subcategory, brand_type, unit_cost FROM p LEFT JOIN products USING (product_id)),
bc AS (SELECT brand_type, CAST(dense_rank() OVER (ORDER BY brand_type) - 1 AS INT) AS code
       FROM (SELECT DISTINCT brand_type FROM b WHERE brand_type IS NOT NULL))
SELECT b.product_id, category, subcategory, b.brand_type, units, revenue, profit, n_txns, avg_price, avg_discount,
  coalesce(price_std, 0.0) AS price_std, coalesce(unit_cost, 0.0) AS unit_cost,
  profit / greatest(revenue, 1) * 100 AS margin_pct,
  revenue / greatest(sum(revenue) OVER (PARTITION BY category), 1) * 100 AS category_share_pct,
  coalesce(CAST(b.brand_type = 'private_label' AS INT), 0) AS is_private_label,
  coalesce(code, -1) AS brand_type_code,
  {", ".join(f"coalesce(CAST(category = '{lv}' AS INT), 0) AS cat_{lv.lower().replace(' ', '_')}" for lv in PART_TYPES)}
FROM b LEFT JOIN bc USING (brand_type)""")
def product_features(r: Retail):
    return L.product_features(r.transactions, r.products, list(PART_TYPES))
