"""Registered KPI queries (P1-P10) and table-level source queries (A1-A3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import kpi as P
from ..sources import tables as A
from ..sources.retail import Retail
from .registry import MONEY, STAT, UNIT, register
from .q_mix import ELAST_SQL
from .sql import CUSTOMERS, STORES, TX, with_

CLUSTERS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
FOCUS_TIER = "BUILDING"


@register("scan_table", survey_id="A1",
          sql="SELECT l_returnflag, l_linestatus, count(*) AS n_rows, sum(l_quantity) AS sum_qty "
              "FROM lineitem GROUP BY ALL")
def scan_table(r: Retail):
    return r.tables["lineitem"].groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("sum_qty"))


@register("table_manifest", survey_id="A2-A3",
          sql="\nUNION ALL\n".join(
              f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST({len(s.fields)} AS BIGINT) AS n_columns, "
              f"'{','.join(f.name for f in s.fields)}' AS column_names FROM {t}" for t, s in A.SCHEMAS.items()))
def table_manifest(r: Retail):
    return A.table_manifest(r.tables.every())


@register("kpi_summary", survey_id="P1", digits={"total_revenue": MONEY, "total_profit": MONEY, "margin_pct": STAT},
          sql=with_(TX) + """SELECT sum(gross_revenue) AS total_revenue, sum(gross_profit) AS total_profit,
  count(*) AS n_transactions, count(DISTINCT customer_id) AS n_customers, count(DISTINCT store_id) AS n_stores,
  count(DISTINCT product_id) AS n_products, min(date) AS first_date, max(date) AS last_date,
  count(DISTINCT period) AS n_months, list_sort(list_distinct(list(category))) AS categories,
  sum(gross_profit) / sum(gross_revenue) * 100 AS margin_pct FROM tx""")
def kpi_summary(r: Retail):
    return P.kpi_summary(r.transactions)


MONTH_NUM = ("(year(period) - year((SELECT min(period) FROM tx))) * 12 + month(period) "
             "- month((SELECT min(period) FROM tx)) + 1")


@register("financial_summary", survey_id="P2",
          digits={"total_revenue": MONEY, "total_profit": MONEY, "annualised_revenue": MONEY,
                  "annualised_profit": MONEY, "avg_margin_pct": STAT, "margin_start_pct": STAT,
                  "margin_end_pct": STAT, "margin_change_pp": STAT},
          sql=with_(TX) + f""", t AS (SELECT *, {MONTH_NUM} AS month_num FROM tx),
a AS (SELECT sum(gross_revenue) AS total_revenue, sum(gross_profit) AS total_profit, count(*) AS n_transactions,
  count(DISTINCT period) AS n_months, count(DISTINCT customer_id) AS n_customers, count(DISTINCT store_id) AS n_stores,
  sum(CASE WHEN month_num <= 3 THEN gross_profit END) AS ep, sum(CASE WHEN month_num <= 3 THEN gross_revenue END) AS er,
  sum(CASE WHEN month_num > (SELECT max(month_num) FROM t) - 3 THEN gross_profit END) AS lp,
  sum(CASE WHEN month_num > (SELECT max(month_num) FROM t) - 3 THEN gross_revenue END) AS lr FROM t),
b AS (SELECT *, CASE WHEN total_revenue > 0 THEN total_profit / total_revenue ELSE 0.0 END AS am FROM a),
c AS (SELECT *, coalesce(ep / er, am) AS ms, coalesce(lp / lr, am) AS me FROM b)
SELECT total_revenue, total_profit, total_revenue / (n_months / 12) AS annualised_revenue,
  total_profit / (n_months / 12) AS annualised_profit, am * 100 AS avg_margin_pct, ms * 100 AS margin_start_pct,
  me * 100 AS margin_end_pct, (me - ms) * 100 AS margin_change_pp, n_stores, n_customers, n_transactions, n_months
FROM c""")
def financial_summary(r: Retail):
    return P.financial_summary(r.transactions)


@register("churn_by_tier", survey_id="P3", digits={"churn_rate": STAT},
          sql=with_(TX, CUSTOMERS) + """, last AS (SELECT customer_id, max(date) AS l FROM tx GROUP BY customer_id),
c AS (SELECT tier, coalesce(l < (SELECT max(date) FROM tx) - INTERVAL 180 DAY, false) AS ch
      FROM customers LEFT JOIN last USING (customer_id)),
u AS (SELECT tier, count(*) AS n_customers, count_if(ch) AS n_churned FROM c GROUP BY tier),
worst AS (SELECT tier FROM u ORDER BY n_churned / n_customers DESC, tier LIMIT 1),
a AS (SELECT *, tier IN (SELECT tier FROM worst) AS is_most_churned FROM u
      UNION ALL SELECT 'ALL', count(*), count_if(ch), false FROM c)
SELECT *, CASE WHEN n_customers > 0 THEN n_churned / n_customers ELSE 0.0 END AS churn_rate FROM a""")
def churn_by_tier(r: Retail):
    return P.churn_by_tier(r.transactions, r.customers)


@register("churn_focus_tier", survey_id="P3",
          digits={"churn_pre": STAT, "churn_post": STAT, "churn_acceleration_pp": STAT,
                  "annual_revenue_per_customer": UNIT, "revenue_at_risk": MONEY},
          sql=with_(TX, CUSTOMERS) + f""", t AS (SELECT *, {MONTH_NUM} AS month_num FROM tx),
ids AS (SELECT customer_id FROM customers WHERE tier = '{FOCUS_TIER}'),
pc AS (SELECT customer_id, max(CASE WHEN month_num <= 24 THEN 1 END) AS pre,
  max(CASE WHEN month_num > 24 THEN 1 END) AS post, max(date) AS l, sum(gross_revenue) AS rev
  FROM t WHERE customer_id IN (SELECT customer_id FROM ids) GROUP BY customer_id),
a AS (SELECT count(*) AS n_customers, count(pre) AS npre, count(post) AS npost,
  count_if(coalesce(l < (SELECT max(date) FROM tx) - INTERVAL 180 DAY, false)) AS n_churners, sum(rev) AS rev
  FROM ids LEFT JOIN pc USING (customer_id)),
b AS (SELECT *, CASE WHEN n_customers > 0 THEN coalesce(rev, 0.0) / ((SELECT count(DISTINCT period) FROM tx) / 12)
  / n_customers ELSE 0.0 END AS pcr, 1 - npre / n_customers AS pre_c, 1 - npost / n_customers AS post_c FROM a)
SELECT '{FOCUS_TIER}' AS tier, n_customers, n_churners, pre_c AS churn_pre, post_c AS churn_post,
  (post_c - pre_c) * 100 AS churn_acceleration_pp, pcr AS annual_revenue_per_customer,
  pcr * n_churners AS revenue_at_risk FROM b""")
def churn_focus_tier(r: Retail):
    return P.tier_activity_shift(r.transactions, r.customers, FOCUS_TIER)


STORE_AGG = ("SELECT store_id, sum(gross_revenue) AS revenue, sum(gross_profit) AS profit, "
             "sum(gross_profit) / sum(gross_revenue) * 100 AS margin_pct FROM tx GROUP BY store_id")


@register("store_performance", survey_id="P4",
          digits={"top_stores_revenue_share": STAT, "bottom_quartile_avg_margin_pct": STAT},
          sql=with_(TX) + """, s AS (SELECT store_id, sum(gross_revenue) AS revenue,
  CASE WHEN sum(gross_revenue) <> 0 THEN sum(gross_profit) / sum(gross_revenue) END AS margin FROM tx GROUP BY store_id),
o AS (SELECT revenue, row_number() OVER (ORDER BY revenue DESC) AS rn FROM s),
q AS (SELECT quantile_cont(margin, 0.25) AS p25 FROM s)
SELECT (SELECT sum(revenue) FROM o WHERE rn <= 10) / (SELECT sum(revenue) FROM s) AS top_stores_revenue_share,
       (SELECT avg(margin) FROM s WHERE margin <= p25) * 100 AS bottom_quartile_avg_margin_pct,
       (SELECT count_if(margin <= 0) FROM s) AS stores_below_breakeven,
       (SELECT count(*) FROM supplier) AS total_stores FROM q""")
def store_performance(r: Retail):
    return P.store_performance(r.transactions, r.stores)


@register("pricing_mix", survey_id="P6",
          digits={"pl_margin_pct": STAT, "nb_margin_pct": STAT, "pl_margin_premium_mult": STAT,
                  "pl_revenue_share_pct": STAT, "inelastic_revenue_opportunity": MONEY},
          sql=with_(TX, ELAST_SQL) + """, a AS (SELECT
  sum(CASE WHEN brand_type = 'private_label' THEN gross_profit END) AS pp,
  sum(CASE WHEN brand_type = 'private_label' THEN gross_revenue END) AS pr,
  sum(CASE WHEN brand_type = 'national_brand' THEN gross_profit END) AS np,
  sum(CASE WHEN brand_type = 'national_brand' THEN gross_revenue END) AS nr FROM tx),
b AS (SELECT *, CASE WHEN pr > 0 THEN pp / pr ELSE 0.0 END AS plm, CASE WHEN nr > 0 THEN np / nr ELSE 0.0 END AS nbm
  FROM a),
inel AS (SELECT category, elasticity FROM el WHERE n >= 30 AND sdp >= 1e-6 AND abs(elasticity) < 1),
opp AS (SELECT sum(r / ((SELECT count(DISTINCT period) FROM tx) / 12) * ((1 + 0.05) * (1 + elasticity * 0.05) - 1))
  AS o FROM (SELECT category, sum(gross_revenue) AS r FROM tx GROUP BY category) JOIN inel USING (category))
SELECT plm * 100 AS pl_margin_pct, nbm * 100 AS nb_margin_pct, CASE WHEN nbm > 0 THEN plm / nbm END
  AS pl_margin_premium_mult, pr / (pr + nr) * 100 AS pl_revenue_share_pct,
  coalesce((SELECT o FROM opp), 0.0) AS inelastic_revenue_opportunity FROM b""")
def pricing_mix(r: Retail):
    from ..operators import elasticity as E
    return P.private_label_mix(r.transactions, E.category_elasticity(r.transactions))


@register("discount_leaders", survey_id="P6", digits={"avg_discount_pct": STAT},
          sql=with_(TX) + "SELECT category, avg(discount_pct) * 100 AS avg_discount_pct FROM tx GROUP BY category "
          "ORDER BY avg_discount_pct DESC, category LIMIT 3")
def discount_leaders(r: Retail):
    return P.discount_leaders(r.transactions)


@register("category_performance", survey_id="P7",
          digits={"revenue": MONEY, "profit": MONEY, "margin_pct": STAT, "revenue_share_pct": STAT},
          sql=with_(TX) + """SELECT category, sum(gross_revenue) AS revenue, sum(gross_profit) AS profit,
  sum(gross_profit) / sum(gross_revenue) * 100 AS margin_pct,
  sum(gross_revenue) / sum(sum(gross_revenue)) OVER () * 100 AS revenue_share_pct FROM tx WHERE category IS NOT NULL
  GROUP BY category""")
def category_performance(r: Retail):
    return P.category_performance(r.transactions)


@register("category_format_margin", survey_id="P8", digits={c: STAT for c in CLUSTERS},
          sql=with_(TX, STORES) + "SELECT category, " + ", ".join(
              f"sum(CASE WHEN cluster = '{c}' THEN gross_profit END) / "
              f"sum(CASE WHEN cluster = '{c}' THEN gross_revenue END) * 100 AS \"{c}\"" for c in CLUSTERS)
          + " FROM tx LEFT JOIN stores USING (store_id) GROUP BY category")
def category_format_margin(r: Retail):
    return P.margin_matrix(r.transactions, r.stores, values=CLUSTERS)


@register("avg_basket", survey_id="P9",
          digits={"total_revenue": MONEY, "total_profit": MONEY, "annual_revenue": MONEY, "annual_profit": MONEY,
                  "avg_margin_pct": STAT, "avg_basket_value": UNIT},
          sql=with_(TX) + """, m AS (SELECT count(DISTINCT period) / 12 AS years FROM tx)
SELECT sum(gross_revenue) AS total_revenue, sum(gross_profit) AS total_profit,
  sum(gross_revenue) / years AS annual_revenue, sum(gross_profit) / years AS annual_profit,
  sum(gross_profit) / sum(gross_revenue) * 100 AS avg_margin_pct, count(*) AS n_transactions,
  avg(gross_revenue) AS avg_basket_value FROM tx, m GROUP BY years""")
def avg_basket(r: Retail):
    return P.avg_basket(r.transactions)


@register("brand_catalog_margin", survey_id="P10", digits={"mean_margin_pct": STAT, "ratio_to_national_brand": STAT},
          sql=with_(TX) + """, pm AS (SELECT product_id, brand_type, sum(gross_profit) / sum(gross_revenue) * 100 AS m
  FROM tx GROUP BY product_id, brand_type), g AS (SELECT brand_type, avg(m) AS mean_margin_pct, count(*) AS n_products
  FROM pm GROUP BY brand_type)
SELECT *, mean_margin_pct / (SELECT max(mean_margin_pct) FROM g WHERE brand_type = 'national_brand')
  AS ratio_to_national_brand FROM g""")
def brand_catalog_margin(r: Retail):
    return P.brand_margin(r.transactions)
