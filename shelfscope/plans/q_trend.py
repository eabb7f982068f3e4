"""Registered trend queries."""

from __future__ import annotations

from ..operators import trend as T
from ..sources.retail import Retail
from .registry import MONEY, STAT, UNIT, register
from .sql import MARKETING, TX, with_, t_two_sided_sql

# ---- series definitions: Spark builder + SQL twin -------------------------

SERIES = {
    "revenue": (lambda r: T.monthly_sum(r.transactions, "gross_revenue"),
                "SELECT period, sum(gross_revenue) AS value FROM tx GROUP BY period"),
    "margin": (lambda r: T.monthly_ratio(r.transactions, "gross_profit", "gross_revenue"),
               "SELECT period, sum(gross_profit) / greatest(sum(gross_revenue), 1) * 100 AS value "
               "FROM tx GROUP BY period"),
    "active_customers": (lambda r: T.monthly_distinct(r.transactions, "customer_id"),
                         "SELECT period, CAST(count(DISTINCT customer_id) AS DOUBLE) AS value "
                         "FROM tx GROUP BY period"),
    "marketing_efficiency": (
        lambda r: T.efficiency_series(r.response, r.marketing),
        "SELECT a.period, a.r / greatest(b.s, 1) AS value FROM "
        "(SELECT period, sum(revenue) AS r FROM resp GROUP BY period) a JOIN "
        "(SELECT period, sum(spend) AS s FROM mkt GROUP BY period) b ON a.period = b.period"),
}


def _ctes(kind: str) -> str:
    return with_(MARKETING) if kind == "marketing_efficiency" else with_(TX)


def trend_sql(kind: str, metric: str) -> str:
    series_sql = SERIES[kind][1]
    return _ctes(kind) + f""", s AS ({series_sql}),
ix AS (SELECT period, value, CAST(row_number() OVER (ORDER BY period) - 1 AS DOUBLE) AS x FROM s),
a AS (SELECT count(value) AS n_periods, regr_slope(value, x) AS slope,
             regr_intercept(value, x) AS intercept, corr(value, x) AS r,
             arg_min(value, x) AS first_value, arg_max(value, x) AS last_value FROM ix),
si AS (SELECT month(period) AS month, avg(idx) AS seasonal_index FROM (
         SELECT period, value / greatest(avg(value) OVER (PARTITION BY year(period)), 1e-9) AS idx,
                count(*) OVER () AS n_all FROM s) WHERE n_all >= 12 GROUP BY 1)
SELECT '{metric}' AS metric, n_periods, slope, intercept, r * r AS r_squared,
       CASE WHEN n_periods > 2 THEN r * sqrt((n_periods - 2) / (1.0 - r * r)) END AS t_stat,
       n_periods - 2 AS df, first_value, last_value,
       CASE WHEN first_value <> 0 THEN (last_value - first_value) / abs(first_value) * 100
            ELSE 0.0 END AS pct_change,
       CAST((SELECT month FROM si ORDER BY seasonal_index DESC, month LIMIT 1) AS INTEGER) AS peak_month,
       CAST((SELECT month FROM si ORDER BY seasonal_index ASC, month LIMIT 1) AS INTEGER) AS trough_month
FROM a"""


def _trend_digits(level: int) -> dict[str, int]:
    return {"slope": level, "intercept": level, "r_squared": STAT, "t_stat": STAT,
            "first_value": level, "last_value": level, "pct_change": STAT}


TRENDS = {
    # query name: (series kind, metric label, rounding level of value columns)
    "revenue_trend": ("revenue", "monthly_gross_revenue", MONEY),
    "margin_trend": ("margin", "monthly_gross_margin_pct", STAT),
    "active_customers_trend": ("active_customers", "monthly_active_customers", UNIT),
    "marketing_efficiency_trend": ("marketing_efficiency", "daily_marketing_efficiency", STAT),
}


def _make_trend(name, kind, metric, level):
    register(name, sql=trend_sql(kind, metric), digits=_trend_digits(level), survey_id="I5-I8")(
        lambda r: T.trend_summary(SERIES[kind][0](r), metric))
    digits = dict(_trend_digits(level), p_value=STAT)
    p = f"CASE WHEN r_squared >= 1.0 THEN 0.0 WHEN t_stat IS NULL THEN NULL ELSE {t_two_sided_sql('t_stat', 'df')} END"
    test = f"""SELECT *, CASE WHEN p_value IS NULL OR p_value >= 0.05 THEN 'stable' WHEN slope > 0 THEN 'growing' ELSE 'declining' END
  AS direction FROM (SELECT *, {p} AS p_value FROM ({trend_sql(kind, metric)}) b)"""
    register(name + "_test", digits=digits, survey_id="I2-I3", sql=test)(
        lambda r: T.trend_summary(SERIES[kind][0](r), metric, with_test=True))


for _name, (_kind, _metric, _level) in TRENDS.items():
    _make_trend(_name, _kind, _metric, _level)


@register("monthly_revenue", survey_id="I1", digits={"value": MONEY},
          sql=with_(TX) + SERIES["revenue"][1])
def monthly_revenue(r: Retail):
    return T.monthly_sum(r.transactions, "gross_revenue")


@register("seasonal_index", survey_id="I4", digits={"seasonal_index": STAT},
          sql=with_(TX) + f""", s AS ({SERIES["revenue"][1]})
SELECT CAST(month(period) AS INTEGER) AS month, avg(idx) AS seasonal_index FROM (
  SELECT period, value / greatest(avg(value) OVER (PARTITION BY year(period)), 1e-9) AS idx,
         count(*) OVER () AS n_all FROM s) WHERE n_all >= 12 GROUP BY 1""")
def seasonal_index(r: Retail):
    si = T.seasonal_index(T.monthly_sum(r.transactions, "gross_revenue"))
    return si.withColumn("month", si["month"].cast("int"))


@register("mom_change", survey_id="I10",
          digits={"value": MONEY, "prev_value": MONEY, "pct_change": STAT},
          sql=with_(TX) + f""", s AS ({SERIES["revenue"][1]}),
m AS (SELECT period, value, lag(value) OVER (ORDER BY period) AS prev_value FROM s)
SELECT period, value, prev_value,
       CASE WHEN prev_value <> 0 THEN (value / prev_value - 1) * 100 END AS pct_change,
       CASE WHEN prev_value IS NULL OR prev_value = 0 THEN NULL
            WHEN (value / prev_value - 1) * 100 >= 0 THEN 'up' ELSE 'down' END AS direction
FROM m""")
def mom_change(r: Retail):
    return T.mom_change(T.monthly_sum(r.transactions, "gross_revenue"))


PNL_SQL = """SELECT period, sum(gross_revenue) AS revenue, sum(gross_profit) AS profit
FROM tx GROUP BY period"""


@register("monthly_pnl", survey_id="I13",
          digits={"revenue": MONEY, "profit": MONEY, "margin_pct": STAT},
          sql=with_(TX) + f"""SELECT period, revenue, profit,
  CASE WHEN revenue <> 0 THEN profit / revenue * 100 END AS margin_pct FROM ({PNL_SQL})""")
def monthly_pnl(r: Retail):
    return T.monthly_pnl(r.transactions)


def _drift_sql(n: int) -> str:
    return with_(TX) + f""", p AS ({PNL_SQL}),
t AS (SELECT *, dense_rank() OVER (ORDER BY period) AS f, dense_rank() OVER (ORDER BY period DESC) AS l FROM p),
a AS (SELECT sum(CASE WHEN f <= {n} THEN profit END) AS p0, sum(CASE WHEN f <= {n} THEN revenue END) AS r0,
             sum(CASE WHEN l <= {n} THEN profit END) AS p1, sum(CASE WHEN l <= {n} THEN revenue END) AS r1 FROM t)
SELECT {n} AS n_months, p0 / r0 * 100 AS margin_first, p1 / r1 * 100 AS margin_last,
       (p1 / r1 - p0 / r0) * 100 AS margin_change_pp, r0 AS revenue_first, r1 AS revenue_last,
       CASE WHEN r0 <> 0 THEN (r1 / r0 - 1) * 100 END AS revenue_change_pct FROM a"""


_DRIFT_DIGITS = {"margin_first": STAT, "margin_last": STAT, "margin_change_pp": STAT,
                 "revenue_first": MONEY, "revenue_last": MONEY, "revenue_change_pct": STAT}


@register("margin_drift_12m", survey_id="I11", digits=_DRIFT_DIGITS, sql=_drift_sql(12))
def margin_drift_12(r: Retail):
    return T.margin_drift(T.monthly_pnl(r.transactions), 12)


@register("margin_drift_3m", survey_id="I11", digits=_DRIFT_DIGITS, sql=_drift_sql(3))
def margin_drift_3(r: Retail):
    return T.margin_drift(T.monthly_pnl(r.transactions), 3)


@register("margin_line_fit", survey_id="I12",
          digits={"value": STAT, "fitted": STAT, "mean_value": STAT},
          sql=with_(TX) + f""", s AS ({SERIES["margin"][1]}),
ix AS (SELECT period, value, CAST(row_number() OVER (ORDER BY period) - 1 AS DOUBLE) AS x FROM s),
st AS (SELECT regr_slope(value, x) AS b, avg(x) AS mx, avg(value) AS my FROM ix)
SELECT period, value, my + b * (x - mx) AS fitted, my AS mean_value FROM ix, st""")
def margin_line_fit(r: Retail):
    return T.margin_line_fit(SERIES["margin"][0](r))


@register("margin_drift_mean_3m", survey_id="I11",
          digits={"margin_start_pct": STAT, "margin_end_pct": STAT, "margin_change_pct": STAT},
          sql=with_(TX) + f""", p AS ({PNL_SQL}),
t AS (SELECT *, profit / revenue * 100 AS m, row_number() OVER (ORDER BY period) AS f,
      row_number() OVER (ORDER BY period DESC) AS l FROM p),
a AS (SELECT avg(CASE WHEN f <= 3 THEN m END) AS s, avg(CASE WHEN l <= 3 THEN m END) AS e FROM t)
SELECT 3 AS n_months, s AS margin_start_pct, e AS margin_end_pct,
  CASE WHEN s <> 0 THEN (e - s) / s * 100 END AS margin_change_pct FROM a""")
def margin_drift_mean_3m(r: Retail):
    return T.margin_drift_mean(T.monthly_pnl(r.transactions), 3)
