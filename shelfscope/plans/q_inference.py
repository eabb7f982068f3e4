"""Registered hypothesis-test and experiment queries."""

from __future__ import annotations

from functools import reduce
from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import size_label
from ..operators import base
from ..operators import inference as J
from ..sources.retail import Retail
from .registry import REGISTRY, STAT, UNIT, register
from . import q_describe  # noqa: F401  (its queries are tested here)
from .sql import CUSTOMERS, MARKETING, STORES, TX, with_, f_sf_sql, norm_sf_sql, t_greater_sql, t_quantile_sql, t_two_sided_sql

TREATMENT, CONTROL = "BUILDING", "AUTOMOBILE"
URBAN_REGION = "AMERICA"
EFFECT_CASE = ("CASE WHEN {x} IS NULL THEN NULL WHEN abs({x}) < 0.2 THEN 'negligible' WHEN abs({x}) < 0.5 "
               "THEN 'small' WHEN abs({x}) < 0.8 THEN 'medium' ELSE 'large' END")


def _store_cluster_revenue(r: Retail):
    return base.by_store(r.transactions).join(r.stores.select("store_id", "cluster"), "store_id", "left")


ANOVA_DIGITS = {"f_stat": STAT, "eta_squared": STAT}


@register("anova_oneway", survey_id="J1,J8", digits=ANOVA_DIGITS,
          sql=with_(TX, STORES) + """, s AS (SELECT store_id, cluster, sum(gross_revenue) AS rev FROM tx
  LEFT JOIN stores USING (store_id) GROUP BY store_id, cluster),
g AS (SELECT cluster, count(rev) AS n, avg(rev) AS m, var_pop(rev) AS vp FROM s WHERE cluster IS NOT NULL
      GROUP BY cluster HAVING count(rev) >= 2),
g2 AS (SELECT *, sum(n * m) OVER () / sum(n) OVER () AS grand FROM g),
a AS (SELECT count(*) AS k, CAST(sum(n) AS BIGINT) AS n_total, sum(n * vp) AS ssw0,
      sum(n * (m - grand) * (m - grand)) AS ssb0 FROM g2),
b AS (SELECT k, n_total, CASE WHEN k >= 2 AND n_total > k THEN ssb0 END AS ssb,
      CASE WHEN k >= 2 AND n_total > k THEN ssw0 END AS ssw,
      CASE WHEN k >= 2 AND n_total > k THEN k - 1 END AS df_between,
      CASE WHEN k >= 2 AND n_total > k THEN n_total - k END AS df_within FROM a)
SELECT k, n_total, df_between, df_within, CASE WHEN ssw > 0 THEN (ssb / df_between) / (ssw / df_within) END AS f_stat,
  ssb / (ssb + ssw) AS eta_squared,
  CASE WHEN ssb / (ssb + ssw) IS NULL THEN NULL WHEN ssb / (ssb + ssw) < 0.01 THEN 'negligible'
       WHEN ssb / (ssb + ssw) < 0.06 THEN 'small' WHEN ssb / (ssb + ssw) < 0.14 THEN 'medium' ELSE 'large' END
  AS effect_label FROM b""")
def anova_oneway(r: Retail):
    return J.anova_oneway(_store_cluster_revenue(r), "cluster", "revenue")


WELCH_DIGITS = {c: STAT for c in ("mean1", "mean2", "var1", "var2", "mean_diff", "se", "t_stat", "df", "cohens_d")}


def welch_sql(src: str, group: str, value: str, g1: str, g2: str) -> str:
    st = (f"SELECT count_if({group} = '{g1}') AS n1, count_if({group} = '{g2}') AS n2, "
          f"avg(CASE WHEN {group} = '{g1}' THEN {value} END) AS mean1, "
          f"avg(CASE WHEN {group} = '{g2}' THEN {value} END) AS mean2, "
          f"var_samp(CASE WHEN {group} = '{g1}' THEN {value} END) AS var1, "
          f"var_samp(CASE WHEN {group} = '{g2}' THEN {value} END) AS var2 FROM {src} WHERE {value} IS NOT NULL")
    d = ("CASE WHEN n1 >= 2 AND n2 >= 2 AND sqrt(((n1 - 1) * var1 + (n2 - 1) * var2) / (n1 + n2 - 2)) > 0 "
         "THEN (mean1 - mean2) / sqrt(((n1 - 1) * var1 + (n2 - 1) * var2) / (n1 + n2 - 2)) "
         "WHEN n1 >= 2 AND n2 >= 2 THEN 0.0 END")
    return (f"SELECT n1, n2, mean1, mean2, var1, var2, mean1 - mean2 AS mean_diff, se, "
            f"CASE WHEN se IS NOT NULL THEN (mean1 - mean2) / se END AS t_stat, "
            f"CASE WHEN se IS NOT NULL THEN (var1 / n1 + var2 / n2) * (var1 / n1 + var2 / n2) / "
            f"((var1 / n1) * (var1 / n1) / (n1 - 1) + (var2 / n2) * (var2 / n2) / (n2 - 1)) END AS df, "
            f"{d} AS cohens_d, {EFFECT_CASE.format(x=d)} AS effect_label FROM "
            f"(SELECT *, CASE WHEN n1 >= 2 AND n2 >= 2 AND var1 / n1 + var2 / n2 > 0 "
            f"THEN sqrt(var1 / n1 + var2 / n2) END AS se FROM ({st}))")


def _month_num_sql(src: str) -> str:
    return (f"(year(period) - year((SELECT min(period) FROM {src}))) * 12 + month(period) "
            f"- month((SELECT min(period) FROM {src})) + 1")


FREQ_SQL = f"""seg AS (SELECT tx.* FROM tx JOIN customers USING (customer_id) WHERE tier = '{TREATMENT}'),
t AS (SELECT *, {_month_num_sql("seg")} AS month_num FROM seg),
f AS (SELECT customer_id, phase, avg(c) AS freq FROM (SELECT customer_id,
  CASE WHEN month_num <= 24 THEN 'early' ELSE 'late' END AS phase, month_num, count(*) AS c FROM t
  GROUP BY ALL) GROUP BY customer_id, phase)"""


@register("freq_decline_welch", survey_id="J2,J7", digits=dict(WELCH_DIGITS, pct_change=STAT),
          sql=with_(TX, CUSTOMERS, FREQ_SQL) + "SELECT *, (mean2 - mean1) / greatest(mean1, 0.001) * 100 AS "
          "pct_change FROM (" + welch_sql("f", "phase", "freq", "early", "late") + ")")
def freq_decline_welch(r: Retail):
    return J.frequency_decline(r.transactions, r.customers, TREATMENT)


PM_BRAND_SQL = ("pm AS (SELECT product_id, brand_type, sum(gross_profit) / greatest(sum(gross_revenue), 1) * 100 "
                "AS margin_pct FROM tx GROUP BY product_id, brand_type)")


@register("group_mean_welch", survey_id="J3", digits=dict(WELCH_DIGITS, margin_gap_pp=STAT),
          sql=with_(TX, PM_BRAND_SQL) + "SELECT *, mean1 - mean2 AS margin_gap_pp FROM (" +
          welch_sql("pm", "brand_type", "margin_pct", "private_label", "national_brand") + ")")
def group_mean_welch(r: Retail):
    return J.group_mean_welch(r.transactions)


def _roi(r: Retail):
    spend = (r.marketing.where(F.col("channel") == "click").groupBy("market", "period")
             .agg(F.round(F.sum("spend"), 2).alias("spend")))
    resp = r.response.withColumn("revenue", F.round("revenue", 2))
    nat = (r.tables["nation"].join(r.tables["region"], F.col("n_regionkey") == F.col("r_regionkey"))
           .select(F.col("n_name").alias("market"), (F.col("r_name") == URBAN_REGION).alias("is_urban")))
    j = resp.join(spend, ["market", "period"]).join(nat, "market")
    return j.withColumn("roi", F.col("revenue") / F.greatest(F.col("spend"), F.lit(1.0)))


ROI_SQL = f"""roi AS (SELECT resp.market, resp.period, round(resp.revenue, 2) / greatest(s.spend, 1) AS roi,
  r_name = '{URBAN_REGION}' AS is_urban FROM resp JOIN (SELECT market, period, round(sum(spend), 2) AS spend FROM mkt
  WHERE channel = 'click' GROUP BY ALL) s ON resp.market = s.market AND resp.period = s.period
  JOIN nation ON resp.market = n_name JOIN region ON n_regionkey = r_regionkey)"""

MWU_DIGITS = {"u_stat": STAT, "z": STAT, "rank_biserial": STAT, "median1": STAT, "median2": STAT,
              "median_premium_pct": STAT}


@register("mann_whitney_u", survey_id="J4,E8", digits=MWU_DIGITS,
          sql=with_(MARKETING, ROI_SQL) + """, rk AS (SELECT roi, is_urban,
  rank() OVER (ORDER BY roi) + (count(*) OVER (PARTITION BY roi) - 1) / 2.0 AS ar FROM roi),
ties AS (SELECT sum(c * c * c - c) AS tt FROM (SELECT count(*) AS c FROM roi GROUP BY roi)),
a AS (SELECT count_if(is_urban) AS n1, count_if(NOT is_urban) AS n2, sum(CASE WHEN is_urban THEN ar END) AS r1 FROM rk),
b AS (SELECT n1, n2, r1 - n1 * (n1 + 1) / 2 AS u,
  sqrt(n1 * n2 / 12.0 * ((n1 + n2 + 1) - tt / ((n1 + n2) * (n1 + n2 - 1)))) AS sigma FROM a, ties),
m AS (SELECT quantile_cont(CASE WHEN is_urban THEN roi END, 0.5) AS median1,
             quantile_cont(CASE WHEN NOT is_urban THEN roi END, 0.5) AS median2 FROM roi)
SELECT n1, n2, u AS u_stat, CASE WHEN sigma > 0 THEN (u - n1 * n2 / 2.0 - 0.5) / sigma END AS z,
  1.0 - 2 * u / (n1 * n2) AS rank_biserial, median1, median2,
  CASE WHEN 1.0 - 2 * u / (n1 * n2) IS NULL THEN NULL WHEN abs(1.0 - 2 * u / (n1 * n2)) < 0.2 THEN 'negligible'
       WHEN abs(1.0 - 2 * u / (n1 * n2)) < 0.5 THEN 'small' WHEN abs(1.0 - 2 * u / (n1 * n2)) < 0.8 THEN 'medium'
       ELSE 'large' END AS effect_label,
  (median1 - median2) / greatest(median2, 0.001) * 100 AS median_premium_pct FROM b, m""")
def mann_whitney_u(r: Retail):
    return J.mann_whitney(_roi(r), "roi", "is_urban")


AB_SQL = f"""t0 AS (SELECT *, {_month_num_sql("tx")} AS month_num FROM tx),
t1 AS (SELECT * FROM t0 WHERE NOT (SELECT count(*) > 0 FROM t0 WHERE month_num > 24) OR month_num > 24),
t AS (SELECT t1.*, tier FROM t1 JOIN customers USING (customer_id) WHERE tier IN ('{TREATMENT}', '{CONTROL}')),
f AS (SELECT customer_id, tier, avg(c) AS freq FROM (SELECT customer_id, tier, month_num, count(*) AS c FROM t
      GROUP BY ALL) GROUP BY customer_id, tier)"""


@register("ab_welch", survey_id="J10",
          digits=dict(WELCH_DIGITS, absolute_lift=STAT, relative_lift_pct=STAT, revenue_at_risk=UNIT,
                      power_effect=STAT),
          sql=with_(TX, CUSTOMERS, AB_SQL) + f"""SELECT *, mean1 - mean2 AS absolute_lift,
  (mean1 - mean2) / greatest(abs(mean2), 1e-9) * 100 AS relative_lift_pct,
  abs(mean1 - mean2) * n1 * (SELECT avg(gross_revenue) FROM t WHERE tier = '{TREATMENT}') AS revenue_at_risk,
  abs(mean1 - mean2) / greatest(sqrt((var1 + var2) / 2), 1e-9) AS power_effect
FROM ({welch_sql("f", "tier", "freq", TREATMENT, CONTROL)})""")
def ab_welch(r: Retail):
    return J.ab_welch(r.transactions, r.customers, TREATMENT, CONTROL)


@register("ab_welch_inference", survey_id="J10-J12",
          digits=dict(WELCH_DIGITS, p_value=STAT, ci_low=STAT, ci_high=STAT, power=STAT))
def ab_welch_inference(r: Retail):
    return J.with_ab_inference(J.ab_welch(r.transactions, r.customers, TREATMENT, CONTROL))


# J13 design grid (fixed parameters) against the observed baseline frequency
MDES = [0.05, 0.1, 0.25, 0.5]
ALPHA, POWER = 0.05, 0.8
_ZA = f"CAST({NormalDist().inv_cdf(1 - ALPHA / 2)!r} AS DOUBLE)"
_ZB = f"CAST({NormalDist().inv_cdf(POWER)!r} AS DOUBLE)"


@register("required_sample_size", survey_id="J13", digits={"baseline_rate": STAT, "z_alpha": STAT, "z_beta": STAT},
          sql=with_(TX) + f""", b AS (SELECT avg(c) AS baseline_rate FROM (SELECT customer_id, period, count(*) AS c
  FROM tx GROUP BY ALL)), d(mde) AS (VALUES {", ".join(f"({m})" for m in MDES)})
SELECT baseline_rate, CAST(mde AS DOUBLE) AS mde, CAST({ALPHA} AS DOUBLE) AS alpha,
  CAST({POWER} AS DOUBLE) AS power, {_ZA} AS z_alpha, {_ZB} AS z_beta,
  CAST(ceil(pow(({_ZA} + {_ZB})
     / (mde / greatest(sqrt(greatest(baseline_rate, 1e-9)), 1e-9)), 2)) AS BIGINT) AS n_per_group FROM b, d""")
def required_sample_size(r: Retail):
    spark = r.transactions.sparkSession
    baseline = (r.transactions.groupBy("customer_id", "period").agg(F.count(F.lit(1)).alias("c"))
                .agg(F.avg("c").alias("baseline_rate")))
    grid = spark.createDataFrame([(m, ALPHA, POWER) for m in MDES], "mde double, alpha double, power double")
    return J.required_sample_size(baseline.crossJoin(F.broadcast(grid)))  # 1 row × design grid


@register("pre_post_frequency", survey_id="J14",
          digits={"per_month_pre": STAT, "per_month_post": STAT, "pct_change": STAT},
          sql=with_(TX, CUSTOMERS) + f""", t AS (SELECT *, {_month_num_sql("tx")} AS month_num FROM tx
  WHERE customer_id IN (SELECT customer_id FROM customers WHERE tier = '{TREATMENT}')),
a AS (SELECT count_if(month_num <= 24) AS txns_pre, count_if(month_num > 24) AS txns_post,
  count(DISTINCT CASE WHEN month_num <= 24 THEN month_num END) AS months_pre,
  count(DISTINCT CASE WHEN month_num > 24 THEN month_num END) AS months_post FROM t)
SELECT *, txns_pre / months_pre AS per_month_pre, txns_post / months_post AS per_month_post,
  CASE WHEN txns_pre / months_pre > 0 THEN ((txns_post / months_post) / (txns_pre / months_pre) - 1) * 100 END
  AS pct_change FROM a""")
def pre_post_frequency(r: Retail):
    return J.pre_post_frequency(r.transactions, r.customers, TREATMENT)


@register("run_hypotheses", survey_id="J6,J9", digits={"statistic": STAT, "p_value": STAT, "effect_size": STAT})
def run_hypotheses(r: Retail):
    """Five tests as rows (NULL statistics when a test lacks data)."""
    from ..operators import describe as D
    from .q_describe import _row_margin
    r = r.kept("store_id", "customer_id", "product_id", "brand_type", "period", "discount_pct", "gross_revenue", "gross_profit")
    h1 = J.with_anova_test(J.anova_oneway(_store_cluster_revenue(r), "cluster", "revenue")).select(
        F.lit("H1").alias("hypothesis_id"), F.lit("one-way ANOVA").alias("test_name"),
        F.col("f_stat").alias("statistic"), "p_value", F.col("eta_squared").alias("effect_size"),
        "effect_label", "rejected")
    h2 = J.with_welch_test(J.frequency_decline(r.transactions, r.customers, TREATMENT), "greater").select(
        F.lit("H2").alias("hypothesis_id"), F.lit("Welch t (greater)").alias("test_name"),
        F.col("t_stat").alias("statistic"), "p_value", F.abs("cohens_d").alias("effect_size"),
        "effect_label", "rejected")
    h3 = J.with_welch_test(J.group_mean_welch(r.transactions)).select(
        F.lit("H3").alias("hypothesis_id"), F.lit("Welch t").alias("test_name"),
        F.col("t_stat").alias("statistic"), "p_value", F.abs("cohens_d").alias("effect_size"),
        "effect_label", "rejected")
    h4 = J.with_mwu_test(J.mann_whitney(_roi(r), "roi", "is_urban")).select(
        F.lit("H4").alias("hypothesis_id"), F.lit("Mann-Whitney U (greater)").alias("test_name"),
        F.col("u_stat").alias("statistic"), "p_value", F.abs("rank_biserial").alias("effect_size"),
        "effect_label", "rejected")
    h5 = D.with_corr_test(D.pearson(_row_margin(r), "discount_pct", "margin_pct")).select(
        F.lit("H5").alias("hypothesis_id"), F.lit("Pearson r").alias("test_name"),
        F.col("r").alias("statistic"), "p_value", F.col("abs_r").alias("effect_size"),
        size_label("abs_r").alias("effect_label"), F.coalesce(F.col("significant"), F.lit(False)).alias("rejected"))
    return reduce(DataFrame.unionByName, [h1, h2, h3, h4, h5])


def _tested(base_name: str, p: str) -> str:
    """SQL of a query with its p-value and verdict."""
    return (f"SELECT *, coalesce(p_value < 0.05, false) AS rejected FROM (SELECT *, {p} AS p_value "
            f"FROM ({REGISTRY[base_name].sql}) b)")


_T2 = f"CASE WHEN t_stat IS NULL THEN NULL ELSE {t_two_sided_sql('t_stat', 'df')} END"
_TG = f"CASE WHEN t_stat IS NULL THEN NULL ELSE {t_greater_sql('t_stat', 'df')} END"
_FP = f"CASE WHEN f_stat IS NULL THEN NULL ELSE {f_sf_sql('f_stat', 'df_between', 'df_within')} END"
_ZP = f"CASE WHEN z IS NULL THEN NULL ELSE {norm_sf_sql('z')} END"

for _name, _fn, _p, _digits in [
        ("anova_oneway", lambda r: J.with_anova_test(anova_oneway(r)), _FP, ANOVA_DIGITS),
        ("freq_decline_welch", lambda r: J.with_welch_test(freq_decline_welch(r), "greater"), _TG, dict(WELCH_DIGITS, pct_change=STAT)),
        ("group_mean_welch", lambda r: J.with_welch_test(group_mean_welch(r)), _T2, dict(WELCH_DIGITS, margin_gap_pp=STAT)),
        ("mann_whitney_u", lambda r: J.with_mwu_test(mann_whitney_u(r)), _ZP, MWU_DIGITS)]:
    register(_name + "_test", survey_id="J1-J4 p-values", digits=dict(_digits, p_value=STAT), sql=_tested(_name, _p))(_fn)

_Z95 = NormalDist().inv_cdf(0.975)
REGISTRY["ab_welch_inference"].digits.update(REGISTRY["ab_welch"].digits)
REGISTRY["ab_welch_inference"].sql = f"""SELECT *, mean_diff - {t_quantile_sql(_Z95, 'df')} * se AS ci_low,
  mean_diff + {t_quantile_sql(_Z95, 'df')} * se AS ci_high,
  {norm_sf_sql(f"(CAST({_Z95!r} AS DOUBLE) - power_effect * sqrt((2.0 / (1.0 / n1 + 1.0 / n2)) / 2))")} AS power
FROM ({_tested("ab_welch", _T2)}) c"""


def _hypotheses_sql() -> str:
    size = "CASE WHEN abs_r < 0.2 THEN 'negligible' WHEN abs_r < 0.5 THEN 'small' WHEN abs_r < 0.8 THEN 'medium' ELSE 'large' END"
    rows = [("H1", "one-way ANOVA", "anova_oneway_test", "f_stat", "eta_squared", "effect_label", "rejected"),
            ("H2", "Welch t (greater)", "freq_decline_welch_test", "t_stat", "abs(cohens_d)", "effect_label", "rejected"),
            ("H3", "Welch t", "group_mean_welch_test", "t_stat", "abs(cohens_d)", "effect_label", "rejected"),
            ("H4", "Mann-Whitney U (greater)", "mann_whitney_u_test", "u_stat", "abs(rank_biserial)", "effect_label", "rejected"),
            ("H5", "Pearson r", "discount_margin_pearson_test", "r", "abs_r", size, "coalesce(significant, false)")]
    return "\nUNION ALL\n".join(
        f"SELECT '{h}' AS hypothesis_id, '{t}' AS test_name, CAST({stat} AS DOUBLE) AS statistic, p_value, CAST({size_} AS DOUBLE) AS effect_size, "
        f"{label} AS effect_label, {rej} AS rejected FROM ({REGISTRY[q].sql}) q{h}" for h, t, q, stat, size_, label, rej in rows)


REGISTRY["run_hypotheses"].sql = _hypotheses_sql()


@register("pearson_test", survey_id="J5",
          digits={"r": STAT, "t_stat": STAT, "effect_size": STAT, "avg_discount_pct": STAT, "avg_margin_pct": STAT},
          sql=with_(TX) + f"""SELECT r, n, r * sqrt((n - 2) / (1.0 - r * r)) AS t_stat, n - 2 AS df, abs(r) AS effect_size,
  {EFFECT_CASE.format(x="r")} AS effect_label, avg_discount_pct, avg_margin_pct FROM (
  SELECT covar_pop(margin_pct, discount_pct) / sqrt(var_pop(margin_pct) * var_pop(discount_pct)) AS r, count(*) AS n,
    avg(discount_pct) * 100 AS avg_discount_pct, avg(margin_pct) AS avg_margin_pct
  FROM (SELECT discount_pct, gross_profit / gross_revenue * 100 AS margin_pct FROM tx WHERE gross_revenue > 0))""")
def pearson_test(r: Retail):
    """Discount vs row margin over all rows with revenue > 0 (no
    sampling): r, t, effect |r| with Cohen's-d cut-offs, mean discount % and
    mean margin %.  The p-value is in ``run_hypotheses``."""
    from ..functions.expr import div, safe_corr
    from .q_describe import _row_margin
    m = _row_margin(r)
    a = m.agg(safe_corr("margin_pct", "discount_pct").alias("r"), F.count(F.lit(1)).alias("n"),
              (F.avg("discount_pct") * 100).alias("avg_discount_pct"), F.avg("margin_pct").alias("avg_margin_pct"))
    n = F.col("n")
    return a.select("r", "n", (F.col("r") * F.sqrt(div(n - 2, F.lit(1.0) - F.col("r") * F.col("r")))).alias("t_stat"),
                    (n - 2).alias("df"), F.abs("r").alias("effect_size"), size_label("r").alias("effect_label"),
                    "avg_discount_pct", "avg_margin_pct")
