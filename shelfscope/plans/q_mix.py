"""Registered marketing-mix and price-elasticity queries."""

from __future__ import annotations

from itertools import permutations
from statistics import NormalDist

from pyspark.sql import functions as F

from ..operators import elasticity as E
from ..operators import mix as N
from ..sources.retail import Retail
from .registry import MONEY, REGISTRY, STAT, UNIT, register
from .sql import MARKETING, PRODUCTS, TX, t_quantile_sql, with_

CHANNELS = ["click", "error", "signup", "view"]
# event type → media channel name used for the decay table (adapter choice)
CHANNEL_NAMES = {"click": "digital", "view": "social", "signup": "email"}
DECAY = {ch: N.CHANNEL_DECAY.get(CHANNEL_NAMES.get(ch, ""), N.DEFAULT_DECAY) for ch in CHANNELS}
DECAY_CASE = "CASE channel " + " ".join(f"WHEN '{c}' THEN {v}" for c, v in DECAY.items()) + " END"


def _adstock(r: Retail):
    return N.adstock(r.marketing, ["market", "channel"], "period", "spend",
                     N.decay_column("channel", CHANNEL_NAMES))


@register("adstock", survey_id="N1,E5", digits={"spend": UNIT, "adstock": UNIT},
          sql=with_(MARKETING) + f""", s AS (SELECT *, row_number() OVER (PARTITION BY market, channel ORDER BY period) AS rn
  FROM (SELECT market, channel, period, sum(spend) AS spend FROM mkt GROUP BY ALL))
SELECT t.market, t.channel, t.period, t.spend,
  sum(s.spend * pow({DECAY_CASE.replace("channel", "t.channel", 1)}, t.rn - s.rn)) AS adstock
FROM s t JOIN s ON s.market = t.market AND s.channel = t.channel AND s.rn <= t.rn
GROUP BY t.market, t.channel, t.period, t.spend""")
def adstock(r: Retail):
    return _adstock(r)


def segmented(r: Retail, df):
    """Rows with their market's region as segment, and all rows again as segment 'all'."""
    geo = r.tables["nation"].join(r.tables["region"], F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_name").alias("market"), F.col("r_name").alias("segment"))
    return df.join(geo, "market", "left").unionByName(df.withColumn("segment", F.lit("all")))


def _aligned(r: Retail):
    """Zero-filled spend per (segment, day) and channel beside the day's revenue."""
    return N.spend_pivot(segmented(r, r.marketing), segmented(r, r.response), CHANNELS, group=["segment"])


def _design(r: Retail):
    return N.adstock_design(_aligned(r), CHANNELS, DECAY, group=["segment"])


ALIGNED_SQL = with_(MARKETING) + """, geo AS (SELECT n_name AS market, r_name AS segment FROM nation JOIN region ON n_regionkey = r_regionkey),
ms AS (SELECT segment, period, channel, spend FROM mkt JOIN geo USING (market) UNION ALL SELECT 'all', period, channel, spend FROM mkt),
rs AS (SELECT segment, period, revenue FROM resp JOIN geo USING (market) UNION ALL SELECT 'all', period, revenue FROM resp),
w AS (SELECT segment, period, """ + ", ".join(
    f"coalesce(sum(CASE WHEN channel = '{c}' THEN spend END), 0.0) AS {c}" for c in CHANNELS) + """ FROM ms GROUP BY ALL),
rv AS (SELECT segment, period, sum(revenue) AS revenue FROM rs GROUP BY ALL),
aligned AS (SELECT * EXCLUDE (n) FROM (SELECT w.*, revenue, count(*) OVER (PARTITION BY segment) AS n FROM w JOIN rv USING (segment, period))
  WHERE n >= 4),
numbered AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY period) AS rn FROM aligned),
design AS (SELECT t.segment, t.period, t.revenue, """ + ", ".join(
    f"sum(s.{c} * pow({lam}, t.rn - s.rn)) AS {c}" for c, lam in DECAY.items()) + """
  FROM numbered t JOIN numbered s ON s.segment = t.segment AND s.rn <= t.rn GROUP BY ALL)
"""
DESIGN_DIGITS = {**{c: MONEY for c in CHANNELS}, "revenue": MONEY}


@register("spend_pivot", survey_id="N2,F6", digits=DESIGN_DIGITS, sql=ALIGNED_SQL + "SELECT * FROM aligned")
def spend_pivot(r: Retail):
    return _aligned(r)


@register("mmm_design", survey_id="N1,N3", digits=DESIGN_DIGITS, sql=ALIGNED_SQL + "SELECT * FROM design")
def mmm_design(r: Retail):
    """Design of the mix model per segment: pivoted, zero filled, then adstocked."""
    return _design(r)


def _fit(r: Retail):
    return N.mmm_fit(_design(r), CHANNELS, "revenue", alpha=1.0, group=["segment"])


def _det(m: list[list[str]]) -> str:
    """Determinant as SQL text, by permutations."""
    terms = []
    for order in permutations(range(len(m))):
        swaps = sum(a > b for k, a in enumerate(order) for b in order[k + 1:])
        terms.append(("- " if swaps % 2 else "+ ") + " * ".join(m[i][j] for i, j in enumerate(order)))
    return "(" + " ".join(terms) + ")"


# the ridge system by Cramer's rule on correlations, independent of the elimination
def _fit_sql() -> str:
    size = range(len(CHANNELS))
    m = [[f"(z{min(i, j)}{max(i, j)} + {1.0 if i == j else 0.0})" for j in size] for i in size]
    cramer = [[[f"y{i}" if j == k else m[i][j] for j in size] for i in size] for k in size]

    def safe(c: str) -> str:
        return f"CASE WHEN {c} > 0 THEN {c} ELSE 1.0 END"
    means = ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(CHANNELS))
    cov = ", ".join([*(f"covar_pop({CHANNELS[i]}, {CHANNELS[j]}) AS c{i}{j}" for i in size for j in size if i <= j),
                     *(f"covar_pop({c}, revenue) AS cy{i}" for i, c in enumerate(CHANNELS))])
    z = ", ".join([*(f"n * c{i}{j} / (({safe(f's{i}')}) * ({safe(f's{j}')})) AS z{i}{j}" for i in size for j in size if i <= j),
                   *(f"n * cy{i} / (({safe(f's{i}')}) * ({safe('ys')})) AS y{i}" for i in size)])
    beta = ", ".join(f"{_det(cramer[k])} / det AS b{k}" for k in size)
    fitted = " + ".join(f"b{i} * (({c}) - m{i}) / ({safe(f's{i}')})" for i, c in enumerate(CHANNELS))
    rows = " UNION ALL ".join(f"SELECT segment, '{c}' AS channel, b{i} AS beta, m{i} AS x_mean, s{i} AS x_std, ym AS y_mean, ys AS y_std, "
                              f"r_squared, n FROM solved JOIN quality USING (segment)" for i, c in enumerate(CHANNELS))
    return ALIGNED_SQL + f""", moments AS (SELECT segment, count(*) AS n, avg(revenue) AS ym, stddev_pop(revenue) AS ys, {means}, {cov} FROM design GROUP BY segment),
scaled AS (SELECT *, {z} FROM moments),
dets AS (SELECT *, {_det(m)} AS det FROM scaled),
solved AS (SELECT *, {beta} FROM dets),
predicted AS (SELECT segment, revenue, ym + ys * ({fitted}) AS prediction FROM design JOIN solved USING (segment)),
quality AS (SELECT segment, sqrt(avg(pow(revenue - prediction, 2))) AS rmse, avg(abs(revenue - prediction)) AS mae,
  1 - avg(pow(revenue - prediction, 2)) / var_pop(revenue) AS r_squared FROM predicted GROUP BY segment),
fit AS ({rows}),
roi AS (SELECT segment, channel, total_spend, CASE WHEN total_spend > 0 THEN abs(beta) * x_mean * y_std * {len(CHANNELS)} / total_spend ELSE 0.0 END AS roi
  FROM fit JOIN (UNPIVOT (SELECT segment, {", ".join(f"sum({c}) AS {c}" for c in CHANNELS)} FROM aligned GROUP BY segment)
                 ON {", ".join(CHANNELS)} INTO NAME channel VALUE total_spend) USING (segment, channel))
"""


FIT_SQL = _fit_sql()


@register("mmm_fit", survey_id="N3", digits={"beta": STAT, "r_squared": STAT, "x_mean": UNIT, "x_std": UNIT, "y_mean": UNIT, "y_std": UNIT},
          sql=FIT_SQL + "SELECT * FROM fit")
def mmm_fit(r: Retail):
    return _fit(r)


@register("mmm_contributions", survey_id="N4", digits={"beta": STAT, "contribution_pct": STAT},
          sql=FIT_SQL + """SELECT segment, channel, beta, CASE WHEN sum(greatest(beta, 0.0)) OVER w > 0
  THEN greatest(beta, 0.0) / sum(greatest(beta, 0.0)) OVER w * 100 ELSE 0.0 END AS contribution_pct FROM fit WINDOW w AS (PARTITION BY segment)""")
def mmm_contributions(r: Retail):
    return N.mmm_contributions(_fit(r), ["segment"]).select("segment", "channel", "beta", "contribution_pct")


def _roi(r: Retail):
    spent = _aligned(r).unpivot(["segment"], CHANNELS, "channel", "spend").groupBy("segment", "channel").agg(
        F.sum("spend").alias("total_spend"))
    return N.mmm_roi(_fit(r), spent, len(CHANNELS), ["segment"])


@register("mmm_roi", survey_id="N5,P5", digits={"roi": STAT, "total_spend": MONEY},
          sql=FIT_SQL + "SELECT segment, channel, total_spend, roi FROM roi")
def mmm_roi(r: Retail):
    return _roi(r).select("segment", "channel", "total_spend", "roi")


@register("mmm_predict", survey_id="N6", digits={"rmse": UNIT, "mae": UNIT, "r_squared": STAT},
          sql=FIT_SQL + "SELECT segment, rmse, mae, r_squared FROM quality")
def mmm_predict(r: Retail):
    return N.mmm_predict(_design(r), _fit(r), CHANNELS, group=["segment"])


# default split when no channel has positive ROI (adapter channels)
DEFAULT_SPLIT = {"click": 0.4, "view": 0.3, "signup": 0.2, "error": 0.1}
BUDGET_DIGITS = {"roi": STAT, "share": STAT, "recommended_budget": MONEY}


@register("budget_recommendation", survey_id="N7", digits=BUDGET_DIGITS,
          sql=FIT_SQL + f""", shares AS (SELECT channel, roi, CASE WHEN sum(greatest(roi, 0.0)) OVER () > 0
  THEN greatest(roi, 0.0) / sum(greatest(roi, 0.0)) OVER ()
  ELSE CASE channel {" ".join(f"WHEN '{c}' THEN {v}" for c, v in DEFAULT_SPLIT.items())} ELSE 0.0 END END AS share FROM roi WHERE segment = 'all')
SELECT *, share * 1000000.0 AS recommended_budget FROM shares""")
def budget_recommendation(r: Retail):
    return N.budget_recommendation(_roi(r).where("segment = 'all'").select("channel", "roi"), 1_000_000.0, DEFAULT_SPLIT)


# ROI per channel as given values (a parameter table)
GIVEN_ROI = {"click": 1.5, "view": 0.8, "signup": -0.2, "error": 0.0}
GIVEN_CASE = "CASE channel " + " ".join(f"WHEN '{c}' THEN CAST({v} AS DOUBLE)" for c, v in GIVEN_ROI.items()) + " END"


@register("budget_recommendation_given_roi", survey_id="N7", digits=BUDGET_DIGITS,
          sql=with_(MARKETING) + f""", roi AS (SELECT channel, {GIVEN_CASE} AS roi, sum(spend) AS spend FROM mkt GROUP BY channel),
p AS (SELECT channel, roi, spend, greatest(roi, 0.0) AS pos, sum(greatest(roi, 0.0)) OVER () AS tot, sum(spend) OVER () AS budget FROM roi),
s AS (SELECT channel, roi, budget, CASE WHEN tot > 0 THEN pos / tot ELSE 0.0 END AS share FROM p)
SELECT channel, roi, share, share * budget AS recommended_budget FROM s""")
def budget_recommendation_given_roi(r: Retail):
    """N7 with given ROI values: the total spend dealt out by ROI share."""
    m = F.create_map(*[x for k, v in GIVEN_ROI.items() for x in (F.lit(k), F.lit(v))])
    roi = r.marketing.groupBy("channel").agg(F.sum("spend").alias("_s")).select("channel", m[F.col("channel")].alias("roi"))
    return N.budget_recommendation(roi, r.marketing.agg(F.sum("spend")).scalar(), DEFAULT_SPLIT)


@register("channel_allocation", survey_id="N8,P5", digits={"spend": MONEY, "annual_spend": MONEY, "share_pct": STAT},
          sql=with_(MARKETING) + """, g AS (SELECT channel, sum(spend) AS spend FROM mkt GROUP BY channel)
SELECT channel, spend, spend / (SELECT count(DISTINCT period) FROM mkt) * 365.0 AS annual_spend,
  spend / sum(spend) OVER () * 100 AS share_pct FROM g""")
def channel_allocation(r: Retail):
    return N.channel_allocation(r.marketing, [], 365.0)


@register("channel_allocation_by_segment", survey_id="N8,P5", digits={"spend": MONEY, "annual_spend": MONEY, "share_pct": STAT},
          sql=ALIGNED_SQL + """, g AS (SELECT segment, channel, sum(spend) AS spend FROM ms WHERE segment <> 'all' GROUP BY ALL)
SELECT segment, channel, spend, spend / (SELECT count(DISTINCT period) FROM mkt) * 365.0 AS annual_spend,
  spend / sum(spend) OVER (PARTITION BY segment) * 100 AS share_pct FROM g""")
def channel_allocation_by_segment(r: Retail):
    return N.channel_allocation(segmented(r, r.marketing).where("segment <> 'all'"), ["segment"], 365.0)


ELAST_DIGITS = {"elasticity": STAT, "intercept": STAT, "r_squared": STAT, "std_error": STAT,
                "revenue_impact_10pct": STAT}
ELAST_SQL = """el AS (SELECT category, CAST(regr_count(ln_q, ln_p) AS BIGINT) AS n, regr_slope(ln_q, ln_p) AS elasticity,
  regr_intercept(ln_q, ln_p) AS intercept, regr_r2(ln_q, ln_p) AS r_squared,
  sqrt(greatest(regr_syy(ln_q, ln_p) - regr_sxy(ln_q, ln_p) * regr_sxy(ln_q, ln_p) / regr_sxx(ln_q, ln_p), 0.0)
       / (regr_count(ln_q, ln_p) - 2) / regr_sxx(ln_q, ln_p)) AS std_error, stddev_samp(ln_p) AS sdp
  FROM (SELECT category, ln(quantity) AS ln_q, ln(unit_price) AS ln_p FROM tx WHERE quantity > 0 AND unit_price > 0)
  GROUP BY category)"""


@register("category_elasticity", survey_id="N9-N11", digits=ELAST_DIGITS,
          sql=with_(TX, ELAST_SQL) + """SELECT category, n, elasticity, intercept, r_squared, std_error,
  CASE WHEN abs(elasticity) > 1.0 THEN 'elastic' WHEN abs(elasticity) < 1.0 THEN 'inelastic' ELSE 'unit elastic' END
    AS elasticity_class, ((1.1 * (1.0 + elasticity * 0.1)) - 1.0) * 100 AS revenue_impact_10pct
FROM el WHERE n >= 30 AND sdp >= 1e-6""")
def category_elasticity(r: Retail):
    return E.category_elasticity(r.transactions)


@register("category_elasticity_ci", survey_id="N9", digits=dict(ELAST_DIGITS, ci_low=STAT, ci_high=STAT),
          sql=f"""SELECT *, elasticity - {t_quantile_sql(NormalDist().inv_cdf(0.975), "n - 2")} * std_error AS ci_low,
  elasticity + {t_quantile_sql(NormalDist().inv_cdf(0.975), "n - 2")} * std_error AS ci_high FROM ({REGISTRY["category_elasticity"].sql})""")
def category_elasticity_ci(r: Retail):
    return E.with_elasticity_ci(E.category_elasticity(r.transactions))


def _tx_brand(r: Retail):
    """Read twice, for the categories and for the products."""
    r = r.kept("product_id", "category", "brand_type", "quantity", "unit_price")
    return r.transactions.withColumn("is_private_label", F.coalesce(F.col("brand_type") == "private_label", F.lit(False)).cast("int"))


def _products(r: Retail):
    return E.product_elasticity(_tx_brand(r))


# ridge (0.01) of ln q on [ln p, brand, ln p·brand] per category by Cramer's rule on the centred sums
PE_SQL = """lg AS (SELECT product_id, category, quantity, unit_price, ln(greatest(unit_price, 0.01)) AS a,
    CAST(brand_type = 'private_label' AS DOUBLE) AS b, ln(greatest(unit_price, 0.01)) * CAST(brand_type = 'private_label' AS DOUBLE) AS c,
    ln(greatest(quantity, 0.001)) AS y FROM tx WHERE category IS NOT NULL AND unit_price IS NOT NULL AND quantity IS NOT NULL),
cs AS (SELECT category, count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, avg(y) AS my,
    regr_sxx(y, a) + 0.01 AS aa, regr_sxx(y, b) + 0.01 AS bb, regr_sxx(y, c) + 0.01 AS cc, regr_sxy(a, b) AS ab, regr_sxy(a, c) AS ac,
    regr_sxy(b, c) AS bc, regr_sxy(y, a) AS ya, regr_sxy(y, b) AS yb, regr_sxy(y, c) AS yc FROM lg GROUP BY category HAVING count(*) >= 10),
cd AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM cs),
cb AS (SELECT *, (ya * (bb * cc - bc * bc) - ab * (yb * cc - bc * yc) + ac * (yb * bc - bb * yc)) / det AS b1,
    (aa * (yb * cc - yc * bc) - ya * (ab * cc - bc * ac) + ac * (ab * yc - yb * ac)) / det AS b2,
    (aa * (bb * yc - bc * yb) - ab * (ab * yc - yb * ac) + ya * (ab * bc - bb * ac)) / det AS b3 FROM cd),
pr AS (SELECT product_id, category, count(*) AS n_obs, max(b) AS brand, avg(unit_price) AS avg_price, avg(quantity) AS avg_quantity,
    avg(a) AS pa, avg(y) AS py, regr_sxx(y, a) AS sxx, regr_syy(y, a) AS syy, regr_sxy(y, a) AS sxy,
    stddev_samp(a) AS sda, stddev_samp(y) AS sdy FROM lg GROUP BY product_id, category HAVING count(*) >= 5),
pe0 AS (SELECT pr.*, b1 + b3 * brand AS e, py - (my - b1 * ma - b2 * mb - b3 * mc + b2 * brand) - (b1 + b3 * brand) * pa AS d FROM pr JOIN cb USING (category)),
pe AS (SELECT product_id, category, CAST(n_obs AS BIGINT) AS n_obs, avg_price, avg_quantity, e AS elasticity,
    e - CASE WHEN n_obs >= 10 THEN 1.96 * sdy / greatest(sda * sqrt(n_obs), 1e-8) ELSE 0.5 END AS ci_low,
    e + CASE WHEN n_obs >= 10 THEN 1.96 * sdy / greatest(sda * sqrt(n_obs), 1e-8) ELSE 0.5 END AS ci_high,
    CASE WHEN syy > 0 THEN 1 - (syy - 2 * e * sxy + e * e * sxx + n_obs * d * d) / syy ELSE 0.0 END AS r_squared,
    CASE WHEN abs(e) > 1.0 THEN 'elastic' WHEN abs(e) < 1.0 THEN 'inelastic' ELSE 'unit elastic' END AS elasticity_class FROM pe0)"""
FINE = 20  # products: a ridge solve in two ways agrees to about six digits
PE_DIGITS = {"elasticity": FINE, "ci_low": FINE, "ci_high": FINE, "r_squared": FINE, "avg_price": UNIT, "avg_quantity": UNIT}


@register("product_elasticity", survey_id="N12", digits=PE_DIGITS, sql=with_(TX, PE_SQL) + "SELECT * FROM pe")
def product_elasticity(r: Retail):
    return _products(r)


@register("category_elasticity_summary", survey_id="N13", digits={"mean_elasticity": FINE, "mean_r_squared": FINE},
          sql=with_(TX, PE_SQL) + """SELECT category, avg(elasticity) AS mean_elasticity, avg(r_squared) AS mean_r_squared,
  count(*) AS n_products FROM pe GROUP BY category""")
def category_elasticity_summary(r: Retail):
    return E.category_summary(_products(r))


@register("all_elasticities", survey_id="N16", digits={"elasticity": FINE},
          sql=with_(TX, PE_SQL) + "SELECT product_id, category, elasticity, elasticity_class FROM pe")
def all_elasticities(r: Retail):
    return (_products(r).select("product_id", "category", "elasticity", "elasticity_class")
            .orderBy("elasticity", "product_id"))


@register("elasticity_table_sink", survey_id="A8", digits={"elasticity": FINE, "ci_low": FINE, "ci_high": FINE},
          sql=with_(TX, PE_SQL) + "SELECT product_id, category, elasticity, ci_low, ci_high FROM pe")
def elasticity_table_sink(r: Retail):
    """Writes the elasticity table to shared storage and reads it back."""
    from ..sources import sinks as S
    out = _products(r)
    path = S.write_table(out.select("product_id", "category", "elasticity", "ci_low", "ci_high"),
                         S.shared_root(out.sparkSession, "elasticity"))
    return out.sparkSession.read.parquet(path)


MULTIPLIERS = [0.9, 1.0, 1.1]


@register("predict_demand", survey_id="N14",
          digits={"avg_price": UNIT, "avg_quantity": UNIT, "elasticity": FINE, "price": UNIT, "predicted_quantity": UNIT},
          sql=with_(TX, PE_SQL) + ", m(price_multiplier) AS (VALUES " + ", ".join(
              f"(CAST({x} AS DOUBLE))" for x in MULTIPLIERS) + """)
SELECT product_id, category, avg_price, avg_quantity, elasticity, price_multiplier, avg_price * price_multiplier AS price,
  CASE WHEN avg_price <= 0 OR avg_quantity <= 0 THEN avg_quantity
    ELSE exp(ln(avg_quantity) + elasticity * ln(greatest(avg_price * price_multiplier, 0.01) / avg_price)) END AS predicted_quantity FROM pe, m""")
def predict_demand(r: Retail):
    base = _products(r).select("product_id", "category", "avg_price", "avg_quantity", "elasticity")
    return E.predict_demand(base, MULTIPLIERS)


@register("optimal_price", survey_id="N15",
          digits={"avg_price": UNIT, "elasticity": FINE, "unit_cost": UNIT, "optimal_price": UNIT},
          sql=with_(TX, PRODUCTS, PE_SQL) + """, f AS (SELECT product_id, unit_cost,
  CASE WHEN unit_cost > 0 THEN unit_cost / greatest(1.0 - 0.3, 0.01) ELSE 0.01 END AS min_price FROM products)
SELECT product_id, avg_price, elasticity, unit_cost, CASE WHEN elasticity < -1
  THEN greatest(min_price, avg_price * (elasticity / (elasticity + 1))) ELSE min_price END AS optimal_price
FROM f LEFT JOIN pe USING (product_id)""")
def optimal_price(r: Retail):
    base = r.products.select("product_id", "unit_cost").join(
        _products(r).select("product_id", "avg_price", "elasticity"), "product_id", "left")
    return E.optimal_price(base)
