"""Log-log price elasticity per category, classification, revenue
impact, per-category ridge with brand interaction → product elasticities,
demand prediction and optimal price."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.pvalues import t_ppf_udf


def _logs(tx: DataFrame, qty: str, price) -> DataFrame:
    p = F.col(price) if isinstance(price, str) else price
    return (tx.withColumn("_p", p).where((F.col(qty) > 0) & (F.col("_p") > 0))
            .withColumn("ln_q", F.log(qty)).withColumn("ln_p", F.log("_p")))


def elasticity_class(e) -> F.Column:
    """|ε| > 1 elastic, < 1 inelastic, else unit elastic."""
    a = F.abs(e)
    return F.when(a.isNull(), F.lit(None)).when(a > 1.0, "elastic").when(a < 1.0, "inelastic").otherwise("unit elastic")


def revenue_impact_10pct(e) -> F.Column:
    """% revenue change for a +10 % price: ((1.1)(1 + 0.1ε) − 1)·100."""
    return ((F.lit(1.1) * (F.lit(1.0) + e * 0.1)) - 1.0) * 100


def category_elasticity(tx: DataFrame, group: str = "category", qty: str = "quantity",
                        price="unit_price", min_n: int = 30, min_sd: float = 1e-6) -> DataFrame:
    """OLS of ln q on ln p per group: ε, SE = √(SSE/(n−2)/Sxx), R², n;
    groups with n < min_n or sd(ln p) < min_sd are dropped."""
    d = _logs(tx, qty, price)
    g = d.groupBy(group).agg(
        F.regr_count("ln_q", "ln_p").alias("n"), F.regr_slope("ln_q", "ln_p").alias("elasticity"),
        F.regr_intercept("ln_q", "ln_p").alias("intercept"), F.regr_r2("ln_q", "ln_p").alias("r_squared"),
        F.regr_sxx("ln_q", "ln_p").alias("_sxx"), F.regr_syy("ln_q", "ln_p").alias("_syy"),
        F.regr_sxy("ln_q", "ln_p").alias("_sxy"), F.stddev_samp("ln_p").alias("_sdp"))
    sse = F.col("_syy") - F.col("_sxy") * F.col("_sxy") / F.col("_sxx")
    return (g.where((F.col("n") >= min_n) & (F.col("_sdp") >= min_sd))
            .withColumn("std_error", F.sqrt(F.greatest(sse, F.lit(0.0)) / (F.col("n") - 2) / F.col("_sxx")))
            .withColumn("elasticity_class", elasticity_class(F.col("elasticity")))
            .withColumn("revenue_impact_10pct", revenue_impact_10pct(F.col("elasticity")))
            .drop("_sxx", "_syy", "_sxy", "_sdp"))


def with_elasticity_ci(df: DataFrame, level: float = 0.95) -> DataFrame:
    """T-based confidence interval of ε (df = n − 2)."""
    t = t_ppf_udf(F.lit(1 - (1 - level) / 2), (F.col("n") - 2).cast("double"))
    return (df.withColumn("_t", t).withColumn("ci_low", F.col("elasticity") - F.col("_t") * F.col("std_error"))
            .withColumn("ci_high", F.col("elasticity") + F.col("_t") * F.col("std_error")).drop("_t"))


def product_elasticity(tx: DataFrame, brand_flag: str = "is_private_label", qty: str = "quantity",
                       price="unit_price", alpha: float = 0.01, min_category: int = 10,
                       min_product: int = 5) -> DataFrame:
    """Per category ridge (α) of ln q on [ln p, brand, ln p·brand] (intercept
    unpenalised, centred sums); prices and quantities are clipped at 0.01 and 0.001.  Product
    ε = β1 + β3·brand for products with ≥ ``min_product`` rows; R² of the category model on the product's own rows;
    CI = ε ± 1.96·sd(ln q) ÷ (sd(ln p)·√n), ± 0.5 below 10 rows.  The 3×3 solve runs per
    category in ``applyInPandas`` over one Gram row; product rows join back."""
    p = F.col(price) if isinstance(price, str) else price
    d = (tx.withColumn("_p", p).where(F.col("category").isNotNull() & F.col("_p").isNotNull() & F.col(qty).isNotNull())
         .withColumn("ln_p", F.log(F.greatest("_p", F.lit(0.01)))).withColumn("ln_q", F.log(F.greatest(F.col(qty), F.lit(0.001))))
         .withColumn("_b", F.col(brand_flag).cast("double")).withColumn("_pb", F.col("ln_p") * F.col("_b")))
    feats = ["ln_p", "_b", "_pb"]
    # centred pair sums: raw second moments would lose the small ones to cancellation
    sums = [F.count(F.lit(1)).alias("n"), F.avg("ln_q").alias("my"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(feats)],
            *[F.regr_sxy("ln_q", c).alias(f"y{i}") for i, c in enumerate(feats)],
            *[F.regr_sxy(feats[i], feats[j]).alias(f"c{i}{j}") for i in range(3) for j in range(i, 3)]]
    g = d.groupBy("category").agg(*sums).where(F.col("n") >= min_category)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in pdf.iterrows():
            cxx = np.array([[row[f"c{min(i, j)}{max(i, j)}"] for j in range(3)] for i in range(3)], float)
            beta = np.linalg.solve(cxx + alpha * np.eye(3), np.array([row[f"y{i}"] for i in range(3)], float))
            out.append((row["category"], *map(float, beta), float(row["my"] - sum(beta[i] * row[f"m{i}"] for i in range(3)))))
        return pd.DataFrame(out, columns=["category", "b1", "b2", "b3", "intercept"])

    coef = g.groupBy("category").applyInPandas(solve, "category string, b1 double, b2 double, b3 double, intercept double")
    prod = d.groupBy("product_id", "category").agg(
        F.count(F.lit(1)).alias("n_obs"), F.max("_b").alias("brand"), F.avg("_p").alias("avg_price"), F.avg(qty).alias("avg_quantity"),
        F.avg("ln_p").alias("_mx"), F.avg("ln_q").alias("_my"), F.regr_sxx("ln_q", "ln_p").alias("_sxx"),
        F.regr_syy("ln_q", "ln_p").alias("_syy"), F.regr_sxy("ln_q", "ln_p").alias("_sxy"),
        F.stddev_samp("ln_p").alias("_sdp"), F.stddev_samp("ln_q").alias("_sdq"))
    j = prod.where(F.col("n_obs") >= min_product).join(coef, "category")
    e = F.col("b1") + F.col("b3") * F.col("brand")
    off = F.col("_my") - (F.col("intercept") + F.col("b2") * F.col("brand")) - e * F.col("_mx")
    ss_res = F.col("_syy") - 2 * e * F.col("_sxy") + e * e * F.col("_sxx") + F.col("n_obs") * off * off
    half = F.when(F.col("n_obs") >= 10, 1.96 * F.col("_sdq") / F.greatest(F.col("_sdp") * F.sqrt("n_obs"), F.lit(1e-8))).otherwise(0.5)
    return j.select("product_id", "category", "n_obs", "avg_price", "avg_quantity", e.alias("elasticity"),
                    (e - half).alias("ci_low"), (e + half).alias("ci_high"),
                    F.when(F.col("_syy") > 0, 1 - ss_res / F.col("_syy")).otherwise(0.0).alias("r_squared"),
                    elasticity_class(e).alias("elasticity_class"))


def category_summary(prod: DataFrame) -> DataFrame:
    """Mean ε, mean R² and product count per category."""
    return prod.groupBy("category").agg(F.avg("elasticity").alias("mean_elasticity"),
                                        F.avg("r_squared").alias("mean_r_squared"),
                                        F.count(F.lit(1)).alias("n_products"))


def predict_demand(base: DataFrame, multipliers: list[float]) -> DataFrame:
    """Demand at p = m·p̄: exp(ln q̄ + ε·ln(max(p, 0.01) / p̄)) for each multiplier, q̄ the mean
    quantity; q̄ itself where p̄ or q̄ is not positive (rows: product × price point)."""
    m = F.explode(F.array(*[F.lit(float(x)) for x in multipliers])).alias("price_multiplier")
    x = base.select("*", m).withColumn("price", F.col("avg_price") * F.col("price_multiplier"))
    bad = (F.col("avg_price") <= 0) | (F.col("avg_quantity") <= 0)
    value = F.exp(F.log("avg_quantity") + F.col("elasticity") * F.log(F.greatest("price", F.lit(0.01)) / F.col("avg_price")))
    return x.withColumn("predicted_quantity", F.when(bad, F.col("avg_quantity")).otherwise(value))


def optimal_price(base: DataFrame, cost: str = "unit_cost", target_margin: float = 0.3) -> DataFrame:
    """The margin price cost / max(1 − target, 0.01) (0.01 without a cost), or the revenue-maximising
    p̄·ε/(ε + 1) when ε < −1 and that is higher."""
    least = F.when(F.col(cost) > 0, F.col(cost) / max(1.0 - target_margin, 0.01)).otherwise(0.01)
    best = F.col("avg_price") * (F.col("elasticity") / (F.col("elasticity") + 1))
    return base.withColumn("optimal_price", F.when(F.col("elasticity") < -1, F.greatest(least, best)).otherwise(least))
