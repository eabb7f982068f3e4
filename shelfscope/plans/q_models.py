"""Registered model queries (M1-M14).  Metric queries with a
deterministic score have DuckDB oracles; trained-model outputs are rows-only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import features as L
from ..operators import models as M
from ..sources import sinks as S
from ..sources.retail import Retail
from .q_features import CUTOFF, SF_SQL
from .registry import STAT, UNIT, register
from .sql import CUSTOMERS, TX, with_

NUMERIC = ["recency_days", "n_txns", "total_spend", "avg_discount"]


def _churn_data(r: Retail):
    f = L.point_in_time_churn(r.transactions, CUTOFF)
    return f.join(r.customers.select("customer_id", "tier"), "customer_id", "left").withColumn(
        "label", F.col("is_churned").cast("double"))


METRIC_DIGITS = {"auc_roc": STAT, "precision": STAT, "recall": STAT, "f1": STAT, "accuracy": STAT, "average_precision": STAT}


def _cut(df: DataFrame, name: str) -> DataFrame:
    """Training passes over its rows many times: they are written to the shared folder once and reread."""
    spark = df.sparkSession
    return spark.read.parquet(S.write_table(df, S.shared_root(spark, name)))


def _churn_split(r: Retail):
    return M.hash_split(_cut(_churn_data(r), "churn"), "customer_id", label="label", keep=_cut)


@register("churn_model_eval", survey_id="M1-M5,M7", digits=METRIC_DIGITS)
def churn_model_eval(r: Retail):
    train, test = _churn_split(r)
    return M.classification_metrics(M.churn_scores(M.fit_classifier(train, NUMERIC, ["tier"], "logistic"), test), "label", "churn_probability")


@register("churn_report", survey_id="M8", digits={"churn_rate": STAT, "revenue_at_risk": STAT})
def churn_report(r: Retail):
    """Fitted on the training rows, reported on the held-out ones."""
    train, test = _churn_split(r)
    model = M.fit_classifier(train, NUMERIC, ["tier"], "logistic")
    return M.churn_report(M.churn_scores(model, test), r.customers)


@register("churn_report_given_scores", survey_id="M8", digits={"churn_rate": STAT, "revenue_at_risk": STAT},
          sql=with_(TX, CUSTOMERS) + """, s AS (SELECT customer_id, tier, avg(discount_pct) * 10 AS p FROM tx JOIN customers USING (customer_id)
  GROUP BY customer_id, tier),
g AS (SELECT tier, count(*) AS n, count_if(p >= 0.5) AS n_churners, count_if(p >= 0.7) AS n_high_confidence FROM s GROUP BY tier
  UNION ALL SELECT 'ALL', count(*), count_if(p >= 0.5), count_if(p >= 0.7) FROM s)
SELECT tier, n, n_churners, n_high_confidence, n_churners / n AS churn_rate, n_churners * 850.0 AS revenue_at_risk FROM g""")
def churn_report_given_scores(r: Retail):
    """The report on a score that SQL can state (ten times the mean discount)."""
    p = r.transactions.groupBy("customer_id").agg((F.avg("discount_pct") * 10).alias("churn_probability"))
    s = p.join(r.customers.select("customer_id", "tier"), "customer_id").withColumn("churn_flag", (F.col("churn_probability") >= 0.5).cast("int"))
    return M.churn_report(s, r.customers)


@register("classification_metrics", survey_id="M5", digits={"auc_roc": STAT, "precision": STAT, "recall": STAT,
                                                            "f1": STAT, "accuracy": STAT, "average_precision": STAT},
          sql="""WITH s AS (SELECT CAST(l_returnflag = 'R' AS INT) AS y, l_discount * 10 AS score FROM lineitem),
rk AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS ar FROM s),
c AS (SELECT count_if(score >= 0.5 AND y = 1) AS tp, count_if(score >= 0.5 AND y = 0) AS fp,
  count_if(score < 0.5 AND y = 0) AS tn, count_if(score < 0.5 AND y = 1) AS fn FROM s),
a AS (SELECT sum(CASE WHEN y = 1 THEN ar END) AS r1 FROM rk)
SELECT tp, fp, tn, fn,
  CASE WHEN tp + fn > 0 AND tn + fp > 0 THEN (r1 - (tp + fn) * (tp + fn + 1) / 2) / ((tp + fn) * (tn + fp)) END AS auc_roc,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
  CASE WHEN (CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END) + (CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END) > 0
    THEN 2 * (CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END) * (CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END)
    / ((CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END) + (CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END))
    ELSE 0.0 END AS f1,
  (tp + tn) / (tp + tn + fp + fn) AS accuracy,
  (SELECT sum(pos / CAST(p AS DOUBLE) * tpk / nk) FROM (SELECT score, sum(y) AS pos, sum(sum(y)) OVER () AS p,
     sum(sum(y)) OVER (ORDER BY score DESC) AS tpk, sum(count(*)) OVER (ORDER BY score DESC) AS nk FROM s GROUP BY score)) AS average_precision
FROM c, a""")
def classification_metrics(r: Retail):
    li = r.tables["lineitem"]
    s = li.select((F.col("l_returnflag") == "R").cast("int").alias("y"), (F.col("l_discount") * 10).alias("score"))
    return M.classification_metrics(s, "y", "score")


@register("regression_metrics", survey_id="M6", digits={"rmse": UNIT, "mae": UNIT, "r_squared": STAT, "mape": STAT},
          sql="""WITH s AS (SELECT l_extendedprice AS y, l_quantity * p_retailprice * 2.5 AS p FROM lineitem
  JOIN part ON l_partkey = p_partkey)
SELECT sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae,
  1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)) AS r_squared,
  avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END) * 100 AS mape FROM s""")
def regression_metrics(r: Retail):
    li, p = r.tables["lineitem"], r.tables["part"]
    s = li.join(p, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * F.col("p_retailprice") * 2.5).alias("p"))
    return M.regression_metrics(s, "y", "p")


@register("feature_importance", survey_id="M12", digits={"importance": STAT})
def feature_importance(r: Retail):
    train, _ = _churn_split(r)
    model = M.fit_classifier(train, NUMERIC, ["tier"], "random_forest")
    return M.feature_importance(model, M.slot_names(model, NUMERIC, ["tier"]))


@register("permutation_importance", survey_id="M13", digits={"auc_loss": STAT})
def permutation_importance(r: Retail):
    train, test = _churn_split(r)
    model = M.fit_classifier(train, NUMERIC, ["tier"], "random_forest")
    return M.permutation_importance(model, test, [*NUMERIC, "tier"], "label", "customer_id", keep=_cut)


STORE_NUMERIC = ["size", "avg_monthly_revenue", "revenue_volatility", "active_months", "revenue_slope",
                 "avg_monthly_cost"]


def _store_data(r: Retail):
    from ..operators import features as LF
    from .q_kpi import CLUSTERS
    f = LF.store_features(r.transactions, r.stores, None, CLUSTERS, months=r.store_months)
    return LF.top_performer_label(f).withColumn("label_cls", F.col("is_top_performer").cast("double"))


@register("store_models", survey_id="M3,M4,M6", digits={"rmse": STAT, "mae": STAT, "r_squared": STAT, "mape": STAT, "mean_r2": STAT, "std_r2": STAT})
def store_models(r: Retail):
    """Ridge, random-forest and boosted regressions of the margin ratio on store features, cross-validated on the training
    stores and judged on held-out ones."""
    train, test = M.hash_split(_cut(_store_data(r).where(F.col("margin_ratio").isNotNull()), "stores"), "store_id")
    return M.regressor_comparison(train, test, STORE_NUMERIC, "margin_ratio", "store_id", keep=_cut)


@register("store_classifiers", survey_id="M3,M4", digits=dict(METRIC_DIGITS, mean_auc=STAT, std_auc=STAT))
def store_classifiers(r: Retail):
    """Top-performer classifiers on a stratified split, cross-validated on the training stores."""
    train, test = M.hash_split(_cut(_store_data(r).where(F.col("label_cls").isNotNull()), "stores"), "store_id", label="label_cls")
    train, test = _cut(train, "stores-train"), _cut(test, "stores-test")
    return M.model_comparison(train, test, STORE_NUMERIC, [], "store_id", "label_cls", min_leaf=1, keep=_cut)


@register("stratified_folds", survey_id="M4",
          sql=with_(CUSTOMERS) + """, h AS (SELECT customer_id, tier, CAST(CAST('0x' || substr(md5(customer_id || '-7'), 1, 8) AS BIGINT) AS DOUBLE) AS h FROM customers),
f AS (SELECT tier, customer_id, (row_number() OVER (PARTITION BY tier ORDER BY h, customer_id) - 1) % 5 AS fold FROM h WHERE tier IS NOT NULL)
SELECT CAST(fold AS INTEGER) AS fold, tier, count(*) AS n, CAST(sum(customer_id) AS BIGINT) AS id_sum FROM f GROUP BY fold, tier""")
def stratified_folds(r: Retail):
    """Five folds of the customers, stratified by tier: rows and sum of ids of each."""
    f = M.stratified_folds(r.customers.where(F.col("tier").isNotNull()), "customer_id", "tier")
    return f.groupBy(F.col("_fold").alias("fold"), "tier").agg(F.count(F.lit(1)).alias("n"), F.sum("customer_id").alias("id_sum"))


@register("churn_model_cv", survey_id="M4", digits={"mean_auc": STAT, "std_auc": STAT})
def churn_model_cv(r: Retail):
    train, _ = _churn_split(r)
    return M.cross_validated_auc(train, NUMERIC, ["tier"], "customer_id", folds=5, keep=_cut)


def _scored_stores(r: Retail):
    from ..operators import features as LF
    from .q_kpi import CLUSTERS
    f = LF.store_features(r.transactions, r.stores, None, CLUSTERS, months=r.store_months)
    # deterministic score (the margin ratio as predicted performance /
    # probability) so the DuckDB oracle can check the report logic
    return f.withColumn("prediction", F.col("margin_ratio")).withColumn("probability", F.col("margin_ratio"))


@register("store_report", survey_id="M9",
          digits={"p20": STAT, "median": STAT, "p80": STAT, "annual_uplift": UNIT},
          sql=f"""WITH s AS ({SF_SQL}),
q AS (SELECT quantile_cont(margin_ratio, 0.2) AS a, quantile_cont(margin_ratio, 0.35) AS b,
             quantile_cont(margin_ratio, 0.5) AS c, quantile_cont(margin_ratio, 0.8) AS d FROM s)
SELECT a AS p20, c AS median, d AS p80, count_if(margin_ratio >= d) AS n_top, count_if(margin_ratio < a) AS n_bottom,
  count_if(margin_ratio >= a AND margin_ratio < b) AS n_monitor,
  coalesce(greatest(0.0, c - coalesce(avg(CASE WHEN margin_ratio < a THEN margin_ratio END), 0.0))
    * avg(CASE WHEN margin_ratio < a THEN avg_monthly_revenue END) * count_if(margin_ratio < a) * 12, 0.0)
    AS annual_uplift
FROM s, q GROUP BY a, b, c, d""")
def store_report(r: Retail):
    return M.store_report(_scored_stores(r))


@register("store_action_lists", survey_id="M9", digits={"uplift_potential": UNIT},
          sql=f"""WITH s AS ({SF_SQL}),
q AS (SELECT quantile_cont(margin_ratio, 0.2) AS a, quantile_cont(margin_ratio, 0.35) AS b,
             quantile_cont(margin_ratio, 0.5) AS m FROM s),
inv AS (SELECT store_id, (m - margin_ratio) * avg_monthly_revenue AS uplift_potential FROM s, q WHERE margin_ratio < a),
mon AS (SELECT store_id, margin_ratio FROM s, q WHERE margin_ratio >= a AND margin_ratio < b)
SELECT * FROM (SELECT 'invest' AS list_type, store_id,
  row_number() OVER (ORDER BY uplift_potential DESC, store_id) AS rank, uplift_potential FROM inv) WHERE rank <= 20
UNION ALL
SELECT 'monitor' AS list_type, store_id, row_number() OVER (ORDER BY margin_ratio, store_id) AS rank,
  CAST(NULL AS DOUBLE) AS uplift_potential FROM mon""")
def store_action_lists(r: Retail):
    return M.store_action_lists(_scored_stores(r))


@register("store_report_classification", survey_id="M10", digits={"annual_uplift": UNIT},
          sql=f"""WITH s AS ({SF_SQL})
SELECT count_if(margin_ratio >= 0.5) AS n_top, count_if(margin_ratio < 0.5) AS n_bottom,
  count_if(margin_ratio >= 0.4 AND margin_ratio < 0.5) AS n_invest, count_if(margin_ratio < 0.3) AS n_high_risk,
  count_if(margin_ratio < 0.5) * avg(avg_monthly_revenue) * 0.05 * 12 AS annual_uplift FROM s""")
def store_report_classification(r: Retail):
    return M.store_report_classification(_scored_stores(r))


@register("store_action_lists_classification", survey_id="M10", digits={"probability": STAT},
          sql=f"""WITH s AS ({SF_SQL}),
l AS (SELECT 'invest' AS list_type, store_id, margin_ratio AS probability FROM s WHERE margin_ratio >= 0.4 AND margin_ratio < 0.5
      UNION ALL SELECT 'monitor', store_id, margin_ratio FROM s WHERE margin_ratio < 0.3)
SELECT * FROM (SELECT list_type, store_id, row_number() OVER (PARTITION BY list_type ORDER BY store_id) AS rank, probability FROM l) WHERE rank <= 20""")
def store_action_lists_classification(r: Retail):
    return M.store_action_lists_classification(_scored_stores(r))


@register("store_uplift_trainer", survey_id="M11", digits={"uplift_monthly": UNIT},
          sql=f"""WITH s AS ({SF_SQL}),
q AS (SELECT quantile_cont(margin_ratio, 0.2) AS a, quantile_cont(margin_ratio, 0.5) AS m FROM s)
SELECT count_if(margin_ratio < a) AS n_bottom,
  greatest(0.0, m - coalesce(avg(CASE WHEN margin_ratio < a THEN margin_ratio END), 0.0))
    * avg(avg_monthly_revenue) * count_if(margin_ratio < a) AS uplift_monthly FROM s, q GROUP BY a, m""")
def store_uplift_trainer(r: Retail):
    return M.store_uplift_trainer(_scored_stores(r))


@register("linear_attribution", survey_id="M13", digits={"mean_abs_shap": STAT})
def linear_attribution(r: Retail):
    data = _cut(_store_data(r).where(F.col("margin_ratio").isNotNull()), "stores")
    model = M.fit_regressor(data, STORE_NUMERIC, "margin_ratio", "ridge")
    return M.linear_attribution(model, data, STORE_NUMERIC)


@register("model_roundtrip", survey_id="M14")
def model_roundtrip(r: Retail):
    """Save the fitted churn pipeline to shared storage, load it back and
    count identical scores."""
    from pyspark.ml import PipelineModel
    from ..sources.sinks import shared_root
    data = _cut(_churn_data(r), "churn")
    model = M.fit_classifier(data, NUMERIC, ["tier"], "logistic")
    path = shared_root(r.transactions.sparkSession, "model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    a = M.churn_scores(model, data).select("customer_id", F.col("churn_probability").alias("p1"))
    b = M.churn_scores(loaded, data).select("customer_id", F.col("churn_probability").alias("p2"))
    return a.join(b, "customer_id").agg(F.count(F.lit(1)).alias("n_scored"),
                                        F.count_if(F.col("p1") == F.col("p2")).alias("n_identical"))


@register("churn_model_comparison", survey_id="M2,M4", digits=dict(METRIC_DIGITS, mean_auc=STAT, std_auc=STAT))
def churn_model_comparison(r: Retail):
    """Logistic, random forest and boosted trees on a stratified 80/20 split: cross-validated on the training rows, judged on
    the others, the best by test AUC flagged."""
    train, test = _churn_split(r)
    return M.model_comparison(train, test, NUMERIC, ["tier"], "customer_id", keep=_cut)
