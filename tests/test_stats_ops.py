"""Tiny hand-checked frames for trend, inference, mix and describe operators."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfscope.functions import ranks
from shelfscope.operators import describe as D
from shelfscope.operators import inference as J
from shelfscope.operators import mix as N
from shelfscope.operators import segment as K
from shelfscope.operators import trend as T


def _series(spark, values, start=(2022, 1)):
    y, m = start
    rows = []
    for v in values:
        rows.append((dt.date(y, m, 1), float(v)))
        m += 1
        if m == 13:
            y, m = y + 1, 1
    return spark.createDataFrame(rows, "period date, value double")


def test_ols_trend_exact_line(spark):
    r = T.ols_trend(_series(spark, [3 + 2 * i for i in range(10)])).first()
    assert r["slope"] == pytest.approx(2.0) and r["intercept"] == pytest.approx(3.0)
    assert r["r_squared"] == pytest.approx(1.0)
    assert r["pct_change"] == pytest.approx((21 - 3) / 3 * 100)


def test_trend_edge_cases(spark):
    r = T.ols_trend(_series(spark, [0, 5, 5])).first()
    assert r["pct_change"] == 0.0  # first value 0
    c = T.ols_trend(_series(spark, [4] * 6)).first()
    assert c["slope"] == pytest.approx(0.0)
    assert T.seasonal_peaks(_series(spark, range(11))).first()["peak_month"] is None


def test_seasonal_peaks(spark):
    vals = [10 + (5 if i % 12 == 6 else 0) - (3 if i % 12 == 1 else 0) for i in range(24)]
    r = T.seasonal_peaks(_series(spark, vals)).first()
    assert (r["peak_month"], r["trough_month"]) == (7, 2)


def test_welch_matches_hand_computation(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 6.0, 8.0, 10.0]
    df = spark.createDataFrame([("a", x) for x in a] + [("b", x) for x in b], "g string, v double")
    r = J.welch(J.two_group_stats(df, "g", "v", "a", "b")).first()
    va, vb = np.var(a, ddof=1), np.var(b, ddof=1)
    se = np.sqrt(va / 4 + vb / 5)
    assert r["t_stat"] == pytest.approx((np.mean(a) - np.mean(b)) / se)
    dfw = (va / 4 + vb / 5) ** 2 / ((va / 4) ** 2 / 3 + (vb / 5) ** 2 / 4)
    assert r["df"] == pytest.approx(dfw)
    pooled = np.sqrt((3 * va + 4 * vb) / 7)
    assert r["cohens_d"] == pytest.approx((np.mean(a) - np.mean(b)) / pooled)


def test_zero_variance_groups_give_null_statistics(spark):
    df = spark.createDataFrame([("a", 1.0)] * 5 + [("b", 1.0)] * 5, "g string, v double")
    r = J.welch(J.two_group_stats(df, "g", "v", "a", "b")).first()
    assert r["t_stat"] is None and r["se"] is None and r["cohens_d"] == 0.0


def test_anova_matches_hand_computation(spark):
    groups = {"x": [1.0, 2.0, 3.0], "y": [4.0, 5.0, 6.0, 7.0], "z": [1.0, 1.0]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    r = J.anova_oneway(df, "g", "v").first()
    allv = np.concatenate([np.array(v) for v in groups.values()])
    ssb = sum(len(v) * (np.mean(v) - allv.mean()) ** 2 for v in groups.values())
    ssw = sum(((np.array(v) - np.mean(v)) ** 2).sum() for v in groups.values())
    assert r["f_stat"] == pytest.approx((ssb / 2) / (ssw / 6))
    assert r["eta_squared"] == pytest.approx(ssb / (ssb + ssw))


def test_mann_whitney_u_equals_pair_count(spark):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 8, 30).astype(float), rng.integers(2, 10, 25).astype(float)
    df = spark.createDataFrame([(float(x), True) for x in a] + [(float(x), False) for x in b], "v double, g boolean")
    r = J.mann_whitney(df, "v", "g").first()
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    assert r["u_stat"] == pytest.approx(u)
    assert r["median1"] == pytest.approx(np.median(a)) and r["median2"] == pytest.approx(np.median(b))


def test_adstock_exact_vector(spark):
    rows = [(dt.date(2024, 1, i + 1), float(x)) for i, x in enumerate([100, 0, 0, 0, 100])]
    df = spark.createDataFrame(rows, "period date, spend double").selectExpr("'tv' AS channel", "*")
    out = [r["adstock"] for r in N.adstock(df, ["channel"], "period", "spend", 0.5).orderBy("period").collect()]
    assert out == pytest.approx([100, 50, 25, 12.5, 106.25])


def test_ridge_matches_numpy_and_contributions_sum(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(0, 10, (24, 3))
    y = 5 + x @ np.array([1.0, 2.0, -0.5]) + rng.normal(0, 0.1, 24)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(revenue=y)
    coef = N.mmm_fit(spark.createDataFrame(pdf), ["a", "b", "c"], alpha=1.0)
    got = {r["channel"]: r["beta"] for r in coef.collect()}
    zx = (x - x.mean(0)) / x.std(0)
    zy = (y - y.mean()) / y.std()
    beta = np.linalg.solve(zx.T @ zx + np.eye(3), zx.T @ zy)
    assert [got[c] for c in "abc"] == pytest.approx(list(beta), rel=1e-9)
    shares = [r["contribution_pct"] for r in N.mmm_contributions(coef).collect()]
    assert sum(shares) == pytest.approx(100.0)


def test_top_k_share_and_histogram(spark):
    vals = [5.0, 5.0, 5.0, 1.0, 2.0, 9.0, 0.5, 3.0, 3.0, 7.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k long, v double")
    r = ranks.top_k_sum(df, "v", 0.2).first()
    assert r["k"] == 2 and r["top_sum"] == pytest.approx(16.0)
    h = {x["bin"]: x["count"] for x in D.histogram(df, "v", 4).collect()}
    counts, _ = np.histogram(vals, bins=4)
    assert [h.get(i, 0) for i in range(4)] == list(counts)


def test_spearman_matches_rank_correlation(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"x": rng.integers(0, 5, 80).astype(float), "y": rng.normal(size=80).round(1)})
    r = D.spearman(spark.createDataFrame(pdf), "x", "y").first()
    assert r["r"] == pytest.approx(pdf.x.rank().corr(pdf.y.rank()), rel=1e-9)


def test_rfm_labels_first_match_wins(spark):
    rows = [(5, 5, 5, "Champions"), (4, 4, 4, "Loyal Customers"), (4, 2, 2, "Potential Loyalists"),
            (4, 1, 1, "Recent Customers"), (2, 4, 3, "At Risk"), (1, 2, 5, "Lost"),
            (3, 3, 3, "Promising"), (2, 3, 1, "Needs Attention")]
    df = spark.createDataFrame(rows, "recency_score int, frequency_score int, monetary_score int, want string")
    for r in K.rfm_segments(df).collect():
        assert r["segment_label"] == r["want"]


def test_segment_shares_sum_to_100(spark):
    ent = spark.createDataFrame([(1, "A", 100.0, 30.0), (2, "A", 50.0, 5.0), (3, "B", 80.0, 20.0),
                                 (4, None, 10.0, 1.0)], "store_id long, cluster string, revenue double, profit double")
    prof = K.segment_profile(ent, "cluster", "store", "store_id").collect()
    assert len(prof) == 2  # NULL segment dropped, but counted in the totals
    assert sum(r["revenue_share_pct"] for r in prof) == pytest.approx(230 / 240 * 100)


def test_spark_ridge_matches_sklearn_form(spark):
    from shelfscope.operators import models as M
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 3))
    y = x @ [1.0, -2.0, 0.5] + rng.normal(0, .3, 60) + 4
    pdf = pd.DataFrame(x, columns=list("abc")).assign(y=y)
    m = M.fit_regressor(spark.createDataFrame(pdf), list("abc"), "y", "ridge", alpha=1.0)
    z = (x - x.mean(0)) / x.std(0, ddof=1)  # StandardScaler: sample std
    zc, yc = z - z.mean(0), y - y.mean()
    beta = np.linalg.solve(zc.T @ zc + np.eye(3), zc.T @ yc)
    assert list(m.stages[-1].coefficients.toArray()) == pytest.approx(list(beta), rel=1e-6)


def test_classification_metrics_auc_equals_pair_count(spark):
    from shelfscope.operators import models as M
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 120)
    s = np.round(rng.uniform(size=120) + 0.3 * y, 1)
    r = M.classification_metrics(spark.createDataFrame(pd.DataFrame({"y": y, "s": s})), "y", "s").first()
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert r["auc_roc"] == pytest.approx(auc)


def test_product_elasticity_ridge_matches_numpy(spark):
    from shelfscope.operators import elasticity as E
    rng = np.random.default_rng(5)
    rows = []
    for pid, brand in ((1, 0), (2, 1), (3, 0), (4, 1)):
        p = rng.uniform(5, 50, 40)
        q = np.maximum(1, np.round(np.exp(4 - (1.5 + 0.5 * brand) * np.log(p) + rng.normal(0, .1, 40))))
        rows += [(pid, "C", float(x), float(y), brand) for x, y in zip(p, q)]
    pdf = pd.DataFrame(rows, columns=["product_id", "category", "unit_price", "quantity", "is_private_label"])
    out = {r["product_id"]: r["elasticity"] for r in E.product_elasticity(spark.createDataFrame(pdf)).collect()}
    lp, lq, b = np.log(pdf.unit_price), np.log(pdf.quantity), pdf.is_private_label.astype(float)
    x = np.column_stack([lp, b, lp * b])
    xc, yc = x - x.mean(0), lq - lq.mean()
    beta = np.linalg.solve(xc.T @ xc + 0.01 * np.eye(3), xc.T @ yc)
    for pid, brand in ((1, 0), (2, 1)):
        assert out[pid] == pytest.approx(beta[0] + beta[2] * brand, rel=1e-9)


def test_mmm_predict_metrics_match_numpy(spark):
    rng = np.random.default_rng(8)
    x = rng.uniform(0, 10, (30, 2))
    y = 3 + x @ np.array([2.0, 0.5]) + rng.normal(0, 1, 30)
    pdf = pd.DataFrame(x, columns=["a", "b"]).assign(revenue=y)
    df = spark.createDataFrame(pdf)
    coef = N.mmm_fit(df, ["a", "b"], alpha=1.0)
    got = N.mmm_predict(df, coef, ["a", "b"]).first()
    zx = (x - x.mean(0)) / x.std(0)
    zy = (y - y.mean()) / y.std()
    beta = np.linalg.solve(zx.T @ zx + np.eye(2), zx.T @ zy)
    pred = y.mean() + y.std() * zx @ beta
    err = y - pred
    assert got["rmse"] == pytest.approx(np.sqrt(np.mean(err ** 2)))
    assert got["r_squared"] == pytest.approx(1 - np.sum(err ** 2) / np.sum((y - y.mean()) ** 2))


def test_ab_inference_ci_and_power_by_hand(spark):
    from statistics import NormalDist
    from shelfscope.functions import pvalues as pv
    a, b = [3.0, 4.0, 5.0, 6.0, 7.0, 8.0], [1.0, 2.0, 2.5, 3.0, 4.0]
    df = spark.createDataFrame([("t", x) for x in a] + [("c", x) for x in b], "g string, v double")
    w = J.welch(J.two_group_stats(df, "g", "v", "t", "c")).withColumn(
        "power_effect", F.abs(F.col("mean1") - F.col("mean2")) / F.sqrt((F.col("var1") + F.col("var2")) / 2))
    r = J.with_ab_inference(w).first()
    va, vb = np.var(a, ddof=1), np.var(b, ddof=1)
    se = np.sqrt(va / 6 + vb / 5)
    dfw = (va / 6 + vb / 5) ** 2 / ((va / 6) ** 2 / 5 + (vb / 5) ** 2 / 4)
    tc = pv.t_ppf(0.975, dfw)
    diff = np.mean(a) - np.mean(b)
    assert (r["ci_low"], r["ci_high"]) == pytest.approx((diff - tc * se, diff + tc * se))
    d = abs(diff) / np.sqrt((va + vb) / 2)
    nh = 2 / (1 / 6 + 1 / 5)
    z = NormalDist().inv_cdf(0.975)
    assert r["power"] == pytest.approx(1 - NormalDist().cdf(z - d * np.sqrt(nh / 2)))
    assert r["p_value"] == pytest.approx(pv.t_two_sided(diff / se, dfw))


def test_outlier_rows_beyond_three_iqr(spark):
    vals = [10.0, 11, 12, 12, 13, 14, 15, 100.0, -80.0]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "k long, v double")
    out = {r["k"]: r["side"] for r in D.outlier_rows(df, "k", "v").collect()}
    q1, q3 = np.quantile(vals, [0.25, 0.75])
    exp = {i: ("high" if v > q3 + 3 * (q3 - q1) else "low") for i, v in enumerate(vals)
           if v > q3 + 3 * (q3 - q1) or v < q1 - 3 * (q3 - q1)}
    assert out == exp == {7: "high", 8: "low"}


def test_mix_design_decays_across_missing_days(spark):
    """Pivot, zero fill, then adstock: a day without spend of a channel still decays; ROI uses the design mean."""
    import datetime as dt
    day = [dt.date(2024, 1, k) for k in range(1, 6)]
    spend = spark.createDataFrame([("s", day[0], "a", 100.0), ("s", day[1], "b", 10.0), ("s", day[2], "a", 8.0), ("s", day[3], "b", 1.0), ("s", day[4], "a", 4.0)],
                                  "segment string, period date, channel string, spend double")
    rev = spark.createDataFrame([("s", d, float(k)) for k, d in enumerate(day, 1)], "segment string, period date, revenue double")
    wide = N.spend_pivot(spend, rev, ["a", "b"], group=["segment"])
    got = N.adstock_design(wide, ["a", "b"], {"a": 0.5, "b": 0.1}, group=["segment"]).orderBy("period").collect()
    assert [r.a for r in got] == [100.0, 50.0, 33.0, 16.5, 12.25]
    assert [round(r.b, 6) for r in got] == [0.0, 10.0, 1.0, 1.1, 0.11]
    coef = spark.createDataFrame([("s", "a", -0.5, 42.0, 3.0)], "segment string, channel string, beta double, x_mean double, y_std double")
    total = spark.createDataFrame([("s", "a", 112.0)], "segment string, channel string, total_spend double")
    assert N.mmm_roi(coef, total, 2, ["segment"]).first().roi == pytest.approx(0.5 * 42 * 3 * 2 / 112)
    assert N.spend_pivot(spend, rev.limit(3), ["a", "b"], group=["segment"]).count() == 0  # fewer than four aligned days


def test_product_elasticity_own_rows_and_clipping(spark):
    from shelfscope.operators import elasticity as E
    rng = np.random.default_rng(3)
    n = 240
    pdf = pd.DataFrame({"product_id": np.arange(n) % 12, "category": "c", "is_private_label": (np.arange(n) % 12 < 4).astype(int),
                        "unit_price": np.exp(rng.normal(1, 0.3, n)), "quantity": np.exp(rng.normal(2, 0.4, n))})
    pdf.loc[0, "unit_price"], pdf.loc[1, "quantity"] = -3.0, 0.0
    lp, lq = np.log(pdf.unit_price.clip(lower=0.01)), np.log(pdf.quantity.clip(lower=0.001))
    x = np.column_stack([lp, pdf.is_private_label, lp * pdf.is_private_label])
    xc, yc = x - x.mean(0), lq - lq.mean()
    beta = np.linalg.solve(xc.T @ xc + 0.01 * np.eye(3), xc.T @ yc)
    fit = lq.mean() + xc @ beta
    got = {r.product_id: r for r in E.product_elasticity(spark.createDataFrame(pdf)).collect()}
    assert len(got) == 12
    for k, r in got.items():
        m = pdf.product_id == k
        e = beta[0] + beta[2] * pdf.is_private_label[m].iloc[0]
        se = lq[m].std() / (lp[m].std() * np.sqrt(m.sum()))
        r2 = 1 - ((lq[m] - fit[m]) ** 2).sum() / ((lq[m] - lq[m].mean()) ** 2).sum()
        assert (r.elasticity, r.ci_low, r.ci_high, r.r_squared) == pytest.approx((e, e - 1.96 * se, e + 1.96 * se, r2), rel=1e-6)
        assert r.avg_quantity == pytest.approx(pdf.quantity[m].mean())


def test_stratified_split_and_average_precision(spark):
    from shelfscope.operators import models as M
    df = spark.createDataFrame([(k, float(k % 5 == 0), float((k * 37 % 100)) / 100) for k in range(200)], "k long, y double, p double")
    train, test = M.hash_split(df, "k", 0.2, label="y")
    assert {(r.y, r["count"]) for r in test.groupBy("y").count().collect()} == {(1.0, 8), (0.0, 32)}
    assert train.count() == 160 and train.join(test, "k").count() == 0
    rows = sorted(((r.p, r.y) for r in df.collect()), reverse=True)
    ap, tp = 0.0, 0
    for at in range(0, 200, 2):  # every score occurs twice
        got = sum(y for _, y in rows[at:at + 2])
        tp += got
        ap += got / 40 * tp / (at + 2)
    assert M.classification_metrics(df, "y", "p").first().average_precision == pytest.approx(ap)


def test_planted_signal_is_learnt_and_fills_are_fitted(spark):
    from shelfscope.operators import models as M
    rng = np.random.default_rng(5)
    rows = [(k, float(x), None if k % 9 == 0 else "ab"[k % 2], float(x + 0.3 * rng.normal() > 0)) for k, x in enumerate(rng.normal(size=300))]
    df = spark.createDataFrame(rows, "k long, x double, c string, label double")
    train, test = M.hash_split(df, "k", 0.3, label="label")
    model = M.fit_classifier(train, ["x"], ["c"], "logistic")
    assert M.classification_metrics(M.churn_scores(model, test), "label", "churn_probability").first().auc_roc > 0.9
    one = test.where("c is null").limit(1)  # scored alone, the fill is still the training rows'
    assert M.churn_scores(model, one).first()["c__fill"] == M.most_frequent(train, ["c"])["c"]


def test_adstock_over_many_blocks_without_python(spark):
    rng = np.random.default_rng(5)
    x = rng.gamma(1.0, 50.0, size=150)
    x[40:75] = 0
    rows = [(k, p, float(v) if v else None) for k in ("a", None) for p, v in enumerate(x)]
    df = spark.createDataFrame(rows, "series string, period int, spend double").repartition(3)
    for lam in (0.0, 0.1, 0.97):
        out = N.adstock(df, ["series"], "period", "spend", lam)
        assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
        want, last = [], 0.0
        for v in x:
            last = v + lam * last
            want.append(last)
        got = out.collect()
        for key in ("a", None):
            assert [r.adstock for r in sorted((r for r in got if r.series == key), key=lambda r: r.period)] == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_mix_fit_runs_without_python_and_takes_constant_channels(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(50, 9, size=(80, 3))
    x[:, 1] = 4.0
    y = x @ [2.0, 1.0, -0.5] + rng.normal(size=80)
    df = spark.createDataFrame([("s", *map(float, r), float(t)) for r, t in zip(x, y)] + [("flat", float(k), 1.0, 2.0, 7.0) for k in range(9)],
                               "segment string, a double, b double, c double, revenue double")
    fit = N.mmm_fit(df, ["a", "b", "c"], group=["segment"])
    assert "Python" not in fit._jdf.queryExecution().executedPlan().toString()
    got = {(r.segment, r.channel): r for r in fit.collect()}
    z = np.where(x.std(0) > 0, (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1), 0)
    t = (y - y.mean()) / y.std()
    beta = np.linalg.solve(z.T @ z + np.eye(3), z.T @ t)
    assert [got["s", c].beta for c in "abc"] == pytest.approx(beta.tolist(), abs=1e-10) and got["s", "b"].beta == 0
    assert got["s", "a"].r_squared == pytest.approx(1 - ((t - z @ beta) ** 2).sum() / (t ** 2).sum())
    assert [got["flat", c].beta for c in "abc"] == [0, 0, 0] and np.isnan(got["flat", "a"].r_squared)
