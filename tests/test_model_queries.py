import inspect
from types import SimpleNamespace

from shelfscope.operators import models as M
from shelfscope.plans import q_models as Q


def test_registered_comparisons_use_the_whole_job(spark, monkeypatch):
    """All three candidates, 5 folds and 300 rounds reach the trainers (which stand-ins replace here)."""
    data = spark.createDataFrame([(1, 0.5, 1.0, 0.4)], "store_id long, margin_ratio double, label_cls double, prediction double")
    seen = []

    def record(name, result):
        signature = inspect.signature(getattr(M, name))

        def stand_in(*args, **kwargs):
            bound = signature.bind(*args, **kwargs)
            bound.apply_defaults()
            seen.append((name, bound.arguments))
            return result
        monkeypatch.setattr(M, name, stand_in)

    monkeypatch.setattr(Q, "_cut", lambda df, name: df)
    monkeypatch.setattr(Q, "_store_data", lambda r: data)
    monkeypatch.setattr(Q, "_churn_split", lambda r: (data, data))
    monkeypatch.setattr(M, "hash_split", lambda df, *args, **kwargs: (df, df))
    record("model_comparison", data)
    record("regressor_comparison", data)

    Q.churn_model_comparison(None)
    Q.store_classifiers(None)
    Q.store_models(None)
    assert [(n, a["candidates"], a["folds"], a["rounds"]) for n, a in seen] == [
        ("model_comparison", ("logistic", "random_forest", "gbt"), 5, 300)] * 2 + [
        ("regressor_comparison", ("ridge", "random_forest", "gbt"), 5, 300)]


def test_every_fold_and_candidate_is_fitted(spark, monkeypatch):
    """Each candidate is fitted without each fold and on all rows, and scores the fold it has not seen."""
    data = spark.range(60).selectExpr("id AS store_id", "cast(id % 3 = 0 AS double) AS label_cls", "cast(id AS double) AS x")
    seen = []

    class Model:
        def __init__(self, rows):
            self.ids = {r.store_id for r in rows.collect()}

        def transform(self, df):
            from pyspark.ml.functions import array_to_vector
            from pyspark.sql import functions as F
            scored = {r.store_id for r in df.collect()}
            seen.append((len(self.ids), len(scored), len(self.ids & scored)))
            p = F.col("label_cls") * 0.5 + 0.2
            return df.withColumn("probability", array_to_vector(F.array(1 - p, p)))
    monkeypatch.setattr(M, "fit_classifier", lambda rows, *a, **k: Model(rows))
    out = M.model_comparison(data, data, ["x"], [], "store_id", "label_cls", candidates=("logistic", "gbt")).collect()
    assert len(out) == 2 and all(r.mean_auc == 1.0 and r.std_auc == 0.0 and r.auc_roc == 1.0 for r in out)
    assert [r.model for r in out if r.is_best] == ["logistic"]
    folds = [s for s in seen if s[0] < 60]
    assert len(folds) == 10 and all(n == 48 and m == 12 and both == 0 for n, m, both in folds)
    assert [s for s in seen if s[0] == 60] == [(60, 60, 60)] * 2


def test_registered_comparison_trains(spark, monkeypatch):
    """store_classifiers and store_models for real on sf0.01, with fewer rounds, folds and trees so that it stays short."""
    from functools import partial

    from pyspark.ml.classification import RandomForestClassifier

    from shelfscope.sources.retail import retail
    monkeypatch.setattr(Q.M, "model_comparison", partial(M.model_comparison, rounds=2, folds=2))
    monkeypatch.setattr(Q.M, "regressor_comparison", partial(M.regressor_comparison, rounds=2, folds=2, candidates=("ridge", "gbt")))
    made = M.churn_classifiers

    def fewer(kind, *args, **kwargs):
        est = made(kind, *args, **kwargs)
        return est.setNumTrees(10) if isinstance(est, RandomForestClassifier) else est
    monkeypatch.setattr(M, "churn_classifiers", fewer)
    r = retail(spark, "/root/testdata/sf0.01")
    rows = {x.model: x for x in Q.store_classifiers(r).collect()}
    assert set(rows) == {"logistic", "random_forest", "gbt"} and sum(x.is_best for x in rows.values()) == 1
    assert all(x.tp + x.fp + x.tn + x.fn == 20 and 0 <= x.mean_auc <= 1 and x.auc_roc > 0.5 for x in rows.values())
    rows = {x.model: x for x in Q.store_models(r).collect()}
    assert set(rows) == {"ridge", "gbt"} and all(x.rmse > 0 and x.mean_r2 <= 1 for x in rows.values())


def test_grouped_auc_counts_pairs(spark):
    import random
    rnd = random.Random(1)
    rows = [(rnd.choice("ab"), float(rnd.random() < 0.4), rnd.randint(0, 6) / 6) for _ in range(200)] + [("c", 1.0, 0.5), ("a", None, 0.5)]
    got = {r.g: r.auc_roc for r in M.grouped_auc(spark.createDataFrame(rows, "g string, y double, s double"), ["g"], "y", "s").collect()}
    for g in "ab":
        pos, neg = ([s for h, y, s in rows if h == g and y == v] for v in (1.0, 0.0))
        want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
        assert abs(got[g] - want) < 1e-12
    assert got["c"] is None
