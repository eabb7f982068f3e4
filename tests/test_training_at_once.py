"""Steps of the model comparison that are done once: growing a set where its rows are, preparing features, splitting."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from shelfscope.operators import boosting as B
from shelfscope.operators import models as M


class AsIs:
    def transform(self, df):
        return df


def _rows(spark, n=400):
    rnd = random.Random(4)
    rows = [(i, float(rnd.randint(0, 12)), rnd.randint(0, 20) / 4, float(rnd.randint(0, 1)), 0.5 + rnd.random()) for i in range(n)]
    rows = [(*r, float(rnd.random() < (0.2 + 0.05 * r[1] * r[3]))) for r in rows]
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(
        spark.createDataFrame(rows, "id long, a double, b double, c double, w double, label double"))


def test_sets_grown_where_they_are_equal_those_grown_by_levels(spark, monkeypatch):
    """With drawn rows; and the jobs do not grow with the rounds (a job a level and round before)."""
    df = _rows(spark).cache()
    sc = spark.sparkContext

    def grown(rounds, group):
        est = GBTClassifier(labelCol="label", weightCol="w", maxIter=rounds, maxDepth=4, stepSize=0.3, subsamplingRate=0.8, seed=1)
        models = [B.Boosted(AsIs(), est, s, "label", "w") for s in (df.where("id % 3 <> 0"), df)]
        sc.setJobGroup(group, "")
        B.grow_together(models, "id", lambda d, name: d)
        sc.setLocalProperty("spark.jobGroup.id", None)
        return [m.trees for m in models], len(sc.statusTracker().getJobIdsForGroup(group))
    few, jobs_few = grown(2, "few")
    once, jobs = grown(12, "many")
    assert jobs <= jobs_few + 2
    monkeypatch.setattr(B, "ROWS_A_SET", 0)
    levels, jobs_by_level = grown(12, "levels")
    assert jobs_by_level >= 12 * 4
    for a, b in zip(once, levels):
        assert (a[0] == b[0]).all() and (a[1] == b[1]).all() and np.abs(a[2] - b[2]).max() < 1e-9


def test_candidates_share_the_preparation(spark, monkeypatch):
    """Fills, scaling and weights are fitted once a training set, and the models are those of fits of their own."""
    rnd = random.Random(2)
    rows = [(i, None if i % 17 == 0 else rnd.gauss(0, 1), rnd.choice(["x", "y", None]), float(rnd.random() < 0.3)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, t string, label double")
    made = []
    real = M.with_balanced_weights

    def counting(*args):
        made.append(1)
        return real(*args)
    own = {r.id: r.churn_probability for r in M.churn_scores(M.fit_classifier(df, ["a"], ["t"], "logistic"), df).collect()}
    monkeypatch.setattr(M, "with_balanced_weights", counting)
    prepared = M.prepare_features(df, ["a"], ["t"], "id", "label")
    shared = M.fit_classifier(df, ["a"], ["t"], "logistic", prepared=lambda: prepared)
    got = {r.id: r.churn_probability for r in M.churn_scores(shared, df).collect()}
    assert set(got) == set(own) and max(abs(got[k] - own[k]) for k in own) < 1e-6
    fits = M._fold_fits(df.withColumn("_fold", (F.col("id") % 2).cast("int")), ("logistic", "gbt"), 2, lambda rows, kind, prepared: prepared(),
                        {k: M._once(lambda k=k: made.append(k)) for k in (0, 1, None)})
    M.fit_side_by_side(fits)
    assert len(fits) == 6 and made[0] == 1 and sorted(map(str, made[1:])) == ["0", "1", "None"]  # once a set for both candidates


def test_split_is_computed_once(spark):
    kept = []

    def keep(df, name):
        kept.append(name)
        return df.cache()
    df = spark.range(100).select(F.col("id"), (F.col("id") % 4 == 0).cast("double").alias("label"))
    train, test = M.hash_split(df, "id", label="label", keep=keep)
    assert kept == ["split"] and (train.count(), test.count()) == (80, 20)
    a, b = M.hash_split(df, "id", label="label")
    assert {r.id for r in a.collect()} == {r.id for r in train.collect()} and b.count() == 20
    assert test.where("label = 1").count() == pytest.approx(5)
