import random

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from shelfscope.operators import boosting as B
from shelfscope.operators import models as M


def _rows(spark, n=400):
    """Few values a feature, so that the bins of both trainers are all values."""
    rnd = random.Random(4)
    rows = []
    for i in range(n):
        a, b, c = rnd.randint(0, 12), rnd.randint(0, 20) / 4, float(rnd.randint(0, 1))
        rows.append((i, float(a), b, c, float(rnd.random() < (0.2 + 0.05 * a * c)), a * b - 3 * c + rnd.random(), 0.5 + rnd.random()))
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label double, y double, w double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


class AsIs:
    def transform(self, df):
        return df


@pytest.mark.parametrize("kind", ["classifier", "regressor"])
def test_trees_of_two_sets_are_those_of_spark_ml(spark, kind, monkeypatch):
    """Every row drawn: the predictions of each set's booster are those of Spark ML's fit on that set alone."""
    df = _rows(spark).cache()
    sets = [df.where("id % 5 <> 0").cache(), df]
    if kind == "classifier":
        est, label, weight = GBTClassifier(labelCol="label", weightCol="w", maxIter=8, maxDepth=4, stepSize=0.3, seed=1), "label", "w"
        out = F.element_at(M.vector_to_array("probability"), 2)
    else:
        est, label, weight = GBTRegressor(labelCol="y", maxIter=8, maxDepth=4, stepSize=0.3, seed=1), "y", None
        out = F.col("prediction")
        monkeypatch.setattr(B, "ROWS_A_TASK", 100)  # several tasks, summed on the executors first
        monkeypatch.setattr(B, "PARTS_SUMMED_AT_ONCE", 2)
    models = [B.Boosted(AsIs(), est, s, label, weight) for s in sets]
    B.grow_together([*models, object()], "id", lambda d, name: d)
    for m, s in zip(models, sets):
        want = {r[0]: r[1] for r in est.fit(s).transform(df).select("id", out).collect()}
        got = {r[0]: r[1] for r in m.transform(df).select("id", out).collect()}
        assert len(got) == 400 and max(abs(got[k] - want[k]) for k in want) < 1e-6


def test_sets_share_their_jobs(spark):
    """A round of six boosters is one job of one stage a level, however many sets there are."""
    df = _rows(spark, 120).cache()
    sc = spark.sparkContext

    def jobs(rounds):
        est = GBTClassifier(labelCol="label", weightCol="w", maxIter=rounds, maxDepth=2, subsamplingRate=0.8, seed=1)
        models = [B.Boosted(AsIs(), est, df.where(F.col("id") % 6 != i), "label", "w") for i in range(6)]
        sc.setJobGroup(f"boost-{rounds}", "")
        B.grow_together(models, "id", lambda d, name: d)
        assert all(part.shape == (rounds, 7) for m in models for part in m.trees)
        return len(sc.statusTracker().getJobIdsForGroup(f"boost-{rounds}"))
    try:
        assert jobs(30) - jobs(2) < 28 * 2 * 2  # 56 for the levels and a few to prepare; six fits of their own need 336 for the levels
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_draw_is_the_rate_and_repeats():
    import numpy as np
    row = np.random.default_rng(1).integers(0, 2 ** 63, 20000).astype(np.uint64)
    drawn = [B._drawn(row, turn, 0.8) for turn in range(3)]
    assert all(abs(d.mean() - 0.8) < 0.02 for d in drawn) and (drawn[0] == B._drawn(row, 0, 0.8)).all()
    assert abs((drawn[0] & drawn[1]).mean() - 0.64) < 0.02
