"""M-family on Spark ML: preprocessing pipeline, churn / store models,
deterministic split, classification and regression metrics, scoring report
and feature importances.  Training runs on executors; nothing but the
fitted model's coefficients reaches the driver."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import (Imputer, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import ranks
from ..functions.expr import div
from .boosting import Boosted, grow_together


def preprocess_stages(numeric: list[str], categorical: list[str], fills: dict[str, str] | None = None) -> list:
    """M1: median imputation + standardisation of numeric columns; most
    frequent fill (``fills``, learnt on the training rows and kept as a stage) + one-hot (unknown levels kept) of categoricals."""
    imp = [f"{c}__imp" for c in numeric]
    stages = [Imputer(inputCols=numeric, outputCols=imp, strategy="median"),
              VectorAssembler(inputCols=imp, outputCol="_num", handleInvalid="keep"),
              StandardScaler(inputCol="_num", outputCol="_num_std", withMean=True, withStd=True)]
    filled, idx, ohe = ([f"{c}__{x}" for c in categorical] for x in ("fill", "idx", "ohe"))
    if categorical:
        def quoted(v):
            return "'" + str(v).replace("'", "''") + "'"
        cols = ", ".join(f"coalesce({c}, {quoted((fills or {}).get(c, ''))}) AS {f}" for c, f in zip(categorical, filled))
        stages += [SQLTransformer(statement=f"SELECT *, {cols} FROM __THIS__"),
                   StringIndexer(inputCols=filled, outputCols=idx, handleInvalid="keep"),
                   OneHotEncoder(inputCols=idx, outputCols=ohe, handleInvalid="keep")]
    stages.append(VectorAssembler(inputCols=["_num_std", *ohe], outputCol="features"))
    return stages


def most_frequent(train: DataFrame, categorical: list[str]) -> dict[str, str]:
    """Most frequent level per categorical of the training rows (smallest on ties): one row."""
    if not categorical:
        return {}
    row = train.agg(*[F.mode(c, True).alias(c) for c in categorical]).first()
    return {c: row[c] for c in categorical if row[c] is not None}


def _as_is(df: DataFrame, name: str) -> DataFrame:
    return df


def hash_split(df: DataFrame, key: str, test_frac: float = 0.2, label: str | None = None, seed: int = 42, keep: Callable = _as_is):
    """M4: deterministic train/test split by the order of a hash of the key; with a label exactly
    ``test_frac`` of each label's rows (rounded half up) are test rows.  Keys are unique.  ``keep(df, name)`` may write and
    reread the rows that both parts are cut from."""
    h = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 31)).cast("double")
    if label is None:
        t = df.withColumn("_is_test", h < test_frac * (1 << 31))
    else:
        hashed = df.withColumn("_h", h)
        order = ranks.first_ranks(hashed, "_h", key, group=[label], out="_rank")
        size = df.groupBy(label).agg(F.floor(F.count(F.lit(1)) * test_frac + 0.5).alias("_n_test"))
        t = (df.join(order.select(key, "_rank"), key).join(size, label)
             .withColumn("_is_test", F.col("_rank") <= F.col("_n_test")).drop("_rank", "_n_test"))
    t = keep(t, "split")
    return t.where(~F.col("_is_test")).drop("_is_test"), t.where(F.col("_is_test")).drop("_is_test")


def seeded_sample(df: DataFrame, key: str, frac: float, seed: int = 42) -> DataFrame:
    """F8: rows whose key's hash (first 32 bits of an MD5 with the seed) falls below the fraction."""
    h = F.conv(F.substring(F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed)))), 1, 8), 16, 10).cast("double")
    return df.where(h < frac * 2.0 ** 32)


def stratified_folds(df: DataFrame, key: str, label: str | None = None, folds: int = 5, seed: int = 7, out: str = "_fold") -> DataFrame:
    """M4: adds the fold number 0..folds-1: the row's place, by a hash of its key, among the rows of its label, modulo the number of
    folds, so that the folds' sizes differ by one row a label at most.  Without a label the hash itself is dealt out.
    Keys are unique; a row without a label gets none."""
    h = F.conv(F.substring(F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed)))), 1, 8), 16, 10).cast("double")
    if label is None:
        return df.withColumn(out, F.pmod(h.cast("long"), F.lit(folds)).cast("int"))
    order = ranks.first_ranks(df.where(F.col(label).isNotNull()).select(key, label, h.alias("_h")), "_h", key, group=[label], out="_rank")
    return df.join(order.select(key, F.pmod(F.col("_rank") - 1, F.lit(folds)).cast("int").alias(out)), key, "left")


def with_balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """sklearn ``class_weight='balanced'``: n / (k · n_class) per row."""
    cnt = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    n = df.agg(F.count(F.lit(1))).scalar()
    k = cnt.agg(F.count(F.lit(1))).scalar()
    return df.join(cnt, label).withColumn("weight", n / (k * F.col("_nc"))).drop("_nc")


GBT_ROUNDS = 300  # boosted trees are sequential; callers may ask for fewer
FOREST_ROWS_A_TASK = 32_768  # a forest's levels are long tasks, so its rows are dealt out finer than files are cut
FITS_AT_ONCE = 8  # a fit is many short jobs in a row, so folds and candidates are fitted side by side


def fit_side_by_side(fits: dict, at_once: int = FITS_AT_ONCE) -> dict:
    """The results of the given functions under their keys; ``at_once`` of them run at a time."""
    inherit = inheritable_thread_target(SparkSession.getActiveSession())
    with ThreadPoolExecutor(at_once) as pool:
        running = {k: pool.submit(inherit(f)) for k, f in fits.items()}
        return {k: r.result() for k, r in running.items()}


def _training_sets(train: DataFrame, folds: int) -> dict:
    """The rows without each fold, and all rows (fold None)."""
    return {k: train.where(F.col("_fold") != k) for k in range(folds)} | {None: train}


def _fold_fits(train: DataFrame, candidates: tuple[str, ...], folds: int, fit: Callable, prepared: dict | None = None) -> dict:
    """Fits of every candidate without each fold, and on all rows (fold None); the longest kind comes first.  ``prepared``
    returns by fold what the candidates share."""
    parts = _training_sets(train, folds)
    kinds = sorted(candidates, key=lambda kind: ("gbt", "random_forest").index(kind) if kind in ("gbt", "random_forest") else 2)
    return {(kind, k): partial(fit, part, kind, **({} if prepared is None else {"prepared": prepared[k]}))
            for kind in kinds for k, part in parts.items()}


def grouped_auc(df: DataFrame, group: list[str], label: str, score: str) -> DataFrame:
    """AUC-ROC per group from average ranks within it (NULL without both labels)."""
    base = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    rk = ranks.average_ranks(base, score, group).withColumnRenamed("v", score)
    pos = base.groupBy(*group, score).agg(F.count_if(F.col(label) == 1).alias("_p"), F.count(F.lit(1)).alias("_n"))
    a = pos.join(rk.select(*group, score, "avg_rank"), [*group, score]).groupBy(*group).agg(
        F.sum(F.col("_p") * F.col("avg_rank")).alias("_r1"), F.sum("_p").alias("_n1"), (F.sum("_n") - F.sum("_p")).alias("_n0"))
    return a.select(*group, F.when((F.col("_n1") > 0) & (F.col("_n0") > 0), (F.col("_r1") - F.col("_n1") * (F.col("_n1") + 1) / 2)
                                   / (F.col("_n1") * F.col("_n0"))).alias("auc_roc"))


def churn_classifiers(kind: str, label: str = "label", n: int = 1, rounds: int = GBT_ROUNDS, min_leaf: int = 20):
    """M2: logistic (C = 1 on n rows of balanced weight, so regParam = 1/n), random forest
    (200 trees, depth 8, min leaf 20), boosted trees (depth 6, step 0.05, subsample 0.8)."""
    if kind == "logistic":
        return LogisticRegression(labelCol=label, weightCol="weight", maxIter=200, regParam=1.0 / max(n, 1), standardization=False)
    if kind == "random_forest":
        return RandomForestClassifier(labelCol=label, weightCol="weight", numTrees=200, maxDepth=8,
                                      minInstancesPerNode=min_leaf, seed=42)
    if kind == "gbt":
        return GBTClassifier(labelCol=label, weightCol="weight", maxIter=rounds, maxDepth=6, stepSize=0.05,
                             subsamplingRate=0.8, seed=42)
    raise ValueError(kind)


def _once(make: Callable) -> Callable:
    """A function that makes its value when it is first asked for, whichever thread asks."""
    lock, made = Lock(), []

    def value():
        with lock:
            if not made:
                made.append(make())
        return made[0]
    return value


def prepare_features(train: DataFrame, numeric: list[str], categorical: list[str], key: str, label: str, keep: Callable = _as_is):
    """What the classifiers of a training set share: the fitted preprocessing and the rows it made (key, label, weight, features)."""
    weighted = keep(with_balanced_weights(train, label).select(key, label, "weight", *numeric, *categorical), "weighted")
    model = Pipeline(stages=preprocess_stages(numeric, categorical, most_frequent(train, categorical))).fit(weighted)
    return model, keep(model.transform(weighted).select(key, label, "weight", "features"), "prepared")


def fit_classifier(train: DataFrame, numeric: list[str], categorical: list[str], kind: str, label: str = "label",
                   rounds: int = GBT_ROUNDS, min_leaf: int = 20, together: bool = False, prepared: Callable | None = None):
    """``together`` leaves boosted trees to ``grow_together``, for all folds at once; ``prepared`` returns the set's
    ``prepare_features``, which else are fitted here."""
    n = train.count()
    est = churn_classifiers(kind, label, n, rounds, min_leaf)
    if prepared is not None:
        ready, rows = prepared()
        if together and kind == "gbt":
            return Boosted(ready, est, train, label, "weight", rows)
        if kind == "random_forest" and n > FOREST_ROWS_A_TASK:
            rows = rows.repartition(-(-n // FOREST_ROWS_A_TASK))
        return PipelineModel([*ready.stages, est.fit(rows)])
    stages, weighted = preprocess_stages(numeric, categorical, most_frequent(train, categorical)), with_balanced_weights(train, label)
    if together and kind == "gbt":
        return Boosted(Pipeline(stages=stages).fit(weighted), est, weighted, label, "weight")
    return Pipeline(stages=stages + [est]).fit(weighted)


def churn_scores(model, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """M7: probability of the positive class and the flag at ``threshold``."""
    out = model.transform(df)
    p = vector_to_array("probability")[1]
    return out.withColumn("churn_probability", p).withColumn(
        "churn_flag", (F.col("churn_probability") >= threshold).cast("int"))


def average_precision(df: DataFrame, label: str, score: str):
    """M5: Σ over distinct scores, from the top, of recall gained × precision there, as a scalar column.
    Ranks are counted by distributed prefix sums over distinct scores."""
    base = df.where(F.col(label).isNotNull() & F.col(score).isNotNull()).select(score, label)
    every = ranks.value_prefix(base, score).select("v", (F.col("n_total") - F.col("cum_before")).alias("_n"))
    pos = ranks.value_prefix(base.where(F.col(label) == 1), score).select(
        "v", "cnt", F.col("n_total").alias("_p"), (F.col("n_total") - F.col("cum_before")).alias("_tp"))
    return pos.join(every, "v").agg(F.sum(F.col("cnt") / F.col("_p") * F.col("_tp") / F.col("_n"))).scalar()


def classification_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """M5: AUC-ROC (= Mann-Whitney U ÷ n1·n0 from distributed average ranks
    of the score), precision, recall, F1, accuracy and confusion counts."""
    base = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    rk = ranks.average_ranks(base, score).select(F.col("v").alias(score), "avg_rank")
    pos = base.groupBy(score).agg(F.count_if(F.col(label) == 1).alias("_p"))
    auc_part = pos.join(rk, score).agg(F.sum(F.col("_p") * F.col("avg_rank")).alias("_r1"))
    pred = (F.col(score) >= threshold).cast("int")
    y = F.col(label).cast("int")
    c = base.agg(F.count_if((pred == 1) & (y == 1)).alias("tp"), F.count_if((pred == 1) & (y == 0)).alias("fp"),
                 F.count_if((pred == 0) & (y == 0)).alias("tn"), F.count_if((pred == 0) & (y == 1)).alias("fn"))
    r1 = auc_part.scalar()
    n1 = F.col("tp") + F.col("fn")
    n0 = F.col("tn") + F.col("fp")
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    rec = F.when(n1 > 0, F.col("tp") / n1).otherwise(0.0)
    return c.select(
        "tp", "fp", "tn", "fn",
        F.when((n1 > 0) & (n0 > 0), (F.lit(r1) - n1 * (n1 + 1) / 2) / (n1 * n0)).alias("auc_roc"),
        prec.alias("precision"), rec.alias("recall"),
        F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0).alias("f1"),
        div(F.col("tp") + F.col("tn"), n1 + n0).alias("accuracy"),
        F.lit(average_precision(base, label, score)).alias("average_precision"))


def r_squared(label: str, pred: str):
    e = F.col(label) - F.col(pred)
    return F.try_subtract(F.lit(1.0), F.try_divide(F.sum(e * e), F.count(F.lit(1)) * F.var_pop(label)))


def regression_aggregates(label: str, pred: str) -> list:
    e = F.col(label) - F.col(pred)
    return [F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), r_squared(label, pred).alias("r_squared"),
            (F.avg(F.when(F.col(label) != 0, F.abs(e / F.col(label)))) * 100).alias("mape")]


def regression_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """M6: RMSE, MAE, R², MAPE over rows with a non-zero label."""
    return df.agg(*regression_aggregates(label, pred))


def churn_report(scores: DataFrame, customers: DataFrame, value_per_churner: float = 850.0,
                 tier: str = "tier") -> DataFrame:
    """M8: n, predicted churners, rate, high-confidence (≥ 0.7) churners and
    revenue at risk; per tier plus an ALL row."""
    s = scores.drop(tier).join(customers.select("customer_id", tier), "customer_id", "left")
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("churn_flag").alias("n_churners"),
            F.count_if(F.col("churn_probability") >= 0.7).alias("n_high_confidence")]
    per = s.groupBy(tier).agg(*aggs)
    allr = s.agg(*aggs).select(F.lit("ALL").alias(tier), "n", "n_churners", "n_high_confidence")
    return per.unionByName(allr).withColumn("churn_rate", div("n_churners", "n")).withColumn(
        "revenue_at_risk", F.col("n_churners") * value_per_churner)


def slot_names(model, numeric: list[str], categorical: list[str]) -> list[str]:
    """Names of the feature vector's slots: numeric columns, then level by level of each categorical."""
    indexers = [st for st in model.stages if hasattr(st, "labelsArray")]
    levels = indexers[0].labelsArray if indexers else []
    return numeric + [f"{c}={v}" for c, vs in zip(categorical, levels) for v in [*vs, "(unknown)"]]


def feature_importance(model, names: list[str], top: int = 10) -> DataFrame:
    """Top feature importances (trees) or |coefficients| (linear)."""
    last = model.stages[-1]
    vals = (last.featureImportances if hasattr(last, "featureImportances") else last.coefficients).toArray().tolist()
    rows = sorted(zip(names, map(abs, vals)), key=lambda t: (-t[1], t[0]))[:top]
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double")


def permutation_importance(model, df: DataFrame, features: list[str], label: str, key: str, seed: int = 7,
                           keep: Callable = _as_is) -> DataFrame:
    """M13 for trees: loss of AUC when one feature's values are dealt out anew among the rows (each row
    gets the value of the row at its place in another hash order).  All hash orders are ranked together, and so are all
    scores: ``keep(df, name)`` may write and reread both."""
    def order(salt):
        h = F.pmod(F.xxhash64(F.col(key), F.lit(salt)), F.lit(1 << 31)).cast("double")
        return df.select(key, F.lit(salt).alias("_salt"), h.alias("_h"))
    orders = reduce(DataFrame.unionByName, [order(seed + i) for i in range(len(features) + 1)])
    places = keep(ranks.first_ranks(orders, "_h", key, out="_rank", group=["_salt"]), "places")

    def place(salt):
        return places.where(F.col("_salt") == salt).drop("_salt")
    scored = [churn_scores(model, df).select(F.lit("").alias("feature"), label, "churn_probability")]
    for i, c in enumerate(features):
        other = place(seed + 1 + i).join(df.select(key, F.col(c).alias("_new")), key).select("_rank", "_new")
        mixed = df.join(place(seed), key).join(other, "_rank").withColumn(c, F.col("_new")).drop("_new", "_rank")
        scored.append(churn_scores(model, mixed).select(F.lit(c).alias("feature"), label, "churn_probability"))
    scores = keep(reduce(DataFrame.unionByName, scored), "mixed-scores")
    aucs = grouped_auc(scores, ["feature"], label, "churn_probability")
    whole = aucs.where(F.col("feature") == "").select("auc_roc").scalar()
    names = df.sparkSession.createDataFrame([(c,) for c in features], "feature string")
    return names.join(aucs, "feature", "left").select("feature", (F.lit(whole) - F.col("auc_roc")).alias("auc_loss"))


def fit_regressor(train: DataFrame, numeric: list[str], label: str, kind: str, alpha: float = 1.0, rounds: int = GBT_ROUNDS,
                  together: bool = False):
    """M3: ridge (unpenalised intercept), random forest (200 trees, depth 8, min leaf 5) or boosted trees on
    standardised numeric features.  ``together`` leaves boosted trees to ``grow_together``, for all folds at once."""
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
    if kind == "ridge":
        # sklearn Ridge(alpha) ≡ Spark regParam = alpha / n · σ_pop(y) without
        # Spark's own standardisation (inputs are already standardised)
        n, sd = train.agg(F.count(label), F.stddev_pop(label)).first()
        est = LinearRegression(labelCol=label, regParam=float(alpha) / max(n, 1) * float(sd or 0.0),
                               elasticNetParam=0.0, standardization=False, solver="normal")
    elif kind == "random_forest":
        est = RandomForestRegressor(labelCol=label, numTrees=200, maxDepth=8, minInstancesPerNode=5, seed=42)
    elif kind == "gbt":
        est = GBTRegressor(labelCol=label, maxIter=rounds, maxDepth=6, stepSize=0.05, subsamplingRate=0.8, seed=42)
    else:
        raise ValueError(kind)
    if together and kind == "gbt":
        return Boosted(Pipeline(stages=preprocess_stages(numeric, [])).fit(train), est, train, label)
    return Pipeline(stages=preprocess_stages(numeric, []) + [est]).fit(train)


def _fit_all(fits: dict, key: str, keep: Callable) -> dict:
    """The models of ``_fold_fits``; boosted trees are grown while the others are fitted."""
    first = fit_side_by_side({k: f for k, f in fits.items() if k[0] == "gbt"})
    rest = fit_side_by_side({"grown": partial(grow_together, first.values(), key, keep)} | {k: f for k, f in fits.items() if k[0] != "gbt"})
    rest.pop("grown")
    return {k: (first if k in first else rest)[k] for k in fits}


def _scored(df: DataFrame, models: dict, label: str, folds: list | None = None) -> DataFrame:
    """(model, _fold, label, churn_probability): every fold scored by the model that has not seen it; fold None is
    scored by the model of all rows."""
    return reduce(DataFrame.unionByName, [
        churn_scores(m, df.where(F.col("_fold") == k if k is not None else F.col("_fold").isNull())).select(F.lit(kind).alias("model"), "_fold", label, "churn_probability")
        for (kind, k), m in models.items() if (k is not None if folds is None else k in folds)])


def cross_validated_auc(train: DataFrame, numeric: list[str], categorical: list[str], key: str, label: str = "label",
                        folds: int = 5, kind: str = "logistic", rounds: int = GBT_ROUNDS, min_leaf: int = 20,
                        keep: Callable = _as_is) -> DataFrame:
    """M4: k-fold cross-validation on the training rows (stratified folds): mean and standard deviation
    of the folds' AUC.  Fills, scaling and the model are fitted anew on each fold's other rows."""
    part = keep(stratified_folds(train, key, label, folds), "folds")
    fits = _fold_fits(part, (kind,), folds, lambda rows, which: fit_classifier(rows, numeric, categorical, which, label, rounds, min_leaf, together=True))
    models = fit_side_by_side({k: f for k, f in fits.items() if k[1] is not None})
    grow_together(models.values(), key, keep)
    return grouped_auc(keep(_scored(part, models, label), "fold-scores"), ["model", "_fold"], label, "churn_probability").agg(
        F.lit(kind).alias("model"), F.count("auc_roc").cast("int").alias("n_folds"), F.avg("auc_roc").alias("mean_auc"),
        F.stddev_pop("auc_roc").alias("std_auc"))


def regressor_comparison(train: DataFrame, test: DataFrame, numeric: list[str], label: str, key: str,
                         candidates: tuple[str, ...] = ("ridge", "random_forest", "gbt"), folds: int = 5, rounds: int = GBT_ROUNDS,
                         keep: Callable = _as_is) -> DataFrame:
    """M3/M4 for regressions: per candidate the metrics on the held-out rows and the mean and standard deviation of the
    folds' R² on the training rows; the best by held-out R² is flagged (ties: first by name)."""
    part = keep(stratified_folds(train, key, None, folds), "folds")
    models = fit_side_by_side(_fold_fits(part, candidates, folds,
                                         lambda rows, kind: fit_regressor(rows, numeric, label, kind, rounds=rounds, together=True)))
    grow_together(models.values(), key, keep)
    scored = keep(reduce(DataFrame.unionByName, [
        m.transform(part.where(F.col("_fold") == k) if k is not None else test.withColumn("_fold", F.lit(None).cast("int")))
        .select(F.lit(kind).alias("model"), "_fold", label, "prediction") for (kind, k), m in models.items()]), "fold-scores")
    by_fold = scored.where("_fold IS NOT NULL").groupBy("model", "_fold").agg(r_squared(label, "prediction").alias("_r2"))
    cv = by_fold.groupBy("model").agg(F.avg("_r2").alias("mean_r2"), F.stddev_pop("_r2").alias("std_r2"))
    held_out = scored.where("_fold IS NULL").groupBy("model").agg(*regression_aggregates(label, "prediction"))
    best = F.row_number().over(Window.orderBy(F.col("r_squared").desc_nulls_last(), "model"))  # a row per candidate
    return held_out.join(cv, "model").withColumn("is_best", best == 1)


def store_report(scores: DataFrame, pred: str = "prediction", revenue: str = "avg_monthly_revenue",
                 low: float = 0.2, high: float = 0.8) -> DataFrame:
    """M9 (regression): p20 / median / p80 of predicted performance, top
    (≥ p80) and bottom (< p20) counts, monitor band [p20, p35), and the annual
    uplift of lifting the bottom stores to the median:
    max(0, median − mean bottom prediction) × their mean revenue × n × 12."""
    q = ranks.quantiles(scores, pred, [low, 0.35, 0.5, high], ["p_low", "p35", "p50", "p_high"]).select(
        F.struct("*")).scalar()
    s = scores.withColumn("_q", q)
    bottom = F.col(pred) < F.col("_q.p_low")
    a = s.agg(F.first("_q.p_low").alias("p20"), F.first("_q.p50").alias("median"), F.first("_q.p_high").alias("p80"),
              F.count_if(F.col(pred) >= F.col("_q.p_high")).alias("n_top"), F.count_if(bottom).alias("n_bottom"),
              F.count_if((F.col(pred) >= F.col("_q.p_low")) & (F.col(pred) < F.col("_q.p35"))).alias("n_monitor"),
              F.avg(F.when(bottom, F.col(pred))).alias("_bm"), F.avg(F.when(bottom, F.col(revenue))).alias("_br"))
    gap = F.greatest(F.lit(0.0), F.col("median") - F.coalesce(F.col("_bm"), F.lit(0.0)))
    return a.select("p20", "median", "p80", "n_top", "n_bottom", "n_monitor",
                    F.coalesce(gap * F.col("_br") * F.col("n_bottom") * 12, F.lit(0.0)).alias("annual_uplift"))


def store_action_lists(scores: DataFrame, key: str = "store_id", pred: str = "prediction",
                       revenue: str = "avg_monthly_revenue", k: int = 20, k_monitor: int | None = None) -> DataFrame:
    """M9 lists: ``invest`` = the k bottom stores (< p20) with the largest
    uplift potential (median − prediction) × revenue; ``monitor`` = all
    stores in [p20, p35), ranked by prediction (the first ``k_monitor`` if given)."""
    q = ranks.quantiles(scores, pred, [0.2, 0.35, 0.5], ["a", "b", "m"]).select(F.struct("*")).scalar()
    s = scores.withColumn("_q", q)
    # top-k via orderBy().limit() (per-partition top-k, then a k-row merge);
    # row numbers are assigned only to the ≤ k survivors
    inv = (s.where(F.col(pred) < F.col("_q.a"))
           .withColumn("uplift_potential", (F.col("_q.m") - F.col(pred)) * F.col(revenue))
           .orderBy(F.col("uplift_potential").desc(), key).limit(k)
           .withColumn("rank", F.row_number().over(Window.orderBy(F.col("uplift_potential").desc(), key)))
           .select(F.lit("invest").alias("list_type"), key, F.col("rank").cast("long").alias("rank"),
                   "uplift_potential"))
    band = s.where((F.col(pred) >= F.col("_q.a")) & (F.col(pred) < F.col("_q.b")))
    mon = band.join(ranks.first_ranks(band, pred, key, out="rank"), key).select(
        F.lit("monitor").alias("list_type"), key, F.col("rank").cast("long").alias("rank"),
        F.lit(None).cast("double").alias("uplift_potential"))
    return inv.unionByName(mon if k_monitor is None else mon.where(F.col("rank") <= k_monitor))


def store_report_classification(scores: DataFrame, proba: str = "probability",
                                revenue: str = "avg_monthly_revenue") -> DataFrame:
    """Predicted top (p ≥ 0.5) / bottom counts, invest band 0.4 ≤ p < 0.5,
    high-risk p < 0.3, uplift = n_bottom × mean monthly revenue × 0.05 × 12."""
    p = F.col(proba)
    a = scores.agg(F.count_if(p >= 0.5).alias("n_top"), F.count_if(p < 0.5).alias("n_bottom"),
                   F.count_if((p >= 0.4) & (p < 0.5)).alias("n_invest"), F.count_if(p < 0.3).alias("n_high_risk"),
                   F.avg(revenue).alias("_r"))
    return a.select("n_top", "n_bottom", "n_invest", "n_high_risk",
                    (F.col("n_bottom") * F.col("_r") * 0.05 * 12).alias("annual_uplift"))


def store_action_lists_classification(scores: DataFrame, key: str = "store_id", proba: str = "probability", k: int = 20) -> DataFrame:
    """M10 lists: ``invest`` = the first k stores by key with 0.4 ≤ p < 0.5, ``monitor`` = the first k with p < 0.3."""
    p = F.col(proba)
    lists = {"invest": (p >= 0.4) & (p < 0.5), "monitor": p < 0.3}
    # top-k by key, numbered after the limit
    return reduce(DataFrame.unionByName, [
        scores.where(chosen).orderBy(key).limit(k).select(
            F.lit(name).alias("list_type"), key, F.row_number().over(Window.orderBy(key)).cast("long").alias("rank"), p.alias("probability"))
        for name, chosen in lists.items()])


def store_uplift_trainer(scores: DataFrame, pred: str = "prediction", revenue: str = "avg_monthly_revenue") -> DataFrame:
    """M11 (trainer variant): max(0, median − mean bottom prediction) × mean
    revenue over all stores × n_bottom (monthly, not annualised)."""
    q = ranks.quantiles(scores, pred, [0.2, 0.5], ["a", "m"]).select(F.struct("*")).scalar()
    s = scores.withColumn("_q", q)
    bottom = F.col(pred) < F.col("_q.a")
    a = s.agg(F.count_if(bottom).alias("n_bottom"), F.avg(F.when(bottom, F.col(pred))).alias("_bm"),
              F.first("_q.m").alias("_m"), F.avg(revenue).alias("_r"))
    gap = F.greatest(F.lit(0.0), F.col("_m") - F.coalesce(F.col("_bm"), F.lit(0.0)))
    return a.select("n_bottom", (gap * F.col("_r") * F.col("n_bottom")).alias("uplift_monthly"))


def linear_attribution(model, df: DataFrame, numeric: list[str]) -> DataFrame:
    """Exact SHAP for a linear model on standardised inputs: mean over
    rows of |β_j · (z_j − mean z_j)| per feature, computed on the executors."""
    lin = model.stages[-1]
    beta = lin.coefficients.toArray().tolist()
    z = model.transform(df).withColumn("_z", vector_to_array("_num_std"))
    means = z.agg(*[F.avg(F.col("_z")[i]).alias(f"m{i}") for i in range(len(numeric))]).select(F.struct("*")).scalar()
    zz = z.withColumn("_m", means)
    out = zz.agg(*[F.avg(F.abs(F.lit(beta[i]) * (F.col("_z")[i] - F.col(f"_m.m{i}")))).alias(c)
                   for i, c in enumerate(numeric)])
    return out.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean_abs_shap"))
                                          for c in numeric])).alias("x")).select("x.*")


def model_comparison(train: DataFrame, test: DataFrame, numeric: list[str], categorical: list[str], key: str,
                     label: str = "label", candidates: tuple[str, ...] = ("logistic", "random_forest", "gbt"),
                     folds: int = 5, rounds: int = GBT_ROUNDS, min_leaf: int = 20, keep: Callable = _as_is) -> DataFrame:
    """M2/M4: per candidate the cross-validated AUC on the training rows (stratified folds) and the metrics on the held-out rows; the
    best by test AUC is flagged (ties: first listed).  ``keep(df, name)`` may write and reread what is read many times."""
    part = keep(stratified_folds(train, key, label, folds), "folds")
    prepared = {k: _once(partial(prepare_features, rows, numeric, categorical, key, label, keep))
                for k, rows in _training_sets(part, folds).items()}
    models = _fit_all(_fold_fits(part, candidates, folds, lambda rows, kind, prepared: fit_classifier(
        rows, numeric, categorical, kind, label, rounds, min_leaf, together=True, prepared=prepared), prepared), key, keep)
    in_folds = keep(_scored(part, models, label), "fold-scores")
    scored = keep(_scored(test.withColumn("_fold", F.lit(None).cast("int")), models, label, [None]), "test-scores")
    cv = grouped_auc(in_folds, ["model", "_fold"], label, "churn_probability").groupBy("model").agg(
        F.avg("auc_roc").alias("mean_auc"), F.stddev_pop("auc_roc").alias("std_auc"))
    rows = []
    for i, kind in enumerate(candidates):
        held_out = scored.where(F.col("model") == kind).select(label, "churn_probability")
        rows.append(classification_metrics(held_out, label, "churn_probability").select(F.lit(kind).alias("model"), F.lit(i).alias("_order"), "*"))
    allm = reduce(DataFrame.unionByName, rows).join(cv, "model")
    best = F.row_number().over(Window.orderBy(F.col("auc_roc").desc_nulls_last(), "_order"))  # a row per candidate
    return allm.withColumn("is_best", best == 1).drop("_order")
