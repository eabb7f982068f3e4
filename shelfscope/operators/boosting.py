"""Boosted trees of several training sets (folds of a cross-validation) grown together.  Sets of more rows than a task
holds (``ROWS_A_SET``) are dealt out: a level of the trees of all sets is one Spark job of one stage over their rows, where fits of
their own would be two stages a set.  Sets that fit a task are grown side by side, a task each: the same sums and
the same cuts, without a job for every level.

The method and its parameters are those of Spark ML's GBTClassifier / GBTRegressor, read from such an estimator: log loss
on labels -1 / 1 or squared error, trees on the residuals by weighted variance, the first tree in full and the others times
the step, at most maxBins bins a feature.  Defined here instead of left to the layout of the rows: bins end at the quantiles
of all rows (all values, where they are few), and a tree's rows are drawn by a hash of the row's key, its set and the round.

Rows stay on the executors, binned, with their prediction; a job returns sums by set, node, feature and bin, whose
number depends on the sets and the depth, never on the rows."""

from __future__ import annotations

import pickle
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ranks

ROWS_A_TASK = 32_768  # small tables take fewer tasks than there are cores: a level is a short job
MOST_ROWS_A_TASK = 1_000_000
ROWS_A_SET = MOST_ROWS_A_TASK  # sets up to this size are grown where their rows are; larger ones take a job a level
PARTS_SUMMED_AT_ONCE = 16  # more partial sums than that are added on the executors first
ROUNDS_A_CHECKPOINT = 25


class Boosted:
    """A fitted preprocessing and the booster behind it, which ``grow_together`` adds; scores like a Spark ML model."""

    def __init__(self, prepared, est, train: DataFrame, label: str, weight: str | None = None, rows: DataFrame | None = None):
        """``rows``: the training rows with their features, if they are made already."""
        self.prepared, self.est, self.train, self.label, self.weight, self.rows = prepared, est, train, label, weight, rows
        self.classifies = "Classifier" in type(est).__name__
        self.trees = None  # feature, threshold, value: (rounds, nodes) each; value times the tree's weight

    def transform(self, df: DataFrame) -> DataFrame:
        trees = df.sparkSession.sparkContext.broadcast(self.trees)

        @F.pandas_udf("double")
        def margin(features: pd.Series) -> pd.Series:
            return pd.Series(_margins(np.array(features.tolist(), dtype=float), *trees.value))
        out = self.prepared.transform(df).withColumn("_margin", margin(vector_to_array("features")))
        if not self.classifies:
            return out.withColumnRenamed("_margin", "prediction")
        p = 1 / (1 + F.exp(-2 * F.col("_margin")))
        return (out.withColumn("probability", array_to_vector(F.array(1 - p, p)))
                .withColumn("prediction", (F.col("_margin") > 0).cast("double")).drop("_margin"))


def _margins(x: np.ndarray, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Sums of the leaves that the rows reach; nodes are places of a heap, feature -1 is a leaf."""
    total, rows = np.zeros(len(x)), np.arange(len(x))
    for f, t, v in zip(feature, threshold, value):
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(len(f).bit_length() - 1):
            at = f[node]
            right = ~(x[rows, at] <= t[node])
            node = np.where(at >= 0, 2 * node + 1 + right, node)
        total += v[node]
    return total


def _edges(rows: DataFrame, fits: int, bins: int) -> list[list[np.ndarray]]:
    """Upper ends of all bins but the last by set and feature: midpoints behind every value where there are at most
    ``bins`` values, else behind those that pass a ``bins``-th of the rows.  At most ``bins`` rows a set and feature are collected."""
    at = ["_fit", "_slot"]
    long = rows.select("_fit", F.posexplode("_x").alias("_slot", "_value")).where(~F.isnan("_value"))
    p = ranks.value_prefix(long, "_value", at).withColumn("_end", F.col("cum_before") + F.col("cnt"))
    few = p.groupBy(*at).agg((F.count(F.lit(1)) <= bins).alias("_few"))
    passed = F.floor(F.col("_end") * bins / F.col("n_total")) > F.floor(F.col("cum_before") * bins / F.col("n_total"))
    ends = p.join(F.broadcast(few), at).where((F.col("_end") < F.col("n_total")) & (F.col("_few") | passed)).select(*at, "v", "_end")
    after = p.select(*at, F.col("v").alias("_next"), F.col("cum_before").alias("_end"))
    found = after.join(F.broadcast(ends), [*at, "_end"]).select(*at, ((F.col("v") + F.col("_next")) / 2).alias("_edge")).collect()
    slots = rows.agg(F.max(F.size("_x"))).first()[0]
    out = [[[] for _ in range(slots)] for _ in range(fits)]
    for r in found:
        out[r["_fit"]][r["_slot"]].append(r["_edge"])
    return [[np.array(sorted(e)) for e in one] for one in out]


def _rows(batches, edges, slots):
    """The rows of a task: bins by feature, then set, label, weight and key's hash."""
    parts = [(np.zeros((slots, 0), np.uint8), np.zeros(0, np.int32), np.zeros(0), np.zeros(0), np.zeros(0, np.uint64))]
    for b in batches:
        fit, y, w, row = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3, 4))
        bins = np.zeros((slots, len(fit)), dtype=np.uint8)
        for k in np.unique(fit):
            of = np.flatnonzero(fit == k)
            values = b.column(1).take(pa.array(of)).flatten().to_numpy().reshape(len(of), -1)
            for slot in range(values.shape[1]):
                bins[slot, of] = np.searchsorted(edges.value[k][slot], values[:, slot], side="left")
        parts.append((bins, fit, y, w, row.view(np.uint64)))
    return tuple(np.concatenate(v, axis=-1) for v in zip(*parts))


def _block(batches, edges, slots):
    """The rows of a task, pickled."""
    whole = _rows(batches, edges, slots)
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(whole, protocol=5)], pa.binary())], ["block"])


def _loaded(row):
    """A task's rows with prediction 0."""
    block = pickle.loads(row[0])
    return block, np.zeros(len(block[1]))


def _descend(bins: np.ndarray, fit: np.ndarray, tree: tuple, steps: int) -> np.ndarray:
    feature, cut, _ = tree
    node, rows = np.zeros(len(fit), dtype=np.int64), np.arange(len(fit))
    for _ in range(steps):
        at = feature[fit, node]
        node = np.where(at >= 0, 2 * node + 1 + (bins[at, rows] > cut[fit, node]), node)
    return node


def _drawn(row: np.ndarray, turn: int, rate: float) -> np.ndarray:
    """The rows that the tree of this round sees (splitmix64 of the key's hash and the round)."""
    z = row + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) * 2.0 ** -53 < rate


def _residuals(y: np.ndarray, prediction: np.ndarray, turn: int, classifies: bool) -> np.ndarray:
    if turn == 0:
        return y
    if not classifies:
        return 2 * (y - prediction)
    with np.errstate(over="ignore"):
        return 4 * y / (1 + np.exp(2 * y * prediction))


def _histograms(bins: np.ndarray, place: np.ndarray, weight: np.ndarray, pull: np.ndarray, sizes: list[int], n: int) -> np.ndarray:
    """Rows, weights and weighted residuals by place (of n), feature and bin."""
    start, out = 0, np.empty((3, n, sum(sizes)))
    for slot, k in enumerate(sizes):
        at = place * k + bins[slot]
        for stat, given in enumerate((None, weight, pull)):
            out[stat][:, start:start + k] = np.bincount(at, given, n * k).reshape(n, k)
        start += k
    return out


def _sums(state, tree, level, turn, sizes, fits, rate, classifies):
    """Rows, weights and weighted residuals by (set, node of the level), feature and bin."""
    for (bins, fit, y, w, row), prediction in state:
        node = _descend(bins, fit, tree, level)
        first = (1 << level) - 1
        use = np.flatnonzero((node >= first) & _drawn(row, turn, rate))
        place = (fit[use].astype(np.int64) << level) + node[use] - first
        weight = w[use]
        pull = weight * _residuals(y[use], prediction[use], turn, classifies)
        yield _histograms(bins[:, use], place, weight, pull, sizes, fits << level)


def _split(tree: tuple, level: int, sums: np.ndarray, sizes: list[int], fits: int, least: int) -> bool:
    """Best cut of every node of a level into ``tree``, with the means on both sides; whether any node was cut."""
    feature, cut, value = tree
    count, weight, pull = (s[:, :sizes[0]].sum(axis=1) for s in sums)
    n = fits << level
    fit, node = np.arange(n) >> level, (np.arange(n) & ((1 << level) - 1)) + (1 << level) - 1
    if level == 0:
        value[:, 0] = np.divide(pull, weight, out=np.zeros(n), where=weight > 0)
    best = np.zeros(n)
    starts = accumulate(sizes, initial=0)
    with np.errstate(divide="ignore", invalid="ignore"):
        for slot, (start, k) in enumerate(zip(starts, sizes)):
            if k < 2:
                continue
            cl, wl, pl = (s[:, start:start + k - 1].cumsum(axis=1) for s in sums)
            cr, wr, pr = count[:, None] - cl, weight[:, None] - wl, pull[:, None] - pl
            parts = pl * pl / wl + pr * pr / wr
            gain = parts - (pull * pull / weight)[:, None]
            gain = np.where((cl >= least) & (cr >= least) & (gain > 1e-12 * parts), gain, 0.0)
            where = gain.argmax(axis=1)
            top = gain[np.arange(n), where]
            better = np.flatnonzero(top > best)
            at = where[better]
            best[better] = top[better]
            f, h = fit[better], node[better]
            feature[f, h], cut[f, h] = slot, at
            value[f, 2 * h + 1] = (pl / wl)[better, at]
            value[f, 2 * h + 2] = (pr / wr)[better, at]
    return bool((best > 0).any())


def _advance(state, tree):
    """The rows with the tree's leaves added to their prediction."""
    for block, prediction in state:
        yield block, prediction + tree[2][block[1], _descend(*block[:2], tree, tree[0].shape[1].bit_length() - 1)]


def _bare(fits: int, depth: int) -> tuple:
    """Trees without a cut, one a set: feature, cut and value by node."""
    nodes = (2 << depth) - 1
    return np.full((fits, nodes), -1, np.int16), np.zeros((fits, nodes), np.uint8), np.zeros((fits, nodes))


def _grow(batches, edges, sizes, rounds, depth, rate, step, least, classifies):
    """All trees of the one set whose rows are in this task, pickled."""
    bins, _, y, w, row = _rows(batches, edges, len(sizes))
    only, prediction, trees = np.zeros(len(y), np.int64), np.zeros(len(y)), []
    for turn in range(rounds):
        tree = _bare(1, depth)
        use = np.flatnonzero(_drawn(row, turn, rate))
        here, weight, node = bins[:, use], w[use], np.zeros(len(use), np.int64)
        pull = weight * _residuals(y[use], prediction[use], turn, classifies)
        for level in range(depth):
            sums = _histograms(here, node - ((1 << level) - 1), weight, pull, sizes, 1 << level)
            if not _split(tree, level, sums, sizes, 1, least):
                break
            cut = tree[0][0, node] >= 0
            if not cut.all():  # rows of leaves are done
                here, weight, pull, node = here[:, cut], weight[cut], pull[cut], node[cut]
            node = 2 * node + 1 + (here[tree[0][0, node], np.arange(len(node))] > tree[1][0, node])
        tree[2][:] *= 1.0 if turn == 0 else step
        prediction += tree[2][0, _descend(bins, only, tree, depth)]
        trees.append(tree)
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(trees, protocol=5)], pa.binary())], ["trees"])


def _side_by_side(rows: DataFrame, fits: int, **how) -> list[tuple]:
    """The trees of all rounds, grown set by set: a job of one task each, all at a time.  Nothing but the trees is collected."""
    def one(i):
        return rows.where(F.col("_fit") == i).coalesce(1).mapInArrow(partial(_grow, **how), "trees binary").first()[0]
    inherit = inheritable_thread_target(rows.sparkSession)
    with ThreadPoolExecutor(fits) as pool:
        grown = [pickle.loads(x) for x in pool.map(inherit(one), range(fits))]
    return [tuple(np.concatenate(part) for part in zip(*turn)) for turn in zip(*grown)]


def _level_by_level(rows: DataFrame, fits: int, edges, sizes, rounds, depth, rate, step, least, classifies) -> list[tuple]:
    """The trees of all rounds: a level of all sets is one job over their rows, which are dealt out to tasks."""
    sc, n = rows.sparkSession.sparkContext, rows.count()
    tasks = max(min(-(-n // ROWS_A_TASK), sc.defaultParallelism), -(-n // MOST_ROWS_A_TASK), 1)
    blocks = rows.repartition(tasks).mapInArrow(partial(_block, edges=edges, slots=len(sizes)), "block binary")
    state = blocks.rdd.map(_loaded).persist(StorageLevel.MEMORY_AND_DISK)
    held, trees = [state], []
    for turn in range(rounds):
        tree = _bare(fits, depth)
        for level in range(depth):
            parts = state.mapPartitions(partial(_sums, tree=tree, level=level, turn=turn, sizes=sizes, fits=fits,
                                                rate=rate, classifies=classifies))
            sums = reduce(np.add, parts.collect()) if tasks <= PARTS_SUMMED_AT_ONCE else parts.treeReduce(np.add)
            while len(held) > 1:  # the first job of the round has stored the new predictions
                held.pop(0).unpersist()
            if not _split(tree, level, sums, sizes, fits, least):
                break
        tree[2][:] *= 1.0 if turn == 0 else step
        trees.append(tree)
        state = state.mapPartitions(partial(_advance, tree=tree)).persist(StorageLevel.MEMORY_AND_DISK)
        if (turn + 1) % ROUNDS_A_CHECKPOINT == 0:  # else every round adds a step to the predictions' lineage
            state.checkpoint() if sc.getCheckpointDir() else state.localCheckpoint()
        held.append(state)
    for rdd in held:
        rdd.unpersist()
    return trees


def grow_together(models, key: str, keep) -> None:
    """Grows the boosters of all ``Boosted`` among the models, which share one estimator's parameters; others are left alone.
    ``key`` names the row in the draw of a tree's rows; ``keep(df, name)`` may write and reread the rows."""
    waiting = [m for m in models if isinstance(m, Boosted) and m.trees is None]
    if not waiting:
        return
    est, classifies, fits = waiting[0].est, waiting[0].classifies, len(waiting)
    rows = keep(reduce(DataFrame.unionByName, [
        (m.prepared.transform(m.train) if m.rows is None else m.rows).select(
            F.lit(i).alias("_fit"), vector_to_array("features").alias("_x"),
            (2 * F.col(m.label) - 1 if classifies else F.col(m.label)).cast("double").alias("_y"),
            (F.lit(1.0) if m.weight is None else F.col(m.weight).cast("double")).alias("_w"),
            F.xxhash64(F.col(key), F.lit(i), F.lit(est.getSeed())).alias("_row"))
        for i, m in enumerate(waiting)]), "boosting")
    sc = rows.sparkSession.sparkContext
    counts = [r["count"] for r in rows.groupBy("_fit").count().collect()]
    edges = _edges(rows, fits, est.getMaxBins())
    sizes = [max(len(one[slot]) for one in edges) + 1 for slot in range(len(edges[0]))]
    how = dict(edges=sc.broadcast(edges), sizes=sizes, rounds=est.getMaxIter(), depth=est.getMaxDepth(), rate=est.getSubsamplingRate(),
               step=est.getStepSize(), least=est.getMinInstancesPerNode(), classifies=classifies)
    trees = (_side_by_side if max(counts) <= ROWS_A_SET else _level_by_level)(rows, fits, **how)
    feature, cut, value = (np.array(part) for part in zip(*trees))
    for i, m in enumerate(waiting):
        ends = np.array([np.pad(e, (0, max(sizes) - len(e))) for e in edges[i]])
        m.trees = (feature[:, i], ends[feature[:, i], cut[:, i]], value[:, i])
