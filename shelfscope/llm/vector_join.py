"""Operator 1: near-duplicate embeddings by an exact metric range join.

Vectors are scaled to length 1; cosine >= t means a distance of at most r = sqrt(2 - 2t).  Equal vectors of a
label are one class first (links within it need no comparison).  The vectors of a label and dimension are one cell.  In a
crowded cell, pivots (of a hash sample, at most ``MAX_PIVOTS``) divide the space into cells by nearest pivot.  If x of cell i
and y of cell j are within r, the triangle inequality gives d(y, p_i) <= d(y, p_j) + 2r (and y lies at most r beyond the
border of the two cells).  The pair is decided in the smaller of its two home cells alone, so y is also sent to every
smaller cell where both hold.  Cells still crowded are divided
again, level by level, so their size does not follow the data.  The pivots (the first of the sample, or the farthest from each
other) and their number are the cheapest by the replication measured on other sampled vectors of the cell; where no division halves the comparisons (vectors without structure), the
cell stays.  Pivots are a table; they meet the vectors of their cell by a shuffle, a copy for each bounded slab of it.
Cells join independently; one that stays crowded is dealt into blocks and joined block by block.  A block returns link
counts and a spanning forest, never its pairs.

Slightly wider bounds guard against rounding; the link test itself is the cosine in double precision.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows without a label, link
with nothing and are their own component; vectors of other dimensions do not compare; equal rows of a vec_id
are one vector, unequal ones are each compared and reported; a null vec_id gives n_links 0 and a null component.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import group_batches, map_groups, materialise
from .components import Forest, block_pairs, linked_rows

MAX_PIVOTS = 64       # of a cell, at each level
SAMPLE = 256          # vectors of a crowded cell, about: its pivots and those that judge them
CELL_ROWS = 2000      # a cell of twice as many is crowded
SLAB_ROWS = 4096      # vectors of a cell that meet a copy of its pivots in one task
BLOCK_ROWS = 1024
CELL = ["part", "cell"]


def _unit(column: pa.Array) -> np.ndarray:
    x = np.array(column.to_pylist(), np.float64)
    return x / np.linalg.norm(x, axis=1)[:, None]


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * x @ y.T))


def _seen(x: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each vector, and the cells up to it that must see it."""
    d = _distances(x, pivots)
    home = d.argmin(1)
    own = d.min(1)[:, None]
    seen = d <= own + 2 * radius + 1e-6
    # the cells are halves of space towards each other: y is (d_i^2 - d_j^2) / 2 d(p_i, p_j) beyond the border
    seen &= d * d - own * own <= 2 * radius * _distances(pivots, pivots)[home] + 1e-6
    return home, seen & (np.arange(len(pivots)) <= home[:, None])


def _spread(x: np.ndarray, n: int) -> list[int]:
    """Places of n vectors, each the farthest from those before it."""
    order, far = [0], _distances(x, x[:1])[:, 0]
    while len(order) < n:
        order.append(int(far.argmax()))
        far = np.minimum(far, _distances(x, x[order[-1:]])[:, 0])
    return order


def _choose_pivots(radius: float):
    """Sampled vectors of a crowded cell -> its pivots, or no row where no division pays."""
    def run(batches):
        for g in group_batches(batches, CELL):
            x, size = _unit(g.column("vector")), g.column("size")[0].as_py()
            top = min(MAX_PIVOTS, len(x) // 2)
            best, cost = [], 0.5  # in comparisons of the undivided cell
            for order in (list(range(top)), _spread(x, top)):
                k = 2
                while k <= top:
                    share = _seen(np.delete(x, order[:k], 0), x[order[:k]], radius)[1].mean(0)
                    now = float((share ** 2).sum() + share.sum() * CELL_ROWS / size / 4)
                    if now < cost:
                        best, cost = order[:k], now
                    k *= 2
            chosen = pa.array(best, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(g.column(n).take(chosen) for n in (*CELL, "vector", "size")), pa.array(range(len(best)), pa.int32())], [*CELL, "vector", "size", "place"])
    return run


def _divide(radius: float):
    """A slab of a cell behind its pivots -> a row for each cell of the next level that must see a vector."""
    names = ["rep", "part", "n", "vector"]

    def run(batches):
        for g in group_batches(batches, [*CELL, "slab"]):
            k = len(g) - g.column("place").null_count
            if k == len(g):
                continue
            rows = g.slice(k)
            home, seen = _seen(_unit(rows.column("vector")), _unit(g.column("vector").slice(0, k)), radius)
            at, cell = np.nonzero(seen)
            take = pa.array(at, pa.int64())
            old = rows.column("cell")[0].as_py()
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(n).take(take) for n in names), pa.array([f"{old}/{c}" for c in cell.tolist()]),
                 pa.array([[*h, new] for h, new in zip(rows.column("homes").take(take).to_pylist(), home[at].tolist())], pa.list_(pa.int32()))],
                [*names, "cell", "homes"])
    return run


def divide(rows: DataFrame, radius: float) -> DataFrame:
    """``rows`` (rep, part, n, vector) -> a row per cell that sees the vector: cell is the path of the cell ("" undivided,
    "/3/0" on the second level), homes the vector's nearest pivot on each level."""
    kind = rows.schema["vector"].dataType.simpleString()
    open_rows = rows.withColumn("cell", F.lit("")).withColumn("homes", F.lit([]).cast("array<int>"))
    done = []
    level = 0
    while True:
        level += 1
        sizes = open_rows.groupBy(*CELL).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= 2 * CELL_ROWS)
        drawn = F.shiftrightunsigned(F.xxhash64(F.lit(level), "rep"), 11) * F.lit(2.0 ** -53) < SAMPLE / F.col("size")
        sample = open_rows.join(sizes, CELL).where(drawn).select(*CELL, "size", "rep", "vector")
        pivots = materialise(sample.repartition(*CELL).sortWithinPartitions(*CELL, F.xxhash64(F.lit(-level), "rep"), "rep")
                             .mapInArrow(_choose_pivots(radius), f"part string, cell string, vector {kind}, size long, place int"),
                             f"vector-pivots{level}")
        if pivots.isEmpty():
            return reduce(DataFrame.unionByName, done, open_rows)
        slabs = pivots.where("place = 0").select(*CELL, F.ceil(F.col("size") / SLAB_ROWS).cast("int").alias("slabs"))
        done.append(open_rows.join(slabs, CELL, "left_anti").select("rep", "part", "n", "vector", "cell", "homes"))
        slab = F.pmod(F.xxhash64(F.lit("slab"), "rep"), F.col("slabs")).cast("int")
        crowded = open_rows.join(slabs, CELL).select("rep", "part", "n", "vector", "cell", "homes", slab.alias("slab"), F.lit(None).cast("int").alias("place"))
        copies = pivots.join(slabs, CELL).select(
            F.lit(None).cast("long").alias("rep"), "part", F.lit(None).cast("long").alias("n"), "vector", "cell",
            F.lit(None).cast("array<int>").alias("homes"), F.explode(F.sequence(F.lit(0), F.col("slabs") - 1)).alias("slab"), "place")
        keys = [*CELL, "slab"]
        both = crowded.unionByName(copies).repartition(*keys).sortWithinPartitions(*keys, F.col("place").asc_nulls_last())
        open_rows = materialise(both.mapInArrow(_divide(radius), f"rep long, part string, n long, vector {kind}, cell string, homes array<int>"),
                                f"vector-cells{level}")


def _join_block(threshold: float):
    """One pair of blocks of one cell: links per vector and a spanning forest."""
    def run(g: pa.RecordBatch) -> dict:
        col = {n: g.column(n) for n in g.schema.names}
        x = _unit(g.column("vector"))
        cell, i, j = (col[n][0].as_py() for n in ("cell", "_i", "_j"))
        mine, rep, n = (np.asarray(col[k]) for k in ("_mine", "rep", "n"))
        path = [int(c) for c in cell.split("/")[1:]]
        home = np.array(col["homes"].to_pylist(), np.int64).reshape(len(x), len(path))
        left, right = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
        links, forest = np.zeros(len(x), np.int64), Forest(len(x))
        for at in range(0, len(left), 256):
            rows = left[at:at + 256]
            hit = x[rows] @ x[right].T >= threshold
            for level, c in enumerate(path):  # decided in the smaller home cell of each level
                hit &= np.minimum(home[rows, level][:, None], home[right, level][None, :]) == c
            if i == j:
                hit &= rows[:, None] < right[None, :]
            links[rows] += hit @ n[right]
            links[right] += n[rows] @ hit
            forest.join_matrix(hit, rows, right)
        a, b = forest.edges(rep)
        some = np.flatnonzero(links)
        return {"a": np.concatenate([rep[some], a]), "links": np.concatenate([links[some], np.zeros(len(a), np.int64)]),
                "b": np.concatenate([rep[some], b])}
    return run


def near_vectors(vectors: DataFrame, threshold: float, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors linked directly), component_id, kept."""
    spark = vectors.sparkSession
    radius = math.sqrt(max(0.0, 2 - 2 * threshold))
    v = F.col("vector").cast("array<double>")
    sound = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label")).withColumn(
        "usable", F.coalesce(sound & F.col("label").isNotNull() & F.col("id").isNotNull(), F.lit(False)))
    part = F.concat_ws("/", F.size("vector").cast("string"), F.col("label").cast("string"))
    rows = rows.withColumn("part", F.when(F.col("usable"), part)).withColumn("rep", F.when(F.col("usable"), F.xxhash64("part", "vector")))
    members = materialise(rows.where("usable").select("id", "rep").distinct(), "vector-members")
    # equal vectors of a label are one class, named by a 64-bit hash
    classes = materialise(
        rows.where("usable").select("rep", "part", "vector").dropDuplicates(["rep"])
        .join(members.groupBy("rep").agg(F.count(F.lit(1)).alias("n")), "rep").select("rep", "part", "n", "vector"), "vector-classes")
    pairs = block_pairs(divide(classes, radius), CELL, "rep", BLOCK_ROWS)
    found = materialise(map_groups(pairs, [*CELL, "_i", "_j"], _join_block(threshold), "a long, links long, b long"), "vector-links")
    return linked_rows(rows.select("id", "rep"), members, found, vec_id, "component_id").drop("component", "rep")
