"""Connected components of a link table by contraction, and links within blocks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) -> (node, component): component is the smallest node reachable.

    Each round every node moves to the neighbour (or itself) with the smallest hash of the round; edges
    follow, loops and repeats go, so a constant share of the nodes disappears each round whatever the
    shape.  Rounds are cut by tables in the shared folder.  A hub is one row after partial minima; its joins are skew joins
    that AQE splits.  Nodes are the ends of edges; null ends are ignored."""
    edges = materialise(edges.where("a is not null and b is not null and a <> b")
                        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    nodes = None
    step = 0
    while not edges.isEmpty():
        step += 1
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = F.struct(F.xxhash64(F.lit(step), "b").alias("h"), F.col("b").alias("to"))
        own = F.struct(F.xxhash64(F.lit(step), "a").alias("h"), F.col("a").alias("to"))
        moves = materialise(both.groupBy("a").agg(F.min(near).alias("near"))
                            .select(F.col("a").alias("node"), F.least("near", own)["to"].alias("to")), f"cc-moves{step}")
        if nodes is None:
            nodes = moves
        else:
            m = moves.select(F.col("node").alias("m"), F.col("to").alias("m_to"))
            nodes = materialise(nodes.join(m, nodes["to"] == m["m"], "left")
                                .select("node", F.coalesce("m_to", "to").alias("to")), f"cc-nodes{step}")
        ma = moves.select(F.col("node").alias("a"), F.col("to").alias("a_to"))
        mb = moves.select(F.col("node").alias("b"), F.col("to").alias("b_to"))
        edges = materialise(edges.join(ma, "a").join(mb, "b").where("a_to <> b_to")
                            .select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct(), f"cc-edges{step}")
    if nodes is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    least = nodes.groupBy("to").agg(F.min("node").alias("component"))
    return nodes.join(least, "to").select("node", "component")


def block_pairs(df: DataFrame, group: list[str], member: str, block_rows: int) -> DataFrame:
    """Deal each group's members into blocks of about ``block_rows`` by a hash and repeat each row for every
    pair of blocks it belongs to: columns _i <= _j (the pair) and _mine (the row's block).  A group of n rows
    becomes n * ceil(n / block_rows) rows, each pair of blocks a bounded task of its own."""
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    sized = df.join(sizes, group).withColumn("_k", F.ceil(F.col("_n") / block_rows).cast("int"))
    mine = sized.withColumn("_mine", F.pmod(F.xxhash64(F.col(member), F.lit(77)), F.col("_k")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("_other")
    return (mine.select("*", other)
            .withColumn("_i", F.least("_mine", "_other")).withColumn("_j", F.greatest("_mine", "_other"))
            .drop("_other", "_n", "_k"))


class Forest:
    """Union-find over the places of one block."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)

    def join_matrix(self, hit: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> None:
        """Join rows[i] and cols[j] wherever hit[i, j]: breadth first, so a dense block costs its cells once."""
        for i in np.flatnonzero(hit.any(1)):
            js = np.flatnonzero(hit[i])
            root = self.find(int(rows[i]))
            for j in js.tolist():
                c = int(cols[j])
                if self.up[c] != root:
                    self.join(root, c)
                    root = self.find(root)

    def edges(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One edge (id, id of its root) for each place that is no root."""
        root = np.array([self.find(k) for k in range(len(self.up))], np.int64)
        own = np.flatnonzero(root != np.arange(len(root)))
        return ids[own], ids[root[own]]


def linked_rows(rows: DataFrame, members: DataFrame, found: DataFrame, id_name: str, class_name: str) -> DataFrame:
    """Link counts and classes of ``rows`` (id, rep and more).  ``members``: the distinct rows with a rep; ``found``:
    (a, links, b) rows of blocks, a and b being reps.  A row links to the other members of its rep and to
    all members of the linked reps; its class is the smallest id of the reps' component."""
    component = connected_components(found.select("a", "b")).withColumnRenamed("node", "rep")
    links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    reps = members.groupBy("rep").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    reps = reps.join(links, "rep", "left").join(component, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    least = reps.groupBy("component").agg(F.min("least").alias("class"))
    reps = reps.join(least, "component").select(
        "rep", "component", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("links"), "class")
    name = F.when(F.col("rep").isNull(), F.col("id")).otherwise(F.col("class"))
    more = [c for c in rows.columns if c != "id"]
    return rows.join(reps, "rep", "left").select(
        F.col("id").alias(id_name), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), name.alias(class_name),
        F.coalesce(F.col("id") == name, name.isNull()).alias("kept"), "component", *more)
