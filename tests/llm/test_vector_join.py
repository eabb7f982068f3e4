import numpy as np

from shelfscope.llm import vector_join
from shelfscope.llm.components import connected_components
from shelfscope.llm.vector_join import near_vectors


def brute(rows, t):
    ok = [i is not None and lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) for i, v, lab in rows]
    up = {i: i for i, _, _ in rows if i is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    n = {i: 0 for i, _, _ in rows}
    for a in range(len(rows)):
        for b in range(len(rows)):
            (i, u, p), (j, v, q) = rows[a], rows[b]
            if a != b and ok[a] and ok[b] and p == q and len(u) == len(v):
                u, v = np.array(u, float), np.array(v, float)
                if u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= t:
                    n[i] += 1
                    x, y = sorted((find(i), find(j)))
                    up[y] = x
    return sorted(((i, n[i] if i is not None else 0, None if i is None else find(i)) for i, _, _ in rows), key=str)


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_join, "CELL_ROWS", 20)
    monkeypatch.setattr(vector_join, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(4)
    rows = []
    base = rng.normal(size=(12, 8))
    for k in range(260):
        v = base[k % 12] + rng.normal(size=8) * rng.choice([0.02, 0.2, 1.0])
        rows.append((k * 3, [float(np.float32(x)) for x in v], int(k % 4 == 0)))
    same = rows[5][1]
    rows += [(2000 + k, same, 0) for k in range(60)] + [(2100, same, 1), (2101, [2 * x for x in same], 0)]
    rows += [(3000, None, 0), (3001, [], 0), (3002, [0.0] * 8, 0), (3003, [None] + [1.0] * 7, 0), (3004, [float("nan")] * 8, 0),
             (3005, same, None), (3006, same[:7], 0), (3007, [float("inf")] * 8, 0), (None, same, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    rows32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], p) for i, v, p in rows]
    got = near_vectors(df, 0.98).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == brute(rows32, 0.98)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_cells_are_divided_until_small(spark, monkeypatch):
    monkeypatch.setattr(vector_join, "CELL_ROWS", 25)
    monkeypatch.setattr(vector_join, "MAX_PIVOTS", 4)
    monkeypatch.setattr(vector_join, "SLAB_ROWS", 64)
    monkeypatch.setattr(vector_join, "BLOCK_ROWS", 32)
    rng = np.random.default_rng(9)
    far = np.repeat(np.linalg.qr(rng.normal(size=(12, 12)))[0][:8], 6, axis=0)  # 8 far groups of 6 nearer ones
    base = far + rng.normal(size=(48, 12)) * 0.2
    rows = [(k, (base[k % 48] + rng.normal(size=12) * rng.choice([0.005, 0.03])).tolist(), 0) for k in range(700)]
    vectors = spark.createDataFrame([(k, "12/0", 1, v) for k, v, _ in rows], "rep long, part string, n long, vector array<double>")
    cells = vector_join.divide(vectors, 0.2).groupBy("cell").count().collect()
    assert max(r.cell.count("/") for r in cells) >= 2 and max(r["count"] for r in cells) < 350
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), 0.98).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == brute(rows, 0.98)


def test_vectors_without_structure_stay_one_cell(spark, monkeypatch):
    monkeypatch.setattr(vector_join, "CELL_ROWS", 50)
    x = np.random.default_rng(2).normal(size=(400, 64)).tolist()
    vectors = spark.createDataFrame([(k, "64/0", 1, v) for k, v in enumerate(x)], "rep long, part string, n long, vector array<double>")
    assert vector_join.divide(vectors, 0.2).count() == 400


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert near_vectors(df, 0.98).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 200), (300, 300), (None, 1)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}, 200: 200, 201: 200}
