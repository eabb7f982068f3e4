import math

import numpy as np

from shelfscope.llm.resample import features, kth_largest, resample


def test_features_count_and_determinism():
    flat, n = features(["One two, two!", None, "", "éé éé"])
    assert n.tolist() == [14, 0, 0, 5] and len(flat) == 19
    again, _ = features(["One two, two!"])
    assert again.tolist() == flat[:14].tolist()


def test_kth_largest_matches_sort(spark):
    rng = np.random.default_rng(1)
    keys = [int(x) for x in rng.integers(-2**45, 2**45, 300)] + [5, 5, 5, -7, 0, 2**40]
    df = spark.createDataFrame([(x,) for x in keys] + [(None,)], "key long")
    for k in (1, 2, 150, 306):
        assert kth_largest(df, k) == sorted(keys, reverse=True)[k - 1]
    assert kth_largest(df, 0) is None and kth_largest(df.limit(0), 3) is None


def _corpus():
    rng = np.random.default_rng(7)
    vocab = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(25)]
    word = lambda: vocab[rng.integers(25)]
    good = [(i, " ".join(word() for _ in range(60)) + ".", "g") for i in range(120)]
    bad = [(1000 + i, " ".join(word().upper() + "!!" for _ in range(60)), "b") for i in range(30)]
    return good + bad + [(5000, None, "g"), (5001, "", "g"), (None, " ".join(word() for _ in range(60)), "g"), (3, good[3][1], "g")]


def test_keeps_good_rejects_bad(spark):
    docs = spark.createDataFrame(_corpus(), "doc_id long, text string, quality string")
    good = spark.createDataFrame([(i,) for i in range(0, 120, 2)] + [(None,)], "doc_id long")
    out = {(r.doc_id, r.text): r for r in resample(docs, good).collect()}
    bad = [r for (i, _), r in out.items() if i is not None and 1000 <= i < 2000]
    assert sum(r.kept for r in bad) <= 3
    clean = [r for (i, t), r in out.items() if t and (i is None or i < 1000)]
    assert sum(r.kept for r in clean) >= 0.9 * len(clean)
    assert all(out[i, t].kept is False and out[i, t].log_weight is None for i, t in ((5000, None), (5001, "")))
    rows = resample(docs, good).where("doc_id = 3").collect()
    assert len(rows) == 2 and rows[0] == rows[1]  # repeated rows share their fate


def test_top_k_is_gumbel_top_k(spark):
    docs = spark.createDataFrame(_corpus(), "doc_id long, text string, quality string")
    good = spark.createDataFrame([(i,) for i in range(60)], "doc_id long")
    rows = resample(docs, good, k=40).collect()
    least = sorted((r.key for r in rows if r.key is not None), reverse=True)[39]
    assert all(r.kept == (r.key is not None and r.key >= least) for r in rows)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long")
    got = resample(docs, none).first()
    assert got.log_weight == 0.0 and got.kept and math.isfinite(got.key)
    assert resample(docs.limit(0), none).count() == 0


def test_held_out_labels(spark):
    """Fitted on the labels of even ids, judged on those of odd ids."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r.doc_id: r.kept for r in resample(docs, labels.where("quality = 1 and toxic = 0 and doc_id % 2 = 0")).collect()}
    rows = labels.where("doc_id % 2 = 1 and toxic = 0").collect()
    good, bad = [[got[r.doc_id] for r in rows if r.quality == q] for q in (1, 0)]
    assert np.mean(good) > 0.85 and np.mean(bad) < 0.1


def test_held_out_toxic_rows(spark):
    """Toxic rows of good quality, fitted on the labels of even ids and judged on those of odd ids."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("quality = 1")
    got = {r.doc_id: r.kept for r in resample(docs, labels.where("doc_id % 2 = 0")).select("doc_id", "kept").collect()}
    rows = labels.where("doc_id % 2 = 1").collect()
    clean, toxic = [[got[r.doc_id] for r in rows if r.toxic == x] for x in (0, 1)]
    print("kept: clean", np.mean(clean), len(clean), "toxic", np.mean(toxic), len(toxic))
    assert np.mean(clean) > 0.97 and np.mean(toxic) < 0.35


def test_toxic_words_count_in_long_texts(spark):
    rng = np.random.default_rng(3)
    vocab = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(400)]
    text = lambda n: [vocab[k] for k in rng.integers(0, 400, n)]
    rows = [(i, " ".join(text(300)), 0) for i in range(300)]
    for i in range(60):
        w = text(300)
        w[int(rng.integers(300))] = "zzbad"
        rows.append((1000 + i, " ".join(w), 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    out = {r.doc_id: r.kept for r in resample(docs.drop("toxic"), docs.where("doc_id % 2 = 0").select("doc_id", "toxic")).collect()}
    assert sum(out[i] for i in out if i >= 1000) <= 5
    plain = {r.doc_id: r.kept for r in resample(docs.drop("toxic"), docs.where("doc_id % 2 = 0 and toxic = 0").select("doc_id")).collect()}
    assert sum(out[i] for i in out if i < 1000) >= sum(plain[i] for i in plain if i < 1000) - 10
