import random

import numpy as np

from shelfscope.llm import jaccard_join
from shelfscope.llm.common import words
from shelfscope.llm.jaccard_join import keep_one, least_matches, near_duplicates, shingles


def word_set(text):
    w = words(text)
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows, t=0.8):
    rows = list(rows)
    sets = [word_set(x) for _, x in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    n = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= t * (len(sets[a]) + len(sets[b]) - both):
                n[a] += 1
                n[b] += 1
                up[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            r = find(k)
            least[r] = min(i, least.get(r, i))
    return sorted(((rows[k][0], n[k], least.get(find(k)) if sets[k] else rows[k][0]) for k in range(len(rows))), key=str)


def corpus():
    rnd = random.Random(11)
    vocab = [f"w{k}" for k in range(300)] + ["é", "Über"]
    rows, k = [], 0
    for _ in range(25):
        base = rnd.choices(vocab, k=rnd.randint(30, 300))
        for _ in range(rnd.randint(1, 14)):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 4, 9])):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            rows.append((k * 2, rnd.choice([" ", ", "]).join(w)))
            k += 1
    rows += [(5001, "one two"), (5003, "One, TWO!"), (5005, "one two three"), (5007, None), (5009, ""), (5011, "..."), (None, rows[0][1]), (None, "lonely words here")]
    rows += [(7001, "x " * 5000 + "y"), (7003, "x " * 9000)]
    return rows


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", 4)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, rep int")
    got = near_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.n_links, r.class_id) for r in got), key=str) == brute(rows)
    assert sum(r.n_links > 0 for r in got) > 60
    kept = {r.doc_id for r in keep_one(docs).collect()}
    assert kept == {c for _, _, c in brute(rows)} | {None}  # the text under the null id is alone of its class


def test_repeated_ids_and_empty_table(spark):
    text = "a b c d e f g h i j"
    docs = spark.createDataFrame([(1, text), (1, text), (1, "other words entirely"), (2, text + " k")], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_links, r.class_id) for r in near_duplicates(docs).collect())
    assert got == [(1, 0, 1), (1, 1, 1), (1, 1, 1), (2, 1, 1)]
    assert sorted(r.text for r in keep_one(docs).collect()) == [text, "other words entirely"]
    assert near_duplicates(docs.limit(0)).count() == 0


def test_clashing_columns_pass_through(spark):
    text = "a b c d e f g h i j"
    docs = spark.createDataFrame([(1, text, "p", 5, "q"), (2, text, "r", 6, "s"), (3, None, "t", 7, None)],
                                 "doc_id long, text string, _text string, _row long, doc string")
    assert sorted(tuple(r) for r in keep_one(docs).collect()) == [(1, text, "p", 5, "q"), (3, None, "t", 7, None)]
    assert keep_one(docs).columns == docs.columns


def test_shingles_and_pruning_table():
    a, b = "the quick brown fox jumps over it", "The quick, brown fox jumps"
    assert len(np.intersect1d(shingles(a), shingles(b))) == 1 and len(shingles("x y")) == 1
    least = least_matches(0.8, 1e-4)
    assert least == sorted(least) and least[0] >= 4 and least[-1] < 0.8 * 96
