import hashlib
import random

import numpy as np
import pytest

from shelfscope.llm.common import words
from shelfscope.llm.decontaminate import cut_words, find_overlaps, digests, merge
from shelfscope.llm.fm_index import FMIndex, suffix_order


def brute(text, items, window=10):
    w = words(text)
    hit, ids = set(), set()
    for item, t in items:
        x = words(t)
        for at in range(max(1, len(x) - window + 1) if x else 0):
            p = x[at:at + window]
            for k in range(len(w) - len(p) + 1):
                if w[k:k + len(p)] == p:
                    hit.update(range(k, k + len(p)))
                    if item is not None:
                        ids.add(str(item))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


def test_suffix_order_and_search():
    rng = np.random.default_rng(3)
    for _ in range(40):
        seq = rng.integers(0, 4, rng.integers(1, 80)).astype(np.int32)
        seq[-1] = 0
        ends = [next(k for k in range(i, len(seq)) if seq[k] == 0) for i in range(len(seq))]
        want = sorted(range(len(seq)), key=lambda i: (seq[i:ends[i]].tolist() + [0], i))
        assert suffix_order(seq).tolist() == want
        index = FMIndex(seq)
        for m in (1, 2, 3):
            p = rng.integers(1, 6, (5, m)).astype(np.int32)
            lo, hi = index.search(p, np.full(5, m))
            for k in range(5):
                got = sorted(index.locate(np.arange(lo[k], hi[k])).tolist())
                assert got == [i for i in range(len(seq) - m + 1) if seq[i:i + m].tolist() == p[k].tolist()]


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_matches_brute_force(spark, block_bytes):
    rnd = random.Random(5)
    vocab = ["a", "B", "the", "é", "zu", "x1"]
    text = lambda n: rnd.choice([" ", ", ", "\n"]).join(rnd.choices(vocab, k=n))
    items = [(k, text(rnd.randint(0, 14))) for k in range(12)] + [(3, text(11)), (None, "solo"), (99, None), (50, "...")]
    docs = [(k, text(rnd.randint(0, 60)), "z") for k in range(40)] + [(7, None, None), (None, "Solo", "q"), (8, "", "q"), (8, "", "q")]
    docs += [(100, text(30) + " " + items[0][1] + " " + text(3000), "long")]
    found = find_overlaps(spark.createDataFrame(docs, "doc_id long, text string, item_id string"),
                          spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes)
    got = sorted(map(tuple, digests(found).collect()), key=str)
    assert got == sorted([(d, *brute(t, items)) for d, t, _ in docs], key=str)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert digests(find_overlaps(docs, items)).first().contaminated is False
    assert digests(find_overlaps(docs.limit(0), docs.withColumnRenamed("doc_id", "item_id"))).count() == 0


def test_clashing_names_are_refused(spark):
    docs = spark.createDataFrame([(1, "a", 2)], "doc_id long, text string, spans long")
    with pytest.raises(ValueError):
        find_overlaps(docs, spark.createDataFrame([], "item_id long, text string"))


def test_removal(spark):
    assert merge([(5, 6), (0, 2), (2, 3), (7, 9)]) == [(0, 3), (5, 9)]
    assert cut_words("One, two -- Thrée four!", [{"first": 1, "last": 2}]) == "One,  four!"
    item = "alpha beta gamma delta"
    docs = spark.createDataFrame([(1, f"Keep this. {item.upper()}! And this."), (2, "clean text"), (3, None)], "doc_id long, text string")
    out = find_overlaps(docs, spark.createDataFrame([(4, item)], "item_id long, text string"), cut=True)
    assert {r.doc_id: r.text for r in out.collect()} == {1: "Keep this. ! And this.", 2: "clean text", 3: None}
