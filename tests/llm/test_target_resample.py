import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfscope.llm import target_resample as tr

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def features(text):
    w = words(text)
    return [" ".join(w[i:i + n]).encode() for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target, percent=5):
    s, t = (Counter(zlib.crc32(f) % 10000 for x in rows for f in features(x)) for rows in ([d[1] for d in docs], target))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000))))
    out = []
    for i, text in docs:
        f = features(text)
        weight = sum(gain(zlib.crc32(x) % 10000) for x in f)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((k for k in range(len(docs)) if len(words(docs[k][1])) >= 20),
                  key=lambda k: (-out[k][3], out[k][0] is not None, out[k][0] or 0))
    for place, k in enumerate(able[:percent * len(able) // 100]):
        out[k][4] = place + 1
    return out


def rows_of(df):
    return sorted(([r.doc_id, r.n_features, r.weight, r.score, r["rank"]] for r in df.collect()), key=repr)


def crcs(texts):
    got = [Counter() for _ in texts]
    for of, crc in tr.feature_crcs(texts):
        for k, c in zip(of.tolist(), crc.tolist()):
            got[k][c] += 1
    return got


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aZ09 é-\x00世", max_size=60)), max_size=6))
def test_crcs_equal_zlib(texts):
    want = [Counter(zlib.crc32(f) for f in features(t)) for t in texts]
    assert crcs([None if t is None else t.encode() for t in texts]) == want


def test_long_spans_fold():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 1023, 1024, 1025, 5000, 600_000):
        raw = rng.integers(0, 256, n).astype(np.uint8)
        assert tr.folded_crc(raw) == zlib.crc32(raw.tobytes())
    text = " ".join("x" * n for n in (5, 1024, 2, 700, 400, 3000, 1, 1, 1022, 1))
    assert crcs([text.encode(), b"one two"]) == [Counter(zlib.crc32(f) for f in features(t)) for t in (text, "one two")]


def test_long_text_in_blocks(monkeypatch):
    monkeypatch.setattr(tr, "SPAN_BLOCK", 64)
    text = " ".join(f"w{i % 37}" for i in range(5000))
    assert crcs([b"", text.encode(), None]) == [Counter(), Counter(zlib.crc32(f) for f in features(text)), Counter()]


def _corpus():
    rng = np.random.default_rng(5)
    vocab = ["".join(rng.choice(list("abcdé"), 4)) for _ in range(60)]
    text = lambda n: " ".join(rng.choice(vocab, n))
    docs = [(i, text(int(rng.integers(1, 70)))) for i in range(300)]
    docs += [(1000, None), (1001, ""), (1002, "--"), (None, text(40)), (7, docs[7][1]), (7, docs[7][1]), (1003, text(3)), (1004, text(30_000)),
             (1005, "y" * 200_000)]
    return docs, [docs[k][1] for k in range(0, 30)] + [None, ""]


def test_matches_brute_force(spark):
    docs, target = _corpus()
    df = spark.createDataFrame([(*d, 1, "x", "y") for d in docs], "doc_id long, text string, score int, rank string, _at string").repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    assert rows_of(tr.draw(df, wanted)) == sorted(brute(docs, target), key=repr)
    assert rows_of(tr.draw(df, wanted, percent=50)) == sorted(brute(docs, target, 50), key=repr)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, " ".join(["a"] * 30))], "doc_id long, text string")
    none = docs.limit(0).select("text")
    assert rows_of(tr.draw(docs, none)) == sorted(brute([(1, " ".join(["a"] * 30))], []), key=repr)
    assert tr.draw(docs.limit(0), docs.select("text")).count() == 0


def test_registered_query(spark):
    from shelfscope.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(*c).collect()]
    want = brute(read("documents", "doc_id", "text"), [t for (t,) in read("benchmark", "text")])
    assert rows_of(QUERIES["op12_target_resample"](spark, sf)) == sorted(want, key=repr)
