import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from shelfscope.llm import source_audit as sa

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, least=30):
    """(lang, source, text) rows by plain dense arithmetic."""
    rows = [(a or "", b or "", t) for a, b, t in rows]
    out = []
    for lang in {r[0] for r in rows}:
        docs = Counter(t for r in rows if r[0] == lang for t in set(terms(r[2])))
        kept = sorted(t for t, n in docs.items() if n >= least)
        groups = {s: Counter() for a, s, _ in rows if a == lang}
        for a, s, text in rows:
            if a == lang:
                groups[s].update(t for t in terms(text) if docs[t] >= least)
        whole = sum(groups.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in groups.items()}, share(whole)
        for s in groups:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in groups if o != s]
            above = [(t, p[s][t] - q[t]) for t in kept if groups[s][t] > 0 and p[s][t] > q[t]]
            for part, items, top in (("pair", pairs, len(pairs)), ("term", above, 50)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(items[:top])]
    return sorted(out)


def got(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect())


def _rows():
    rng = np.random.default_rng(2)
    vocab = [f"{a}{b}" for a in "abcdéñ" for b in ("x", "Y", "zé", "q")]
    rows = []
    for k in range(700):
        lang = (None, "en", "de", "en", "en")[k % 5]
        source = "hot" if k % 3 else [None, "s1", "s2", "S3", "é4"][int(rng.integers(5))]
        lean = rng.permutation(len(vocab))[:8] if source != "hot" else np.arange(len(vocab))
        rows.append((lang, source, " ".join(vocab[i] for i in rng.choice(lean, int(rng.integers(0, 30)))) + ", 12_x-y'z"))
    rows += [("en", "empty", None), ("en", "empty", ""), ("fr", "a", "rare words only"), ("fr", "b", None), ("alone", "one", "x " * 5)]
    return rows + rows[:9] + [("en", "s1", "ax " * 50_000), ("en", "s2", "u" * 100_000)]


@pytest.mark.parametrize("sources, size, pending", [(128, 4096, 100_000), (2, 5, 40)])
def test_matches_brute_force(spark, monkeypatch, sources, size, pending):
    monkeypatch.setattr(sa, "PENDING", pending)
    rows = _rows()
    df = spark.createDataFrame([(*r, 1, "q", 2) for r in rows], "lang string, source string, text string, n long, term string, p0 int")
    assert got(sa.audit(df.repartition(3), block_terms=size, block_sources=sources)) == brute(rows)


def test_term_counts(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "lang string, source string, text string").selectExpr(
        "coalesce(lang, '') as lang", "coalesce(source, '') as source", "cast(text as binary) as text").coalesce(1)
    want = Counter()
    for lang, source, text in rows:
        for t in terms(text):
            want[lang or "", source or "", t.encode()] += 1
    assert {(r.lang, r.source, bytes(r.term)): r.n for r in sa.term_counts(df).collect()} == dict(want)


def test_exact_with_large_counts(spark):
    n = 12_000_000_000_000
    df = spark.createDataFrame([(n, 3 * n + 7, 11)], "n long, total long, v long")
    assert df.select(sa.smoothed(df.n, "total", "v").alias("p")).first().p == 1 + 10**9 * (n + 5) // (3 * n + 7 + 55)


def test_empty_table(spark):
    df = spark.createDataFrame([], "lang string, source string, text string")
    assert got(sa.audit(df)) == []


def test_query_matches_sql(spark):
    from shelfscope.llm.queries import ORACLE_SQL, QUERIES
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.execute(ORACLE_SQL["op13_source_audit"]).fetchall()
    rows = got(QUERIES["op13_source_audit"](spark, sf))
    assert rows == sorted(want) and {r[2] for r in rows} == {"pair", "term"}
