import random

import pytest

from shelfscope.llm.common import words
from shelfscope.llm.licenses import CONTAINMENT, PHRASES, TEMPLATES, Join, digests, scan


def brute(text):
    w = words(text)
    base = []
    for phrase, label in PHRASES.items():
        p = words(phrase)
        base += [(k, label) for k in range(len(w)) if w[k:k + len(p)] == p]
    lines = [words(x) for x in (text or "").split("\n")]
    sets = [(label, words(t)) for label, t in TEMPLATES]
    share = lambda t, block: len(set(t) & set(block)) / len(set(t))
    reach = [max(len(u) for _, u in sets if u == t or share(t, u) >= CONTAINMENT - 1e-12) for _, t in sets]
    met = []
    for k, line in enumerate(lines):
        here = {}
        for i, (label, t) in enumerate(sets):
            rest, j = [], k + 1
            while j < len(lines) and len(rest) < reach[i]:
                rest += lines[j]
                j += 1
            here[i] = share(t, line) if share(t, line) >= CONTAINMENT - 1e-12 else share(t, line + rest) if line else 0
        here = {i: c for i, c in here.items() if c >= CONTAINMENT - 1e-12}
        met += [(sets[i][0], c) for i, c in here.items()
                if not any((o > c or o == c and len(set(sets[u][1])) > len(set(sets[i][1]))) and share(sets[i][1], sets[u][1]) >= CONTAINMENT - 1e-12 for u, o in here.items() if u != i)]
    labels = sorted({x for _, x in base})
    return (len(w), len(base), min((k for k, _ in base), default=None), max((k for k, _ in base), default=None), ",".join(labels),
            ",".join(sorted({*labels, *(x for x, _ in met)})), 1.0 if base else max((c for _, c in met), default=0.0))


def _texts():
    rnd = random.Random(9)
    vocab = sorted({w.decode() for _, t in TEMPLATES for w in words(t)} | {"alpha", "beta"})
    out = [t for _, t in TEMPLATES] + list(PHRASES) + [None, "", "\n\n", "cc by nc by nc cc by nc cc by nc", "under the MIT license under the mit license"]
    for _ in range(150):
        lines = []
        for _ in range(rnd.randint(0, 4)):
            t = [w.decode() for w in words(rnd.choice(TEMPLATES)[1])]
            for _ in range(rnd.choice([0, 1, 1, 2, 3])):
                t[rnd.randrange(len(t))] = rnd.choice(vocab)
            rnd.shuffle(t) if rnd.random() < 0.3 else None
            lines.append(rnd.choice([" ", ", ", "-", "\n"]).join(rnd.choices(vocab, k=rnd.randint(0, 3)) + t + rnd.choices(vocab, k=rnd.randint(0, 20))))
        out.append("\n".join(lines))
    return out + ["x " * 50_000 + "Released under the MIT License"]


def test_matches_brute_force(spark):
    texts = _texts()
    docs = spark.createDataFrame([(k, t, "z") for k, t in enumerate(texts)] + [(None, texts[0], "z"), (3, texts[3], "z")], "doc_id long, text string, label string")
    got = sorted(map(tuple, digests(scan(docs)).collect()), key=str)
    want = sorted([(k, *brute(t)) for k, t in enumerate(texts)] + [(None, *brute(texts[0])), (3, *brute(texts[3]))], key=str)
    assert got == want and sum(r[6] != r[5] for r in got) > 20


def test_filters_lose_nothing_for_any_order():
    rnd = random.Random(1)
    for _ in range(200):
        templates = [(str(k), " ".join(rnd.choices("abcdefghij", k=rnd.randint(1, 8)))) for k in range(6)]
        join = Join(templates, {w.encode(): rnd.randint(0, 9) for w in "abcdefghij"}, 0.6)
        block = {w.encode() for w in rnd.choices("abcdefghijkl", k=rnd.randint(0, 9))}
        want = sorted((k, len(set(words(t)) & block) / len(set(words(t)))) for k, t in templates)
        assert sorted((join.templates[t][0], c) for t, c in join.meets(block).items()) == [x for x in want if x[1] >= 0.6 - 1e-9]


def wrapped(text, width):
    out = [""]
    for w in text.split():
        if out[-1] and len(out[-1]) + len(w) >= width:
            out.append("")
        out[-1] += (" " if out[-1] else "") + w
    return "\n".join(out)


def test_wrapped_and_neighbouring_notices():
    join = Join(TEMPLATES, {}, CONTAINMENT)
    labels = lambda text: {x for x, *_ in join.text([words(x) for x in text.split("\n")])}
    for label, notice in TEMPLATES:
        for width in (25, 40, 72, 10_000):
            for before in ("", "Some words of the project before it. ", "A line of its own\n"):
                text = before + notice + " and the text goes on."
                assert labels("\n".join(wrapped(x, width) for x in text.split("\n"))) == {label}, (label, width, before)
    assert labels("nothing here\nof a licence") == set() and labels("") == set()
    two = TEMPLATES[8][1] + "\n\nnext\n\n" + TEMPLATES[9][1]
    assert labels(two) == {"gpl-3", "gpl-2"}


def test_query_matches_sql(spark):
    import duckdb

    from shelfscope.llm.queries import ORACLE_SQL
    rows = [(k, t) for k, t in enumerate(_texts())] + [(None, _texts()[0])]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    res = con.execute(ORACLE_SQL["op4_license_scan"])
    names = [d[0] for d in res.description]
    got = digests(scan(spark.createDataFrame(rows, "doc_id long, text string"))).select(*names).collect()
    assert sorted(map(tuple, got), key=str) == sorted(res.fetchall(), key=str)


def test_empty_and_clash(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert digests(scan(docs)).count() == 0
    with pytest.raises(ValueError):
        scan(docs.withColumnRenamed("doc_id", "found"))
