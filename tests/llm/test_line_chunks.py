import random

import numpy as np
import pytest

from shelfscope.llm.line_chunks import LAYERS, _lines, chunks, dedup_lines, equal_runs, gap_levels, line_hashes


def words(line):
    return len("".join(c if c.isalnum() or ord(c) >= 128 else " " for c in line).split())


def expected(rows, text_hash):
    """Plain lists of lines: chunks by bytes, first places, and every run of equal lines along each alignment."""
    docs = sorted({(i is None, i or 0, text_hash[i, t], t) for i, t in rows if t}, key=lambda d: d[:3])
    lines = [d[3].split("\n") for d in docs]
    places = {}
    for k, own in enumerate(lines):
        for s, e in chunks(line_hashes([x.encode() for x in own])):
            places.setdefault(tuple(own[s:e]), []).append((k, s))
    gone = [set() for _ in docs]
    for same in places.values():
        k0, s0 = min(same)
        for k, s in same:
            if (k, s) == (k0, s0):
                continue
            pairs = [(i, i + s0 - s) for i in range(len(lines[k])) if 0 <= i + s0 - s < len(lines[k0])]
            run = []
            for i, j in [*pairs, (None, None)]:
                if i is not None and lines[k][i] == lines[k0][j]:
                    run.append(i)
                    continue
                full = [x for x in run if lines[k][x].strip()]
                if len(full) >= 2 or any(words(lines[k][x]) >= 50 for x in run):
                    gone[k].update(range(full[0], full[-1] + 1))
                run = []
    cut = {(None if d[0] else d[1], d[3]): "\n".join(x for j, x in enumerate(own) if j not in g) for d, own, g in zip(docs, lines, gone)}
    return {(i, t): cut.get((i, t), t) for i, t in rows}


def _rows():
    rnd = random.Random(2)
    line = [f"line {k} " + "w " * rnd.randint(0, 70) for k in range(60)] + [""]
    block = [line[k:k + 9] for k in range(0, 45, 9)]
    rows = []
    for k in range(50):
        own = [f"own {k} {j}" for j in range(rnd.randint(0, 5))]
        parts = own + rnd.choice(block) + [f"x{k}"] + rnd.choice(block) * rnd.randint(0, 2)
        rows.append((k, "\n".join(parts)))
    rows += [(7, rows[8][1]), (7, rows[8][1]), (None, rows[9][1]), (None, None), (200, ""), (201, None), (202, "\n\n\n\n"), (203, "\n\n\n\n")]
    rows += [(300, "\n".join(line * 40)), (301, "é" * 100_000), (302, "  \nonce\n "), (303, "\tonce\n")]
    return rows


def test_matches_brute_force(spark):
    rows = _rows()
    names = ["start", "_id", "_hash", "_ranges", "key", "doc", "parts", "id", "text_hash", "own", "bad"]
    docs = spark.createDataFrame([(i, t, *[i] * len(names)) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{n} long" for n in names))
    from pyspark.sql import functions as F
    text_hash = {(r.doc_id, r.text): r.h for r in docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()}
    got = dedup_lines(docs).collect()
    want = expected(rows, text_hash)
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(((i, want[i, t]) for i, t in rows), key=str)
    assert sum(r.removed_lines for r in got) > 100 and all(r[n] == r.doc_id for r in got for n in names)


def test_very_long_text(spark):
    text = "\n".join(f"line {k % 61} " + "w " * (k % 61) for k in range(24_400))
    rows = [(1, text), (2, text), (3, "z " * 500_000)]
    got = {r.doc_id: r for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].removed_lines == 24_400 - 61 and got[2].text == "" and got[3].removed_lines == 0
    assert got[1].text == "\n".join(text.split("\n")[:61])


def test_layers_are_nested_and_shift_resistant():
    lines = [f"line {k}".encode() for k in range(400)]
    level = gap_levels(line_hashes(lines))
    assert all(0.2 < (level >= k + 1).sum() / (level >= k).sum() < 0.95 for k in range(LAYERS))
    a = {b"\n".join(lines[s:e]) for s, e in chunks(line_hashes(lines))}
    moved = [b"new"] + lines[:100] + [b"other"] + lines[100:]
    b = {b"\n".join(moved[s:e]) for s, e in chunks(line_hashes(moved))}
    assert len(a & b) >= len(a) - 2 * LAYERS


def test_equal_runs():
    h = line_hashes([b"a", b"", b"b", b"c", b"", b"w " * 60, b""])
    assert equal_runs(h, h) == [(0, 6)]
    other = h.copy()
    other[3] += np.uint64(4)
    assert equal_runs(h, other) == [(0, 3), (5, 6)]


def test_drop_emptied_and_empty_table(spark):
    text = "a b\nc d\ne f\n" + "w " * 60
    docs = spark.createDataFrame([(1, text), (2, text), (3, ""), (4, None)], "doc_id long, text string")
    kept = {r.doc_id for r in dedup_lines(docs, drop_emptied=True).collect()}
    assert kept == {1, 3, 4}
    assert dedup_lines(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        dedup_lines(docs.withColumnRenamed("text", "removed_lines"), text="removed_lines")


def planted(spark, n):
    """Share of planted passages of n lines, each in two documents among foreign lines, cut from the later one."""
    rnd = random.Random(n)
    rows = []
    for p in range(150):
        passage = [f"passage {p} line {j} " + "w " * rnd.randint(5, 20) for j in range(n)]
        for k in (p, 1000 + p):
            own = lambda m: [f"own {k} {rnd.random()}" for _ in range(m)]
            rows.append((k, "\n".join(own(rnd.randint(0, 7)) + passage + own(rnd.randint(0, 7)))))
    got = {r.doc_id: r for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    own_lines = {(k, x) for k, t in rows for x in t.split("\n") if x.startswith("own")}
    assert own_lines == {(k, x) for k, r in got.items() for x in r.text.split("\n") if x.startswith("own")}
    assert all(got[p].removed_lines == 0 for p in range(150))
    assert {got[1000 + p].removed_lines for p in range(150)} <= {0, n}  # whole or not at all
    return sum(got[1000 + p].removed_lines == n for p in range(150)) / 150


def test_short_passages_in_foreign_contexts(spark):
    found = {n: planted(spark, n) for n in range(2, 7)}
    print("recall by lines of the passage", found)
    assert np.mean(list(found.values())) >= 0.9 and min(found.values()) >= 0.9


def test_removed_lines_come_from_chunks(spark):
    """On the documents, most removed lines lie in a repeated chunk itself, not just beside one."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    count, ranges = {}, {}
    for k, t in texts.items():
        lines = _lines(t)
        ranges[k] = [(s, e, b"\n".join(lines[s:e])) for s, e in chunks(line_hashes(lines))]
        for *_, body in ranges[k]:
            count[body] = count.get(body, 0) + 1
    total = inside = 0
    for r in dedup_lines(docs).where("removed_lines > 0").collect():
        left, lines = (r.text.split("\n") if r.text else []), texts[r.doc_id].split("\n")
        covered = {i for s, e, body in ranges[r.doc_id] if count[body] > 1 for i in range(s, e)}
        gone, at = [], 0
        for i, x in enumerate(lines):
            if at < len(left) and left[at] == x:
                at += 1
            else:
                gone.append(i)
        total, inside = total + len(gone), inside + len(covered & set(gone))
    print("removed lines", total, "within repeated chunks", inside)
    assert total > 500 and inside > 0.8 * total
