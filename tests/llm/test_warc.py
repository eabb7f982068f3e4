import base64
import gzip
import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest

from shelfscope.llm import warc
from shelfscope.llm.warc import LoserTree, archive, parse, records, sort_key, unzip, url_key, write_archives


def _pages():
    rnd = random.Random(3)
    html = ["", None, "<p>é</p>", "a\r\n\r\nWARC/1.1\r\nb", "x\n", "\r\n\r\n", "\x00\x01", "long" * 50_000]
    rows = [(k * 7 % 101, f"http://h{k % 5}.example.org/{k % 9}?q={k}", rnd.choice(html)) for k in range(90)]
    return rows + [(500, None, "only"), (501, "a b\r\nc", "only"), (None, "http://x.org/", "<p>é</p>"), (None, "http://x.org", "alone"),
                   (502, "", ""), (503, "http://HOT.org/p", "z"), (504, "http://HOT.org/p", "z"), (504, "http://HOT.org/p", "z")]


def brute(rows):
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = min(same, default=None)
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if page == first else "revisit",
                    None if page == first else first))
    return sorted(out, key=str)


def test_round_trip_matches_brute_force(spark):
    rows = _pages()
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, time string").repartition(5)
    got = archive(pages).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(rows)
    ordered = sorted(got, key=lambda r: r.capture_no)
    assert [r.capture_no for r in ordered] == list(range(len(rows)))
    keys = [(r.url_key, r.time, r.page_id is not None, r.page_id or 0) for r in ordered]
    assert keys == sorted(keys) and len({r.shard for r in got}) > 1


def test_files_are_warc(spark, tmp_path):
    rows = _pages()
    path = f"file://{tmp_path}/out"
    write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    found = [r for f in (tmp_path / "out").glob("*.gz") for r in parse([gzip.decompress(f.read_bytes())])]
    assert len(found) == len(rows)
    payload = {h["WARC-Record-ID"]: b.split(b"\r\n\r\n", 1)[1] for _, _, h, b in found if h["WARC-Type"] == "response"}
    assert payload["<urn:x-page:500>"] == b"only"
    assert all("\r" not in v and "\n" not in v for _, _, h, _ in found for v in h.values())


def test_damage_is_noticed():
    with pytest.raises(ValueError):
        list(parse([b"WARC/1.1\r\nContent-Length: 10\r\n\r\nabc\r\n\r\n"]))
    with pytest.raises(ValueError):
        list(parse([b"junk\r\n\r\n"]))
    with pytest.raises(ValueError):
        list(unzip(pa.py_buffer(gzip.compress(b"abc" * 100)[:-9])))


def test_files_are_read_in_pieces(monkeypatch):
    monkeypatch.setattr(warc, "PIECE", 7)
    texts = [b"WARC/1.1\r\nA: b\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(x), x) for x in (b"", b"\r\n\r\n", b"x" * 100, b"WARC/1.1\r\n")]
    zipped = gzip.compress(texts[0] + texts[1]) + gzip.compress(texts[2]) + gzip.compress(b"") + gzip.compress(texts[3])
    assert b"".join(unzip(pa.py_buffer(zipped))) == b"".join(texts)
    found = list(parse(unzip(pa.py_buffer(zipped))))
    assert [b for *_, b in found] == [b"", b"\r\n\r\n", b"x" * 100, b"WARC/1.1\r\n"]
    assert all(b"".join(texts)[at:at + n] == t for (at, n, _, _), t in zip(found, texts))


def test_ranges_follow_the_number_of_entries(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_ENTRIES", 50)
    pages = spark.createDataFrame([(k, "http://hot.org/", "x") for k in range(2000)], "page_id long, url string, html string").repartition(6)
    got = archive(pages).collect()
    held = Counter(r.shard for r in got)
    assert len(held) >= 30 and max(held.values()) <= 150
    assert [r.page_id for r in sorted(got, key=lambda r: r.capture_no)] == list(range(2000))


def test_pieces_are_in_order():
    rnd = random.Random(1)
    rows = [(k, rnd.choice("abc"), "t", "", None, 0, "", "f", k, 0) for k in range(200)]
    batch = pa.RecordBatch.from_arrays(warc._columns(rows), warc.NAMES)
    pieces = [list(warc.entries(p)) for p in warc.sorted_pieces(batch)]
    assert [e for p in pieces for e in p] == rows and all(p == sorted(p, key=sort_key) for p in pieces) and len(pieces) > 1


def test_loser_tree():
    rnd = random.Random(0)
    for k in (1, 2, 3, 7, 16, 33):
        runs = [sorted([(rnd.randint(0, 5), rnd.choice("abc"), "t", "", None, 0, "", str(j), i, 0) for i in range(rnd.randint(0, 9))], key=sort_key)
                for j in range(k)]
        got = [sort_key(e) for e in LoserTree(runs)]
        assert got == sorted(sort_key(e) for r in runs for e in r)


def test_url_key_and_empty(spark):
    assert url_key("https://WWW.Example.org:80/A/b?C") == "org:80,example,www)/a/b?c" and url_key("x.org") == "x.org"
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert archive(empty).count() == 0 and records(empty).count() == 0
