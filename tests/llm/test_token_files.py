import glob
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfscope.llm import token_files as tf

FILE = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(FILE)
DTYPE = np.dtype("<u2")


def library(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


def brute(docs):
    """Rows in ascending id order; repeated ids are told apart by what they hold."""
    out, start = [], 0
    for i, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = library(text) + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def got(df):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()), key=lambda r: r[1])


HARD = ["I'll  can't'd 'S á a ́   x　y z", "ΑΣ ΣΑΣ. Σ", "<|endoftext|> a<|startoftext|>b <|end oftext|>", "\r\n\t a\x85b\x1cc\x0bd", "é\ń",
        "Å ẛ̣ ﬁ", "日本語 テスト。한국어 각", "😀😀 👩‍👩", "\x00\x01 \x7f", "İi ǅ", "가 ᆨ", "1234 5a6", "--- !!!a", " ", " ", "\n\n", "a" * 3000, "Größe!! Łódź.%%% œuvre, ĳ; a'' a'. a.' a<| x<b ŉa aſ a[]{}~ A|`"]


def test_chunks_equal_whole_texts():
    enc = tf.ChunkEncoder(FILE, DTYPE)
    texts = HARD + ["".join(HARD), " ".join(HARD), "\n".join(HARD), None, ""]
    assert [np.frombuffer(b, DTYPE).tolist() for b in enc.encode(texts)] == [library(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"aB's \n\t ̧́ΣéÅ1.!", "'ll", "<|endoftext|>", "<|", "|>", "!!", "ſ", "Œ", "İ", "ᄀ", "ᅡ", "ᆨ", "ͅ", "日"]), max_size=25))
def test_chunks_equal_whole_texts_random(parts):
    text = "".join(parts)
    assert np.frombuffer(next(tf.ChunkEncoder(FILE, DTYPE).encode([text])), DTYPE).tolist() == library(text)


def test_file_gives_views(tmp_path):
    docs = [(k, np.full(n, k or 9, DTYPE).tobytes()) for k, n in ((1, 3), (2, 5000), (None, 1), (4, 2046), (5, 200_000))]
    raw = tf.shard_file(docs, DTYPE, {"partition": 0, "shard": 0})
    assert raw.endswith(tf.MAGIC.encode())
    path = str(tmp_path / "x.arrow")
    with open(path, "wb") as out:
        out.write(raw)
    file = tf.TokenFile(path)
    flat = np.concatenate([np.frombuffer(b, DTYPE) for _, b in docs])
    assert len(file) == -(-len(flat) // tf.SEQUENCE) and np.array_equal(file.stream(), flat)
    assert [(i, n) for i, _, n in file.documents()] == [(1, 3), (2, 5000), (None, 1), (4, 2046), (5, 200_000)]
    before = pa.total_allocated_bytes()
    for k in (0, 1, 70, len(file) - 1):
        ids, mask = file.ids(k), file.mask(k).to_numpy(zero_copy_only=False)
        assert len(ids) == len(mask) == tf.SEQUENCE and not ids.flags.owndata
        assert np.array_equal(ids[mask], flat[k * tf.SEQUENCE:(k + 1) * tf.SEQUENCE])
    assert pa.total_allocated_bytes() - before < 10_000  # mapped, not read
    with pytest.raises(IndexError):
        file.ids(len(file))


def _docs():
    rng = np.random.default_rng(4)
    docs = [(int(i), " ".join(f"w{x}" for x in rng.integers(0, 500, int(rng.integers(0, 80))))) for i in rng.permutation(400)]
    return docs + [(1000 + k, t) for k, t in enumerate(HARD)] + [(-5, None), (-4, ""), (2000, "long one " * 40_000), (None, "no id"), (7, "seven"), (7, "seven"), (8, "eight")]


@pytest.mark.parametrize("shard", [300, 1 << 20])
def test_round_trip(spark, monkeypatch, tmp_path, shard):
    monkeypatch.setattr(tf, "SHARD_IDS", shard)
    docs = _docs()
    df = spark.createDataFrame([(*d, 9, 9) for d in docs], "doc_id long, text string, start int, value int").repartition(3)
    out = tf.tokenise(df, FILE, str(tmp_path / "files"))
    rows, want = got(out), brute(docs)
    assert [r[0] for r in rows] == [w[0] for w in want] and sorted(r[2:] for r in rows) == sorted(w[2:] for w in want)
    assert {r for r in rows if r[0] not in (7, 8)} >= {w for w in want if w[0] is not None and w[0] not in (7, 8)}
    assert all(a[1] + a[2] == b[1] for a, b in zip(rows, rows[1:]))
    files = glob.glob(str(tmp_path / "files" / "*.txt"))
    whole = sorted((tf.TokenFile(f) for f in files), key=lambda f: (f.meta["partition"], f.meta["shard"]))
    assert sum(f.meta["n_ids"] for f in whole) == rows[-1][1] + rows[-1][2]
    assert (len(files) > 20) == (shard == 300)


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert got(tf.tokenise(df, FILE, str(tmp_path / "none"))) == []


def test_registered_query(spark):
    from shelfscope.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op11_token_files"](spark, sf)) == brute(docs)


def test_chunks_are_learnt_once():
    """700,000 distinct words that come twice are encoded once (a smaller dictionary lost some of them in between)."""
    e = tf.ChunkEncoder(FILE, DTYPE)
    learnt = []
    e._words = lambda words: learnt.append(len(words)) or dict.fromkeys(words, b"ab")
    words = ["".join(chr(97 + i // 26 ** k % 26) for k in range(5)) for i in range(700_000)]
    texts = [" ".join(words[k:k + 5_000]) for k in range(0, len(words), 5_000)]
    assert all(ids == b"ab" * 5_000 for ids in e.encode(texts * 2))
    assert sum(learnt) == len(words)


def test_chunks_with_other_line_ends():
    """Chunks are told apart at line feeds only, empty ones and marks alone included."""
    texts = ["Ab\r\ncd, \x0bEf gh  \n\nÉté!! \x85 ... don't <|endoftext|> x\x1cy Z", "", None, "\n", "AB, ab Ab,"]
    e = tf.ChunkEncoder(FILE, DTYPE)
    got = [np.frombuffer(x, DTYPE).tolist() for x in e.encode(texts)]
    assert got == [library(t) for t in texts]
