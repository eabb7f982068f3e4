import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfscope.llm.piece_bpe import _loaded, decode_ids, digests, encode_decode, encode_text
from shelfscope.llm.queries import QUERIES, piece_model_file

sp_module = pytest.importorskip("sentencepiece")
FILE = piece_model_file()
SP = sp_module.SentencePieceProcessor(model_file=FILE)


def same(text):
    ids = SP.encode(text)
    assert encode_text(FILE, text).tolist() == ids
    assert decode_ids(FILE, ids) == SP.decode(ids)


@pytest.mark.parametrize("text", ["", " ", "  ", " " * 15, " " * 17, " " * 50 + "x" + " " * 33, "▁a ▁", "a▁▁b", "hello\r\nworld\t!", "😀é日本語x", "<s> </s> <unk> <0x0A>",
                                  "\x00\x01", "ﬁ①", "aaaaaaaaaaaaaaaa", "the the  the", "　x\xa0y", "é"])
def test_corner_cases(text):
    same(text)


def test_pieces_in_random_order():
    rnd = random.Random(5)
    model, _ = _loaded(FILE)
    pieces = [p.replace("▁", " ") for p in rnd.sample(sorted(model.id_of), 4000)]
    for _ in range(4000):
        same("".join(rnd.choices(pieces, k=rnd.randint(1, 12))))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.characters(blacklist_categories=["Cs"]), max_size=60))
def test_any_text(text):
    same(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 31999), max_size=12))
def test_decode_of_any_ids(ids):
    ids = [i for i in ids if i > 2]
    assert decode_ids(FILE, ids) == SP.decode(ids)


def test_query_equals_the_library(spark):
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op8_sentencepiece"](spark, d).collect()}
    for r in spark.read.parquet(f"{d}/documents.parquet").collect():
        ids = SP.encode(r.text or "")
        want = (len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), SP.decode(ids))))
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256, got[r.doc_id].decoded_sha256) == want


def test_nulls_long_text_and_empty_table(spark):
    docs = spark.createDataFrame([(1, None, 5), (1, "", 5), (None, "a " * 40_000, 6)], "doc_id long, text string, n_tokens int")
    rows = encode_decode(docs, FILE).collect()
    assert [len(r.ids) for r in rows[:2]] == [0, 0] and rows[0].decoded == "" and len(rows[2].ids) == 40_001 and rows[2].n_tokens == 6
    assert digests(encode_decode(docs.limit(0), FILE)).count() == 0
    with pytest.raises(ValueError):
        encode_decode(docs.withColumnRenamed("n_tokens", "ids"), FILE)
