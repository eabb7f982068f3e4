"""Each stage of the pipeline against a brute-force view of its own input, on the smallest tables."""

import hashlib

import pytest

import corpus_pipeline as P
from shelfscope.llm import resample
from shelfscope.llm.piece_bpe import decode_ids, encode_text
from shelfscope.llm.queries import piece_model_file, table

from .test_decontaminate import brute as contaminated
from .test_jaccard_join import brute as classes
from .test_line_chunks import expected as without_repeats

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = table(spark, D, "documents").select(*P.COLUMNS)
    out = [docs.collect()]
    for _, stage in P.STAGES:
        got = stage(spark, docs, D)
        if stage is not P.tokens:
            assert got.columns == list(P.COLUMNS)
            docs = P.materialise(got, "test")
            got = docs
        out.append(got.collect())
    return out


def test_quality_stage_follows_the_operator(spark, steps):
    docs = table(spark, D, "documents")
    kept = {r.doc_id for r in resample.resample(docs, P.good_labels(spark, D)).where("kept").collect()}
    assert sorted(map(str, steps[1])) == sorted(str(r) for r in steps[0] if r.doc_id in kept)


def test_line_dedup_stage(spark, steps):
    from pyspark.sql import functions as F
    rows = [(r.doc_id, r.text) for r in steps[1]]
    hashes = {(r.doc_id, r.text): r.h for r in spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.xxhash64("text")).collect()}
    want = without_repeats(rows, hashes)
    want = {i: w for (i, t), w in want.items() if w == t or (w or "").strip()}
    assert {r.doc_id: r.text for r in steps[2]} == want
    assert all(r.n_chars == len(r.text) for r in steps[2] if r.text is not None)


def test_near_duplicate_stage(steps):
    rows = [(r.doc_id, r.text) for r in steps[2]]
    assert sorted(r.doc_id for r in steps[3]) == sorted({c for _, _, c in classes(rows)})
    assert all(n == 0 for _, n, _ in classes([(r.doc_id, r.text) for r in steps[3]]))


def test_decontamination_stage(spark, steps):
    items = [(r.item_id, r.text) for r in table(spark, D, "benchmark").collect()]
    before, after = ({r.doc_id: r.text for r in s} for s in steps[3:5])
    assert before.keys() == after.keys()
    for k, text in before.items():
        hit = contaminated(text, items)[4]
        assert (after[k] != text) == hit and not contaminated(after[k], items)[4]


def test_token_stage_and_run(spark, steps):
    model = piece_model_file()
    want = {}
    for r in steps[4]:
        ids = encode_text(model, r.text).tolist()
        want[r.doc_id] = (len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), decode_ids(model, ids))))
    assert {r.doc_id: tuple(r)[1:] for r in steps[5]} == want
    assert sorted(map(str, P.run(spark, D).collect())) == sorted(map(str, steps[5]))


def test_stages_take_empty_tables(spark):
    docs = table(spark, D, "documents").select(*P.COLUMNS).limit(0)
    assert all(stage(spark, docs, D).count() == 0 for _, stage in P.STAGES)


def test_stages_take_nulls_and_repeats(spark):
    rows = [(None, None, None, None, None), (1, None, "en", "s", 0), (1, "", "en", "s", 0), (2, "a clean line of text here", "en", "s", 25),
            (2, "a clean line of text here", "en", "s", 25)]
    docs = spark.createDataFrame(rows, table(spark, D, "documents").select(*P.COLUMNS).schema)
    assert P.quality(spark, docs, D).where("doc_id = 2").count() in (0, 2)
    assert P.line_dedup(spark, docs, D).count() == 5
    assert sorted(map(str, (r.doc_id for r in P.near_duplicates(spark, docs, D).collect()))) == ["1", "1", "2", "None"]
    assert P.decontaminated(spark, docs, D).count() == P.tokens(spark, docs, D).count() == 5
