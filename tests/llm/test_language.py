import zlib

import numpy as np

from shelfscope.llm.language import BUCKETS, Model, fit, fit_sets, grams, held_out, predict
from shelfscope.llm.queries import QUERIES


def test_scores_are_kernel_products():
    """Scores equal the sum over landmarks of dual weight times kernel, computed pair by pair."""
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 500, rng.integers(5, 60))).astype(np.uint16) for _ in range(30)]
    langs = ["a" if k % 2 else "b" for k in range(30)]
    model = fit_sets(sets, langs, landmarks=10)
    z = [sets[k] for j in "ab" for k in [i for i in range(30) if langs[i] == j][:5]]
    kernel = np.array([[len(np.intersect1d(s, t)) / np.sqrt(len(s) * len(t)) for t in z] for s in sets])
    b = np.zeros((10, BUCKETS))
    for k, t in enumerate(z):
        b[k, t] = 1 / np.sqrt(len(t))
    dual = np.linalg.lstsq(b.T, model.weights, rcond=None)[0]
    assert np.allclose(model.scores(sets), kernel @ dual, atol=1e-5)


def test_grams():
    assert len(grams(None)) == len(grams("")) == len(grams("123 !!")) == 0
    assert grams("Aé").tolist() == grams("aÉ").tolist()
    one = grams("ab")  # ' ', a, b, ' a', 'ab', 'b ', ' ab', 'ab ', ' ab '
    assert len(one) == 9


def test_held_out_accuracy(spark):
    out = QUERIES["op3_language_id"](spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in out if r.held_out]
    assert len(out) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held if truth[r.doc_id]]) > 0.95
    assert all(0 <= r.score <= 1 for r in out)


def test_nulls_ties_empty(spark):
    docs = spark.createDataFrame([(1, "hello there", "en"), (2, "ici et là", "fr"), (3, None, "en"), (4, "12 !", None), (None, "x" * 200_000, None),
                                  (2, "ici et là", "fr")], "doc_id long, text string, lang string")
    model = fit(docs)
    got = [(r.doc_id, r.lang_pred) for r in predict(docs, model).collect()]
    assert got[0][1] == "en" and got[1] == got[5] == (2, "fr") and got[2][1] == got[3][1] == "und" and got[4][1] in ("en", "fr")
    assert predict(docs.limit(0), model).count() == 0
    nothing = fit(docs.limit(0))
    assert {r.lang_pred for r in predict(docs, nothing).collect()} == {"und"} and isinstance(nothing, Model)
    assert docs.where(held_out()).where("doc_id is null").count() == 0
