"""Operator 3: language identification by string kernels.

A text is the set of its character n-grams of 1 to 4 letters (blended spectrum, presence only), each hashed to one of
``BUCKETS`` places.  The kernel of two texts is the size of their common set divided by the geometric mean of
their sizes.  Nystroem landmarks (a hash sample of each language) turn it into features K(x, Z) K(Z, Z)^-1/2, on
which one ridge regression per language (one versus rest, +1 / -1) is fitted.

Bounds, all parameters: at most ``MAX_TRAIN`` labelled documents are sampled by hash, spread over the languages,
and ``LANDMARKS`` of them are landmarks; only their n-gram sets reach the driver.  Scoring covers every row in one narrow
map.  With the rows' 0/1 matrix B and the landmarks' Z, the scores B (Z' A) / |B| are batched products with one
matrix of BUCKETS x languages, where A holds the dual weights.

Defined results: ``und`` and score 0 for a text that is null or has no letter; without any labelled training row every text
is ``und``; equal scores go to the alphabetically first language; rows repeat as they come; other columns pass through.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GRAMS = 4
BUCKETS = 1 << 16
MAX_TRAIN, LANDMARKS = 4000, 320
RIDGE = 1e-2
_LETTER = re.compile(r"[^\W\d_]")
_MULT = np.uint64(0x9E3779B97F4A7C15)
#: code points below 0x3000: letters stay, the rest counts as a blank
_FOLD = np.array([c if chr(c).isalpha() else 32 for c in range(0x3000)], np.uint32)


def grams(text: str | None) -> np.ndarray:
    """Sorted places of the text's distinct n-grams; none if it has no letter."""
    if not text or not _LETTER.search(text):
        return np.empty(0, np.uint16)
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    if len(c) and int(c.max()) >= len(_FOLD):
        c = np.where(c < len(_FOLD), _FOLD[np.minimum(c, len(_FOLD) - 1)], c)
    else:
        c = _FOLD[c]
    x = np.concatenate([[32], c, [32]]).astype(np.uint64)
    seen = np.zeros(BUCKETS, bool)
    code = np.zeros(len(x), np.uint64)
    for n in range(1, GRAMS + 1):
        code = code[:len(x) - n + 1] * np.uint64(0x100000001B3) + x[n - 1:] + np.uint64(n)
        seen[(code * _MULT) >> np.uint64(48)] = True
    return np.flatnonzero(seen).astype(np.uint16)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages

    def scores(self, sets: list[np.ndarray]) -> np.ndarray:
        """Kernel scores of texts that have n-grams, one row each."""
        size = np.array([len(s) for s in sets])
        rows = self.weights[np.concatenate(sets)]
        return np.add.reduceat(rows, np.cumsum(size) - size, axis=0) / np.sqrt(size)[:, None]


def fit_sets(sets: list[np.ndarray], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Kernel ridge regression on n-gram sets; every k-th set of a language is a landmark."""
    names = sorted(set(langs))
    if not names:
        return Model([], np.zeros((BUCKETS, 0)))
    y = np.where(np.array(langs)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    def rows(some: list[np.ndarray]) -> np.ndarray:
        b = np.zeros((len(some), BUCKETS), np.float32)
        for k, s in enumerate(some):
            b[k, s] = 1 / np.sqrt(len(s))
        return b

    per = max(1, landmarks // len(names))
    chosen = np.concatenate([np.flatnonzero(y[:, j] > 0)[:per] for j in range(len(names))])
    z = rows([sets[k] for k in chosen])
    # kernel of all examples and the landmarks, a block of examples at a time
    kernel = np.concatenate([rows(sets[at:at + 128]) @ z.T for at in range(0, len(sets), 128)]).astype(np.float64)
    values, vectors = np.linalg.eigh((z @ z.T).astype(np.float64))
    sound = values > 1e-6 * values.max()
    root = vectors[:, sound] / np.sqrt(values[sound])  # K(Z, Z)^-1/2 up to a rotation
    phi = kernel @ root
    # each language's examples weigh the same in its regression and in the rest
    share = 1 / (y > 0).sum(0)
    w = np.array([share[names.index(lang)] for lang in langs]) / len(names) * len(langs)
    gram = (phi * w[:, None]).T @ phi + ridge * len(langs) * np.eye(phi.shape[1])
    dual = root @ np.linalg.solve(gram, (phi * w[:, None]).T @ y)
    return Model(names, z.T @ dual.astype(np.float32))


def _sets(batches):
    for b in batches:
        found = [grams(t) for t in b.column(0).to_pylist()]
        some = [k for k, s in enumerate(found) if len(s)]
        yield pa.RecordBatch.from_arrays(
            [b.column(1).take(pa.array(some, pa.int64())), b.column(2).take(pa.array(some, pa.int64())),
             pa.array([found[k].tobytes() for k in some], pa.binary())], ["lang", "h", "grams"])


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    """Model of the labelled rows' hash sample (``key`` only decides who is in the sample)."""
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.lit(3), key).alias("h"))
    rows = rows.where("lang is not null and text is not null")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return fit_sets([], [])
    per = max(1, MAX_TRAIN // len(sizes))
    # the hash, as a share of its range, below the language's sampling rate
    share = (F.shiftrightunsigned("h", 11) * F.lit(2.0 ** -53))
    rate = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, per / n)))])
    picked = rows.where(share < rate[F.col("lang")]).mapInArrow(_sets, "lang string, h long, grams binary")
    got = sorted((r.h, r.lang, bytes(r.grams)) for r in picked.collect())
    return fit_sets([np.frombuffer(g, np.uint16) for _, _, g in got], [k for _, k, _ in got])


def predict(docs: DataFrame, model: Model, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` plus the predicted language of the whole text and its score, (1 + ridge value) / 2 within 0 and 1."""
    clash = set(names) & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])

    def run(batches):
        m = shared.value
        for b in batches:
            found = [grams(t) for t in b.column(at).to_pylist()]
            pred, score = ["und"] * len(found), [0.0] * len(found)
            some = [k for k, s in enumerate(found) if len(s)] if m.languages else []
            for i in range(0, len(some), 256):
                ks = some[i:i + 256]
                f = m.scores([found[k] for k in ks])
                best = f.argmax(1)
                for k, j, row in zip(ks, best.tolist(), f):
                    pred[k], score[k] = m.languages[j], float(min(1.0, max(0.0, (1 + row[j]) / 2)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             [*b.schema.names, *names])
    return docs.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Every fifth document by the checksum of its id as text; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
