"""Operator 10: quality by importance resampling.

Two generative models over hashed n-grams: the target model counts the n-grams of documents labelled good,
the raw model those of *all* documents.  A document's log weight is the log ratio of its probability
under the two.  Gumbel noise (a hash of the id) is added and the k largest sums are kept: a sample without
replacement in proportion to the weights, with k = the sum over all documents of min(1, weight), the
number of documents the target can account for.

n-grams: words and marks (lower-cased) as uni- and bigrams, and trigrams of their shapes (case, digits,
marks themselves, repetition of the previous token), each hashed to ``BUCKETS`` buckets.  The models are two vectors of that
fixed size; only they go through the driver.  Target ids are a hash sample of at most ``MAX_TARGETS`` labelled rows
(documented bound, broadcast); the raw model, the scores, k and the threshold cover every row.  The k-th largest
sum is found by exact counts of its bits, never by a global sort.  Text is read three times and never shuffled.

Toxicity is a second resampling, because a few toxic words do not move the sum over a long text.  If the labels have a column
``toxic``, rows where it is 1 are no targets; a Bernoulli model of which words and marks a text has tells them from the
targets.  Its words are those that more toxic rows have than chance allows (likelihood ratio against the number of words
tried; words of the sampled labelled rows only, so ``MAX_TARGETS`` bounds them).  A document's weight is its probability of being clean, its k their sum; a
document is kept if both resamplings keep it.

Defined results: a null text or one without any token has no weight (null) and is rejected; rows that tie at the
threshold (repeated rows do) are all kept; ids may be null; without any labelled good row every weight
is 1; other columns pass through.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise

BUCKETS = 1 << 15          # for token n-grams, and as many again for shapes
MAX_TARGETS = 20_000
PRIOR = 40.0               # target counts that a bucket starts with, at the raw rate
KEPT_TOKENS = 200_000
SCALE = 1 << 20            # keys are compared in steps of 2^-20
_TOKEN = re.compile(r"\w+|[^\w\s]+|\n")
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _shape(token: str) -> int:
    if not (token[0].isalnum() or token[0] == "_"):
        return 64 + zlib.crc32(token.encode("utf-8", "replace")) % 128
    if token.isdigit():
        return 1
    case = 2 if token.islower() else 3 if token.istitle() else 4 if token.isupper() else 5
    return case * 4 + min(3, len(token) // 4)


class _Tokens(dict):
    """token -> hash of its lower case, and its shape in the low byte; bounded."""

    def __missing__(self, token: str) -> int:
        low = token.lower().encode("utf-8", "replace")
        value = (zlib.crc32(low) << 8 | _shape(token))
        if len(self) >= KEPT_TOKENS:
            self.clear()
        self[token] = value
        return value


_tokens = _Tokens()


def tokens(texts: list[str | None]) -> list[np.ndarray]:
    """Word hash and shape of every token, text by text."""
    out = []
    for t in texts:
        found = _TOKEN.findall(t) if t else ()
        out.append(np.fromiter(map(_tokens.__getitem__, found), np.uint64, len(found)))
    return out


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all texts, and how many each text has."""
    return ngrams(tokens(texts))


def ngrams(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    parts, counts = [], []
    for x in texts:
        n = len(x)
        if n:
            shape = (x & np.uint64(255))
            again = np.zeros(n, np.uint64)
            again[1:] = x[1:] == x[:-1]
            shape = shape * np.uint64(2) + again
            pad = np.concatenate([np.zeros(2, np.uint64), shape])
            tri = (pad[:-2] * np.uint64(512) + pad[1:-1]) * np.uint64(512) + pad[2:]
            word = x >> np.uint64(8)
            pair = word[:-1] * _M2 + word[1:]
            shift = np.uint64(64 - BUCKETS.bit_length() + 1)
            parts += [(word * _M1) >> shift, (pair * _M3) >> shift, ((tri * _M1) >> shift) + np.uint64(BUCKETS)]
        counts.append(3 * n - 1 if n else 0)
    flat = np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)
    return flat, np.array(counts, np.int64)


class Evidence:
    """Log odds of being clean, in whole steps of 1 / SCALE: ``base``, and what each word adds once per text."""

    def __init__(self, words: np.ndarray, weights: np.ndarray, base: int):
        order = np.argsort(words)
        self.words, self.weights, self.base = words[order], weights[order], base
        self.low = np.zeros(1 << 16, bool)
        self.low[self.words & 0xFFFF] = True

    def log_clean(self, texts: list[np.ndarray]) -> np.ndarray:
        """Log probability of being clean per text."""
        sums = np.full(len(texts), self.base, np.int64)
        for k, x in enumerate(texts):
            word = (x >> np.uint64(8)).astype(np.int64)
            word = np.unique(word[self.low[word & 0xFFFF]])
            if len(word):
                at = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
                sums[k] += self.weights[at[self.words[at] == word]].sum()
        return -np.logaddexp(0.0, -sums / SCALE)


def _evidence(counts: DataFrame) -> Evidence | None:
    """``counts``: in how many clean (raw) and toxic (target) texts each word stands; word -1 is all texts."""
    row = counts.where("bucket = -1").first()
    if row is None or not row.raw or not row.target:
        return None
    clean, toxic = float(row.raw), float(row.target)
    tried = counts.count() - 1
    if tried < 1:
        return None

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    c, t = F.col("raw").cast("double"), F.col("target").cast("double")
    share = (c + t) / (clean + toxic)
    g2 = 2 * (part(t, share * toxic) + part(c, share * clean) + part(toxic - t, (1 - share) * toxic) + part(clean - c, (1 - share) * clean))
    rows = (counts.where((F.col("bucket") >= 0) & (t / toxic > c / clean)).withColumn("g2", g2)
            .where(F.col("g2") > 2 * np.log(tried).item()).orderBy("bucket").collect())  # words of the sampled labelled texts only
    if not rows:
        return None
    in_clean = (np.array([r.raw for r in rows]) + 0.5) / (clean + 1)
    in_toxic = (np.array([r.target for r in rows]) + 0.5) / (toxic + 1)
    absent = np.log((1 - in_clean) / (1 - in_toxic))
    weights = np.rint((np.log(in_clean / in_toxic) - absent) * SCALE).astype(np.int64)
    base = round((np.log((clean + 0.5) / (toxic + 0.5)) + absent.sum()) * SCALE)
    return Evidence(np.array([r.bucket for r in rows], np.int64), weights, base)


def fit(docs: DataFrame, good: DataFrame, text: str = "text", doc_id: str = "doc_id") -> tuple[np.ndarray, Evidence | None]:
    """Log ratio (target to raw) of every bucket in whole steps of 1 / SCALE, so that a sum is the same
    whichever rows share its batch; and the toxicity model, if any labelled row is toxic."""
    spark = docs.sparkSession
    toxic = F.coalesce(F.col("toxic").cast("int") == 1, F.lit(False)) if "toxic" in good.columns else F.lit(False)
    sample = good.select(F.col(doc_id).alias("_id"), toxic.alias("_toxic")).where("_id is not null").groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    sample = sample.orderBy(F.xxhash64("_id"), "_id")
    targets, against = (spark.sparkContext.broadcast({r[0] for r in sample.where(c).select("_id").limit(MAX_TARGETS).collect()})
                        for c in ("not _toxic", "_toxic"))
    judged = bool(against.value)

    def count(batches):
        raw, target = np.zeros(2 * BUCKETS, np.int64), np.zeros(2 * BUCKETS, np.int64)
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for at in range(0, len(ids), 500):
                found = tokens(texts[at:at + 500])
                flat, n = ngrams(found)
                raw += np.bincount(flat, minlength=2 * BUCKETS)
                is_target = np.array([i in targets.value for i in ids[at:at + 500]], bool)
                target += np.bincount(flat[np.repeat(is_target, n)], minlength=2 * BUCKETS)
                if judged:
                    is_toxic = np.array([i in against.value for i in ids[at:at + 500]], bool)
                    sides = []
                    for side in (is_target, is_toxic):
                        mine = [np.unique((found[k] >> np.uint64(8)).astype(np.int64)) for k in np.flatnonzero(side) if len(found[k])]
                        sides.append(np.concatenate([*mine, np.full(len(mine), -1, np.int64)]))
                    word, place = np.unique(np.concatenate(sides), return_inverse=True)
                    if len(word):
                        cut = len(sides[0])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.ones(len(word), bool)), pa.array(word), *(pa.array(np.bincount(p, minlength=len(word))) for p in (place[:cut], place[cut:]))],
                            ["is_word", "bucket", "raw", "target"])
        some = np.flatnonzero(raw)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(some), bool)), pa.array(some), pa.array(raw[some]), pa.array(target[some])],
                                             ["is_word", "bucket", "raw", "target"])

    sums = (docs.select(doc_id, text).mapInArrow(count, "is_word boolean, bucket long, raw long, target long")
            .groupBy("is_word", "bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))
    if judged:
        sums = materialise(sums, "resample-counts")
    raw, target = np.zeros(2 * BUCKETS), np.zeros(2 * BUCKETS)
    for r in sums.where("not is_word").collect():  # at most 2 * BUCKETS rows
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    out = np.zeros(2 * BUCKETS)
    for part in (slice(0, BUCKETS), slice(BUCKETS, 2 * BUCKETS)):
        if target[part].sum():
            q = raw[part] / raw[part].sum()
            # the raw model is the prior of the target model: buckets with few expected target counts stay near it
            p = q * (target[part] + PRIOR) / (target[part].sum() * q + PRIOR)
            out[part] = np.log(np.where(q > 0, p / p.sum(), 1) / np.where(q > 0, q, 1))
    return np.rint(out * SCALE).astype(np.int64), _evidence(sums.where("is_word")) if judged else None


def with_key(docs: DataFrame, model, seed: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` plus log_weight and log_clean (0 without a toxicity model) and their Gumbel-perturbed keys in steps of 1 / SCALE."""
    schema = T.StructType([*docs.schema.fields, T.StructField("log_weight", T.DoubleType()), T.StructField("log_clean", T.DoubleType())])
    at = docs.columns.index(text)

    def score(batches):
        weights, evidence = model.value
        for b in batches:
            texts = b.column(at).to_pylist()
            out, clean = [], []
            for k in range(0, len(texts), 500):
                found = tokens(texts[k:k + 500])
                flat, n = ngrams(found)
                total = np.concatenate([[0], np.cumsum(weights[flat])])
                end = np.cumsum(n)
                got = total[end] - total[end - n]
                out += [float(x) / SCALE if m else None for x, m in zip(got, n)]
                got = evidence.log_clean(found) if evidence else np.zeros(len(n))
                clean += [float(x) if m else None for x, m in zip(got, n)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64()), pa.array(clean, pa.float64())],
                                             [*b.schema.names, "log_weight", "log_clean"])

    def key(weight, *salt):
        uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *salt, F.col(doc_id).cast("string")), 11) + F.lit(0.5)) * F.lit(2.0 ** -53)
        return F.floor((F.col(weight) - F.log(-F.log(uniform))) * SCALE).cast("long")
    return docs.mapInArrow(score, schema).withColumn("key", key("log_weight")).withColumn("clean_key", key("log_clean", F.lit("clean")))


def kth_largest(keys: DataFrame, k: int) -> int | None:
    """The k-th largest of the non-null longs in ``key`` by exact counts of 16 bits at a time."""
    if k <= 0:
        return None
    high = None  # what the bits so far are
    for shift in (48, 32, 16, 0):
        part = keys.where("key is not null")
        if high is not None:
            part = part.where(F.shiftright("key", shift + 16) == high)
        counts = part.groupBy(F.shiftright("key", shift).alias("b")).count().collect()  # 65,536 at most
        for r in sorted(counts, key=lambda r: -r.b):
            if k <= r["count"]:
                high = r.b
                break
            k -= r["count"]
        else:
            return None
    return high


def resample(docs: DataFrame, good: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = 10,
             k: int | None = None) -> DataFrame:
    """``docs`` plus log_weight, key and kept.  ``good``: the ids of documents labelled good; with a column ``toxic``,
    rows where it is 1 are examples of what goes although it is good."""
    clash = {"log_weight", "key", "kept", "log_clean", "clean_key"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    ratio, evidence = fit(docs, good, text, doc_id)
    model = docs.sparkSession.sparkContext.broadcast((ratio, evidence))
    scored = with_key(docs.select(doc_id, text), model, seed, text, doc_id)
    keys = materialise(scored.select("log_weight", "key", "log_clean", "clean_key"), "resample-keys")
    size, clean = keys.agg(F.sum(F.exp(F.least(F.col("log_weight"), F.lit(0.0)))), F.sum(F.exp("log_clean"))).first()
    least = kth_largest(keys, int(round(size or 0)) if k is None else k)
    kept = F.lit(False) if least is None else F.coalesce(F.col("key") >= least, F.lit(False))
    if evidence is not None:
        least_clean = kth_largest(keys.select(F.col("clean_key").alias("key")), int(round(clean or 0)))
        kept = F.lit(False) if least_clean is None else kept & F.coalesce(F.col("clean_key") >= least_clean, F.lit(False))
    return with_key(docs, model, seed, text, doc_id).withColumn("kept", kept).drop("log_clean", "clean_key")
