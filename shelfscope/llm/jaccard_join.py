"""Operator 7: n-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of 64-bit hashes of five consecutive words; equal sets are one class first.  Each class has 96
MinHash values.  Classes that agree in four values of one of 24 bands meet in a bucket (a pair of similarity 0.8
is missed by all bands with probability 3e-6).  Within a bucket, pairs are compared value by value, 16 at a time;
after each step a pair goes whose posterior probability (uniform prior) of similarity >= t is below ``TOLERANCE``.
What remains connects classes to families, so unlike texts that share a bucket never meet again.  Within a family every
pair is compared the same way once and the rest is verified exactly on the sets.

No pairs leave a task: a bucket returns a spanning forest, a family link counts and a forest.  Crowded
buckets and families are dealt into blocks and joined block by block.  Only one byte of each MinHash value
travels to the buckets (two different values agree in it with probability 1/256, which the posterior includes); only texts of
families of two or more are read again.

Defined results: a text of one to four words is a set with one element; a null or word-free text links with nothing
and is its own class; equal rows of a doc_id are one document, unequal ones are each joined and reported; a
null doc_id is joined but never names a class; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fixed, map_groups, materialise, words
from .components import Forest, block_pairs, connected_components, linked_rows

WORDS, THRESHOLD = 5, 0.8
HASHES, BAND = 96, 4
STEP = 16
TOLERANCE = 1e-4
BLOCK_ROWS = 512
KEPT_WORDS = 200_000
_MULT = np.random.default_rng(20240607).integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hash = _WordHashes()


def shingles(text: str | None, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's n-word sequences (of all its words if it has fewer)."""
    w = words(text)
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hash.__getitem__, w), np.uint64, len(w))
    k = min(n, len(h))
    out = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        out = (out + h[j:len(h) - k + 1 + j]) * _P
        out ^= out >> np.uint64(29)
    return np.unique(out)


def minhash(s: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, ~np.uint64(0))
    for at in range(0, len(s), 2048):
        np.minimum(out, (s[at:at + 2048][None, :] * _MULT[:, None]).min(1), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """For each number of compared bytes, the matches from which P(similarity >= threshold) >= tolerance."""
    s = (np.arange(4000) + 0.5) / 4000
    p = s + (1 - s) / 256
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        m = np.arange(n + 1)[:, None]
        like = m * np.log(p) + (n - m) * np.log1p(-p)
        like = np.exp(like - like.max(1, keepdims=True))
        share = like[:, s >= threshold].sum(1) / like.sum(1)
        out.append(int(np.argmax(share >= tolerance)))
    return out


def survivors(sketch: np.ndarray, i: int, js: np.ndarray, least: list[int]) -> np.ndarray:
    """Those of js that the posterior leaves after comparing with i step by step."""
    matches = np.zeros(len(js), np.int32)
    for k, need in enumerate(least):
        if not len(js):
            break
        part = slice(k * STEP, (k + 1) * STEP)
        matches += (sketch[js, part] == sketch[i, part]).sum(1, dtype=np.int32)
        live = matches >= need
        js, matches = js[live], matches[live]
    return js


def _signatures(batches):
    """id, text, text_hash -> id, text_hash, class hash, byte sketch and band keys of every text with words."""
    for b in batches:
        at, rep, sketch, bands = [], [], [], []
        for k, text in enumerate(b.column(1).to_pylist()):
            s = shingles(text)
            if len(s):
                sig = minhash(s)
                at.append(k)
                rep.append(xxhash.xxh3_128_intdigest(s.tobytes()) & 0x7FFFFFFFFFFFFFFF)
                sketch.append((sig & np.uint32(255)).astype(np.uint8).tobytes())
                keys = sig.reshape(-1, BAND)
                bands.append([xxhash.xxh3_64_intdigest(row.tobytes(), seed=j) - (1 << 63) for j, row in enumerate(keys)])
        at = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(at), b.column(2).take(at), pa.array(rep, pa.int64()), pa.array(sketch, pa.binary()),
             pa.array(bands, pa.list_(pa.int64()))], ["id", "text_hash", "rep", "sketch", "bands"])


def _sides(g: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, bool]:
    i, j = g.column("_i")[0].as_py(), g.column("_j")[0].as_py()
    mine = np.asarray(g.column("_mine"))
    return np.flatnonzero(mine == i), np.flatnonzero(mine == j), i == j


def _bucket(threshold: float):
    """A pair of blocks of one bucket: a forest over the pairs that the posterior leaves."""
    least = least_matches(threshold, TOLERANCE)

    def run(g: pa.RecordBatch) -> dict | None:
        rep, sketch = np.asarray(g.column("rep")), fixed(g.column("sketch"), np.uint8)
        left, right, same = _sides(g)
        forest = Forest(len(rep))
        if same:  # breadth first: members found alike need not be compared with each other
            rest = left
            while len(rest):
                queue, rest = [int(rest[0])], rest[1:]
                while queue and len(rest):
                    i = queue.pop()
                    js = survivors(sketch, i, rest, least)
                    if len(js):
                        for j in js.tolist():
                            forest.join(i, j)
                        queue += js.tolist()
                        rest = np.setdiff1d(rest, js, assume_unique=True)
        else:
            for i in left.tolist():
                for j in survivors(sketch, i, right, least).tolist():
                    forest.join(i, j)
        a, b = forest.edges(rep)
        return {"a": a, "b": b} if len(a) else None
    return run


def _family(threshold: float):
    """A pair of blocks of one family: links per class and a forest, verified on the sets."""
    least = least_matches(threshold, TOLERANCE)

    def run(g: pa.RecordBatch) -> dict | None:
        rep, n, sketch = np.asarray(g.column("rep")), np.asarray(g.column("n")), fixed(g.column("sketch"), np.uint8)
        sets = [shingles(t) for t in g.column("text").to_pylist()]
        size = np.array([len(s) for s in sets], np.int64)
        vocab, flat = np.unique(np.concatenate(sets), return_inverse=True)
        start = np.cumsum(size) - size
        left, right, same = _sides(g)
        links, forest = np.zeros(len(rep), np.int64), Forest(len(rep))
        mark = np.zeros(len(vocab), np.int8)
        for i in left.tolist():
            js = right[right > i] if same else right
            small, large = np.minimum(size[js], size[i]), np.maximum(size[js], size[i])
            js = survivors(sketch, i, js[small >= threshold * large], least)
            if not len(js):
                continue
            own = flat[start[i]:start[i] + size[i]]
            mark[own] = 1
            where = np.concatenate([flat[start[j]:start[j] + size[j]] for j in js.tolist()])
            both = np.add.reduceat(mark[where], np.cumsum(size[js]) - size[js], dtype=np.int64)
            mark[own] = 0
            js = js[both >= threshold * (size[js] + size[i] - both)]
            links[i] += n[js].sum()
            links[js] += n[i]
            for j in js.tolist():
                forest.join(i, j)
        a, b = forest.edges(rep)
        some = np.flatnonzero(links)
        return {"a": np.concatenate([rep[some], a]), "links": np.concatenate([links[some], np.zeros(len(a), np.int64)]),
                "b": np.concatenate([rep[some], b])}
    return run


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_links, class_id (smallest doc_id of its class) and kept."""
    return _classes(docs, threshold, text, doc_id).drop("component", "rep", "text_hash")


def _classes(docs: DataFrame, threshold: float, text: str, doc_id: str) -> DataFrame:
    keyed = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    kind = docs.schema[doc_id].dataType.simpleString()
    signed = materialise(keyed.mapInArrow(
        _signatures, f"id {kind}, text_hash long, rep long, sketch binary, bands array<long>"), "jaccard-signatures")
    members = signed.select("id", "text_hash", "rep").distinct()
    classes = materialise(signed.select("rep", "sketch", "bands").dropDuplicates(["rep"]), "jaccard-classes")
    in_bands = classes.select("rep", F.posexplode("bands").alias("band", "band_key")).select("rep", F.xxhash64("band", "band_key").alias("key"))
    crowded = in_bands.groupBy("key").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("key")
    candidates = materialise(in_bands.join(crowded, "key"), "jaccard-candidates")
    sketches = classes.select("rep", "sketch")
    buckets = block_pairs(candidates.join(sketches, "rep"), ["key"], "rep", BLOCK_ROWS)
    alike = map_groups(buckets, ["key", "_i", "_j"], _bucket(threshold), "a long, b long")
    family = connected_components(alike).withColumnRenamed("node", "rep").withColumnRenamed("component", "family")
    # one text of each class of a family: equal sets, so any of its texts will do
    one = F.min(F.struct("text_hash", "id"))
    readers = (members.join(family, "rep").groupBy("rep", "family").agg(F.count(F.lit(1)).alias("n"), one.alias("one"))
               .select("rep", "family", "n", F.col("one.id").alias("r_id"), F.col("one.text_hash").alias("r_hash")))
    texts = (keyed.join(readers, keyed["text_hash"].eqNullSafe(readers["r_hash"]) & keyed["id"].eqNullSafe(readers["r_id"]))
             .select("rep", "family", "n", "text").dropDuplicates(["rep"]))
    families = block_pairs(materialise(texts.join(sketches, "rep"), "jaccard-families"), ["family"], "rep", BLOCK_ROWS)
    found = materialise(map_groups(families, ["family", "_i", "_j"], _family(threshold), "a long, links long, b long"), "jaccard-links")
    rows = keyed.select("id", "text_hash").join(members.withColumnRenamed("id", "m_id").withColumnRenamed("text_hash", "m_hash"),
                                                F.col("text_hash").eqNullSafe(F.col("m_hash")) & F.col("id").eqNullSafe(F.col("m_id")), "left")
    return linked_rows(rows.select("id", "rep", "text_hash"), members.select("id", "rep"), found, doc_id, "class_id")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each class, that of the smallest doc_id (then text hash); texts without words stay.
    The kept ones are named by two 64-bit hashes, of the text and of it with the id."""
    rows = _classes(docs, threshold, text, doc_id).withColumnRenamed(doc_id, "id")
    first = rows.where("rep is not null").groupBy("component").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")).alias("first"))
    kept = first.select("first.id", "first.text_hash").union(rows.where("rep is null").select("id", "text_hash"))
    kept = kept.select(F.col("text_hash").alias("_text"), F.xxhash64("text_hash", "id").alias("_row")).distinct()
    # the documents travel as one struct, so no name of theirs meets one of this function's
    keyed = docs.select(F.xxhash64(text).alias("_text"), F.xxhash64(F.xxhash64(text), docs[doc_id]).alias("_row"),
                        F.struct(*(docs[c] for c in docs.columns)).alias("doc"))
    return keyed.join(kept, ["_text", "_row"], "left_semi").dropDuplicates(["_text", "_row"]).select("doc.*")
