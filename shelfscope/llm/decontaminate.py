"""Operator 5: benchmark decontamination by an FM-index per training shard.

A shard is one Arrow batch of documents.  Words outside the benchmark's vocabulary cannot be in any phrase,
so the index holds the runs of vocabulary words that are at least as long as the shortest phrase (nothing
else can hold an occurrence).  All phrases (windows of 10 consecutive item words, or the
whole item if shorter) are searched backward at once through the wavelet ranks, occurrences are located by sampled
suffixes and merged into removal spans.  The job is a narrow map: no shuffle, and memory is one batch
with its index.  The phrases are broadcast in blocks of at most ``BLOCK_BYTES`` of item text; a larger
benchmark takes one pass a block, each continuing the spans of the one before.

Defined results: null or word-free documents have n_words 0 and no hits; null or word-free items have no
windows; equal item ids count once; items without an id hit but are not listed; rows that repeat are
judged each for itself; an empty benchmark hits nothing; other columns pass through.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, words
from .fm_index import FMIndex, ranges

WINDOW = 10
BLOCK_BYTES = 4 << 20
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SPAN = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))


class Phrases:
    """The distinct windows of some items, as numbers of a vocabulary of their words."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.vocab: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str | None]] = {}
        for item, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words(text)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[at:at + window]), set()).add(item)
        self.items = [sorted(x for x in s if x is not None) for s in found.values()]
        self.lengths = np.array([len(p) for p in found], np.int64)
        self.codes = np.zeros((len(found), window), np.int32)
        for k, p in enumerate(found):
            self.codes[k, :len(p)] = p
        self.shortest = int(self.lengths.min()) if len(found) else 0


def vocabulary_runs(ids: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of non-zero symbols of at least ``shortest``: the runs joined, each followed by 0, their starts in
    that sequence, and their starts in ``ids``."""
    edge = np.diff(np.concatenate([[0], (ids > 0).astype(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - start >= shortest
    start, end = start[long], end[long]
    size = end - start + 1
    seq_start = np.cumsum(size) - size
    where, run = ranges(start, end + 1)
    seq = np.append(ids, 0)[where]
    seq[seq_start + size - 1] = 0
    return seq, seq_start, start


def shard_hits(phrases: Phrases, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``ids`` where a phrase begins, and the phrase."""
    none = np.empty(0, np.int64)
    if not len(phrases.lengths):
        return none, none
    seq, seq_start, start = vocabulary_runs(ids, phrases.shortest)
    if not len(seq):
        return none, none
    index = FMIndex(seq)
    slots, which = ranges(*index.search(phrases.codes, phrases.lengths))
    if not len(slots):
        return none, none
    pos = index.locate(slots)
    run = np.searchsorted(seq_start, pos, side="right") - 1
    return start[run] + pos - seq_start[run], which


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Inclusive word ranges, sorted and without overlaps; touching ranges become one."""
    out: list[list[int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a, b) for a, b in out]


def _scan(docs: DataFrame, text: str, block, names: tuple[str, str, str], cut: bool) -> DataFrame:
    n_words, spans, items = names
    old = spans in docs.columns
    keep = [c for c in docs.columns if c not in names]
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(n_words, T.LongType()),
                           T.StructField(spans, SPAN), T.StructField(items, T.ArrayType(T.StringType()))])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        phrases = block.value
        get, zero = phrases.vocab.get, itertools.repeat(0)
        for b in batches:
            parts, counts = [], []
            for t in b.column(b.schema.names.index(text)).to_pylist():
                w = words(t)
                counts.append(len(w))
                parts.append(np.fromiter(map(get, w, zero), np.int32, len(w)))
                parts.append(np.zeros(1, np.int32))
            ids = np.concatenate(parts) if parts else np.empty(0, np.int32)
            at = np.concatenate([[0], np.cumsum(np.array(counts, np.int64) + 1)])
            del parts
            pos, which = shard_hits(phrases, ids)
            doc = np.searchsorted(at, pos, side="right") - 1
            found: dict[int, tuple[list, set]] = {}
            if old:
                for k, (s, i) in enumerate(zip(b.column(spans).to_pylist(), b.column(items).to_pylist())):
                    if s:
                        found[k] = [(x["first"], x["last"]) for x in s], set(i)
            for k, first, phrase in zip(doc.tolist(), (pos - at[doc]).tolist(), which.tolist()):
                s, i = found.setdefault(k, ([], set()))
                s.append((first, first + int(phrases.lengths[phrase]) - 1))
                i.update(phrases.items[phrase])
            rows = [found.get(k, ((), ())) for k in range(len(counts))]
            merged = [[{"first": x, "last": y} for x, y in merge(s)] for s, _ in rows]
            cols = {c: b.column(b.schema.names.index(c)) for c in keep}
            if cut and found:
                cols[text] = pa.array([cut_words(t, s) if s else t for t, s in zip(cols[text].to_pylist(), merged)], cols[text].type)
            yield pa.RecordBatch.from_arrays(
                [*cols.values(), pa.array(counts, pa.int64()), pa.array(merged, arrow.field(spans).type),
                 pa.array([sorted(i) for _, i in rows], pa.list_(pa.string())).cast(arrow.field(items).type)],
                schema=arrow)
    return docs.mapInArrow(run, schema)


def find_overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                  names: tuple[str, str, str] = ("n_words", "spans", "items"), cut: bool = False) -> DataFrame:
    """``docs`` plus the number of words, the merged word ranges (inclusive, from 0) that benchmark
    windows cover, and the sorted ids (as strings) of the items they come from.  With ``cut`` the covered words
    are cut out of the text; counts and ranges are those of the text before."""
    clash = set(names) & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t"))
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k) if blocks > 1 else items
        block = spark.sparkContext.broadcast(Phrases([(r.i, r.t) for r in part.collect()], window))
        docs = _scan(docs, text, block, names, cut and k + 1 == blocks)
        if k + 1 < blocks:
            docs = materialise(docs, "overlaps")
    return docs


def digests(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def cut_words(text: str, spans: list[dict]) -> str:
    """The text without these words and what stands between them."""
    raw = text.encode("utf-8", "replace")
    place = [(m.start(), m.end()) for m in _WORD.finditer(raw.lower())]
    out, at = [], 0
    for s in spans:
        out.append(raw[at:place[s["first"]][0]])
        at = place[s["last"]][1]
    return b"".join([*out, raw[at:]]).decode("utf-8")
