"""Operator 12: resampling of documents towards a target text distribution, n-grams hashed by a position-table CRC.

CRC-32 is linear over XOR: a byte adds a value that depends on itself and its distance from the end of the span
alone, and a span's length adds a constant.  Both are tables.  All word ends of a block of texts are handled at once: the bytes of
the last three words up to each end are looked up by (distance, byte) and ``bitwise_xor.reduceat`` folds them word by
word, so runs of one, two and three words share their bytes.  Spans beyond the table fold block by block.

Two passes read the texts.  The first adds up bucket counts in each task, so a bucket costs a task one row whatever the
text; the model is the table of ``BUCKETS`` gains, the only thing that meets on the driver.  The second weighs
documents.  The draw is ordered by ranges of (score, id); one count per range gives the ranks.

Defined results: a null or wordless text has no features and weight 0; rows that repeat an id are judged one by one; a
null id reads as an empty one in the noise and sorts first; with an empty target or corpus the counts are 0 and all
formulas still hold; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

BUCKETS = 10_000
LONGEST = 3           # words of a feature
LEAST_WORDS = 20      # documents with fewer are never drawn
PERCENT = 5
SEED = "42"
DISTANCES = 1024      # bytes of a span that the table covers
TEXT_BLOCK = 1 << 20  # bytes of text prepared at once
SPAN_BLOCK = 1 << 19  # bytes of spans looked up at once

POLYNOMIAL = 0xEDB88320  # fixed value of CRC-32, bits reflected
ONES = 0xFFFFFFFF
# 0-9, a-z and bytes of multi-byte characters stay, A-Z are lowered, the rest separates
_LOWERED = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                 for b in range(256))


def position_table(n: int) -> np.ndarray:
    """Row d: what each byte adds to the CRC at d bytes from the end of the span."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(POLYNOMIAL), step >> 1)
    rows = [step]
    for _ in range(n - 1):
        rows.append((rows[-1] >> 8) ^ step[rows[-1] & 255])
    return np.stack(rows)


TABLE = position_table(DISTANCES)
_FLAT = TABLE.ravel()
_LENGTHS = np.array([zlib.crc32(bytes(n)) for n in range(DISTANCES + 1)], np.uint32)


def _advanced(state: int, n: int) -> int:
    """The CRC register after n zero bytes, n <= DISTANCES: its four bytes act as bytes of the span."""
    while n and n < 4:
        state = (state >> 8) ^ int(TABLE[0, state & 255])
        n -= 1
    if not n:
        return state
    return int(TABLE[n - 1, state & 255] ^ TABLE[n - 2, state >> 8 & 255] ^ TABLE[n - 3, state >> 16 & 255] ^ TABLE[n - 4, state >> 24])


def folded_crc(span: np.ndarray) -> int:
    """CRC-32 of a span of any length: blocks of DISTANCES bytes by the table, the register carried over them."""
    head = len(span) % DISTANCES
    state = _advanced(ONES, head)
    if head:
        state ^= int(np.bitwise_xor.reduce(TABLE[np.arange(head - 1, -1, -1), span[:head]]))
    blocks = span[head:].reshape(-1, DISTANCES)
    back = np.arange(DISTANCES - 1, -1, -1)
    for at in range(0, len(blocks), 256):
        for value in np.bitwise_xor.reduce(TABLE[back, blocks[at:at + 256]], axis=1).tolist():
            state = _advanced(state, DISTANCES) ^ value
    return state ^ ONES


def _table_crcs(buf, starts, ends, first, j) -> tuple[np.ndarray, np.ndarray]:
    """(rows of j, CRCs) of the features that end with the words ``j``, whose spans fit the table."""
    lo, hi = starts[np.maximum(first[j], j - 2)], ends[j]
    size = hi - lo
    off = np.cumsum(size) - size
    place = np.arange(int(size.sum())) + np.repeat(lo - off, size)
    value = _FLAT[(np.repeat(hi - 1, size) - place) * 256 + buf[place]]
    n = np.minimum(j - first[j], LONGEST - 1)             # words before the last one
    has = np.stack([n >= 2, n >= 1, n >= 0], 1)
    begin = np.stack([lo, starts[np.maximum(j - 1, 0)], starts[j]], 1)
    folded = np.zeros(has.shape, np.uint32)
    folded[has] = np.bitwise_xor.reduceat(value, (begin + (off - lo)[:, None])[has])
    folded = np.bitwise_xor.accumulate(folded[:, ::-1], axis=1)[:, ::-1]
    crc = folded[has] ^ _LENGTHS[(hi[:, None] - begin)[has]]
    return np.broadcast_to(np.arange(len(j))[:, None], has.shape)[has], crc


def _blocks_of(size: np.ndarray, limit: int) -> Iterator[slice]:
    """Slices of consecutive items whose sizes add up to about ``limit``."""
    cuts = np.flatnonzero(np.diff(np.cumsum(size) // limit, prepend=0)).tolist()
    edges = sorted({0, *cuts, len(size)})
    yield from (slice(a, b) for a, b in zip(edges, edges[1:]))


def feature_crcs(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, CRC-32 of the feature) of all runs of 1 to LONGEST words, in blocks."""
    found = [(t or b"").translate(_LOWERED).split() for t in texts]
    counts = np.array([len(w) for w in found], np.int64)
    buf = np.frombuffer(b" ".join(b" ".join(w) for w in found if w), np.uint8)
    if not counts.sum():
        return
    gaps = np.flatnonzero(buf == 0x20)
    starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(buf)]])
    of = np.repeat(np.arange(len(texts)), counts)
    first = np.repeat(np.cumsum(counts) - counts, counts)
    word = np.arange(len(starts))
    size = ends - starts[np.maximum(first, word - 2)]
    short = word[size <= DISTANCES]
    for part in _blocks_of(size[short], SPAN_BLOCK):
        j = short[part]
        if len(j):
            row, crc = _table_crcs(buf, starts, ends, first, j)
            yield of[j][row], crc
    for j in word[size > DISTANCES].tolist():
        spans = [buf[starts[k]:ends[j]] for k in range(j, max(int(first[j]), j - 2) - 1, -1)]
        yield np.full(len(spans), of[j]), np.array([folded_crc(s) for s in spans], np.uint32)


def _text_blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[bytes | None]]]:
    """(from, to, texts) of rows with about TEXT_BLOCK bytes."""
    column = batch.column("text")
    size = np.asarray(pc.fill_null(pc.binary_length(column), 0)).astype(np.int64)
    for part in _blocks_of(size, TEXT_BLOCK):
        yield part.start, part.stop, column.slice(part.start, part.stop - part.start).to_pylist()


def bucket_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(bucket, n): features of all texts, added up in each task first."""
    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for _, _, block in _text_blocks(b):
                for _, crc in feature_crcs(block):
                    total += np.bincount(crc % BUCKETS, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["bucket", "n"])
    return (texts.select(F.col(text).cast("binary").alias("text")).mapInArrow(run, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(docs: DataFrame, target: DataFrame, text: str = "text") -> np.ndarray:
    """The model, one gain per bucket, from all of both tables (at most BUCKETS rows come to the driver)."""
    raw, wanted = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for into, table in ((raw, docs), (wanted, target)):
        for r in bucket_counts(table, text).collect():
            into[r.bucket] = r.n
    s_all, t_all = float(raw.sum()) + BUCKETS, float(wanted.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(raw.tolist(), wanted.tolist())], np.int64)


def scored(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every document."""
    def run(batches):
        for b in batches:
            words, n, weight = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            for lo, hi, block in _text_blocks(b):
                for of, crc in feature_crcs(block):
                    n[lo:hi] += np.bincount(of, minlength=hi - lo)
                    weight[lo:hi] += np.bincount(of, gain[crc % BUCKETS], hi - lo).astype(np.int64)
            # n words make n + (n - 1) + (n - 2) features, one makes one, two make three
            words = np.where(n >= LONGEST, n // 3 + 1, (n + 1) // 2)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, (words, n, weight))],
                                             ["doc_id", "n_words", "n_features", "weight"])
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    out = rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return out.withColumn("score", F.col("weight") + noise)


def ranked(scores: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scores`` with rank: place among the drawn, null for the rest.

    Ranges of (score, id) are sorted on their own; a range's number and a row's place in it come from one written id, so the
    count of each range (one row a partition) gives all ranks without an order over one task."""
    order = [F.col("score").desc(), F.col("doc_id").asc()]
    able = F.col("n_words") >= least_words
    placed = materialise(scores.where(able).repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_at", F.monotonically_increasing_id()), "draw")
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(every).alias("_all"))
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    drawn = place <= F.floor(F.lit(percent) * F.col("_all") / 100)
    ranks = placed.join(F.broadcast(starts), "_range").withColumn("rank", F.when(drawn, place).cast("long"))
    rest = scores.where(~able).withColumn("rank", F.lit(None).cast("long"))
    return ranks.select(rest.columns).unionByName(rest)


def draw(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """Every document's features, weight, score and rank (1, 2, 3... among the drawn share, else null)."""
    model = gains(docs, target, text)
    return ranked(materialise(scored(docs, model, doc_id, text), "draw-scores"), percent)
