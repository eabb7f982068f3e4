"""Operator 9: line dedup by content-defined chunks of lines.

Every line has a 126-bit hash.  A rolling hash over ``WINDOW`` line hashes before and after each gap between two lines gives the gap
a level, its number of trailing zero bits; gaps of at least k zero bits are the borders of layer k, and layer 0 has one
wherever the last two bits are not both set.  The window is one line on either side, so a border moves only with the lines next to
it and a passage has the same inner borders in whatever stands around it.  Layers 0 to ``LAYERS`` are nested, from
chunks of a line or two to long ones; equal ranges of two layers are one chunk.

A chunk that occurs more than once is tied to its first place (smallest doc_id, then text hash, then line): document, first document
and distance make an alignment, and along each alignment all runs of equal lines are found, which extends the chunk line by
line to both sides.  A run of at least two non-blank lines, or with a line of ``LONG_WORDS`` words, is removed,
without blank lines at its ends, after the bytes of its lines were compared with the kept ones.  A removed line always equals a line at
an earlier place, so the first place of a line stays.

Plan: (1) chunk hashes with their smallest and largest place, added up in partial aggregates, so a hash shared by a third of
the corpus is a row a task; (2) only places of repeated chunks are joined with the kept one (AQE splits a hot hash) and give
distinct alignments; (3) the line hashes of both documents, cut to the overlap, give the runs; (4) the texts meet their runs in one
shuffle, which serves both the comparison of bytes (smallest and largest line of each hash) and the cut.  No group is collected but
the runs and kept lines of a document, which its length bounds; no pair of places is made.

Defined results: rows equal in doc_id and text are one document and share their fate; null and empty texts pass
through; a text that loses every line becomes '' (``drop_emptied`` drops such rows); lines end at "\\n" only; other columns
pass through, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, nullable

WINDOW = 1        # lines under the rolling hash on either side of a gap
LAYERS = 3        # the coarsest layer; layer k has a border where k bits are zero
MIN_LINES = 2
LONG_WORDS = 50
FILLED, LONG = 1, 2  # low bits of a line's hash
_SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # for the lines before and after a gap
_WORD_BYTES = bytes(b if chr(b).isalnum() or b >= 0x80 else 0x20 for b in range(256))


def _lines(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").split(b"\n") if text else []


def line_hashes(lines: list[bytes]) -> np.ndarray:
    """A row of two 64-bit words for each line; the lowest bits tell whether it is blank and whether it is long."""
    out = np.frombuffer(b"".join([hashlib.blake2b(x, digest_size=16).digest() for x in lines]), "<u8").reshape(-1, 2).copy()
    flags = [(FILLED if x.strip() else 0) | (LONG if len(x) >= 2 * LONG_WORDS - 1 and len(x.translate(_WORD_BYTES).split()) >= LONG_WORDS else 0)
             for x in lines]
    out[:, 0] = out[:, 0] & ~np.uint64(3) | np.array(flags, "<u8")
    return out


def gap_levels(hashes: np.ndarray) -> np.ndarray:
    """Level of the gap before each line from the second on: zero bits of the rolling hash on its better side, -1 if
    both end in two set bits."""
    with np.errstate(over="ignore"):
        sides = []
        for spread, lines in zip(_SPREAD, (hashes[:-1, 1], hashes[1:, 1])):
            rolled = (lines * spread) >> np.uint64(32)
            low = rolled & (~rolled + np.uint64(1))  # lowest bit that is set
            zeros = np.where(low == 0, 32, np.log2(np.maximum(low, np.uint64(1)).astype(float))).astype(np.int64)
            sides.append(np.where(rolled & np.uint64(3) == np.uint64(3), -1, zeros))
    return np.maximum(*sides)


def chunks(hashes: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) line ranges of all layers that hold a line that is not blank."""
    n = len(hashes)
    if not n:
        return []
    level, filled = gap_levels(hashes), np.concatenate([[0], np.cumsum(hashes[:, 0] & np.uint64(FILLED))])
    out = set()
    for k in range(LAYERS + 1):
        edges = [0, *(np.flatnonzero(level >= k) + 1).tolist(), n]
        out.update((a, b) for a, b in zip(edges, edges[1:]) if filled[b] > filled[a])
    return sorted(out)


def _hashed(batches):
    """id, text, text_hash -> the document's line hashes and the hashes of its chunks."""
    for b in batches:
        rows = []
        for text in b.column(1).to_pylist():
            hashes = line_hashes(_lines(text))
            raw = hashes.tobytes()
            rows.append((raw, [{"start": s, "end": e, "hash": hashlib.blake2b(raw[16 * s:16 * e], digest_size=16).digest()}
                               for s, e in chunks(hashes)]))
        raw, found = zip(*rows) if rows else ((), ())
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("hash", pa.binary())]))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(raw, pa.binary()), pa.array(found, kind)],
                                         ["id", "text_hash", "lines", "chunks"])


def equal_runs(here: np.ndarray, there: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of equal lines that are worth removing, without blank lines at the ends."""
    same = np.concatenate([[False], (here == there).all(axis=1), [False]])
    edges = np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2)
    out = []
    for s, e in edges.tolist():
        flags = here[s:e, 0]
        full = np.flatnonzero(flags & np.uint64(FILLED))
        if len(full) >= MIN_LINES or (flags & np.uint64(LONG)).any():
            out.append((s + int(full[0]), s + int(full[-1]) + 1))
    return out


def _runs(batches):
    """Overlapping lines of two documents -> the runs to remove, by their first line in either document."""
    for b in batches:
        at, start, end = [], [], []
        for k, (here, there) in enumerate(zip(b.column("here"), b.column("there"))):
            here, there = (np.frombuffer(x.as_buffer(), "<u8").reshape(-1, 2) for x in (here, there))
            n = min(len(here), len(there))
            for s, e in equal_runs(here[:n], there[:n]):
                at.append(k)
                start.append(s)
                end.append(e)
        at = pa.array(at, pa.int64())
        begins = [np.asarray(b.column(c).take(at)) + np.array(start, np.int64) for c in ("from_line", "kept_from")]
        yield pa.RecordBatch.from_arrays(
            [b.column("key").take(at), b.column("kept").take(at), *map(pa.array, begins), pa.array(np.array(end, np.int64) - np.array(start, np.int64))],
            ["key", "kept", "start", "kept_start", "n"])


def runs_to_remove(keyed: DataFrame) -> DataFrame:
    """(key, kept, start, kept_start, n): n lines from ``start`` repeat those of the earlier document from ``kept_start``."""
    kind = keyed.schema["id"].dataType.simpleString()
    found = materialise(keyed.mapInArrow(_hashed, f"id {kind}, text_hash long, lines binary, chunks array<struct<start int, end int, hash binary>>"),
                        "line-chunks")
    key = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    places = found.select(key.alias("key"), F.explode("chunks").alias("c")).select(F.col("c.hash").alias("hash"), F.struct("key", F.col("c.start").alias("start")).alias("place"))
    repeated = places.groupBy("hash").agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first != last").drop("last")
    alignments = (places.join(repeated, "hash").where("place != first")
                  .select(F.col("place.key").alias("key"), F.col("first.key").alias("kept"),
                          (F.col("first.start") - F.col("place.start")).alias("shift")).distinct())
    lines = found.groupBy(key.alias("key")).agg(F.first("lines").alias("lines"))
    both = (alignments.join(lines.withColumnRenamed("lines", "here"), "key")
            .join(lines.select(F.col("key").alias("kept"), F.col("lines").alias("there")), "kept")
            .withColumns({"from_line": F.greatest(F.lit(0), -F.col("shift")).cast("long"), "kept_from": F.greatest(F.lit(0), F.col("shift")).cast("long")}))
    # the overlap of the two documents at this distance, so that neither is longer than the shorter one
    both = both.withColumn("n", F.least(F.octet_length("here") / 16 - F.col("from_line"), F.octet_length("there") / 16 - F.col("kept_from")).cast("int"))
    both = both.select("key", "kept", "from_line", "kept_from",
                       *(F.expr(f"substring({c}, cast(16 * {a} + 1 as int), 16 * n)").alias(c) for c, a in (("here", "from_line"), ("there", "kept_from"))))
    where = f"struct<no_id: boolean, id: {kind}, text_hash: bigint>"
    return materialise(both.mapInArrow(_runs, f"key {where}, kept {where}, start long, kept_start long, n long"), "line-runs")


def _parts(runs: DataFrame) -> DataFrame:
    """Per document: the ranges to remove and the single lines that others are compared with (both bounded by its length)."""
    gone = runs.select("key", F.col("start").alias("s"), (F.col("start") + F.col("n")).alias("e"), F.lit(False).alias("stays")).distinct()
    kept = (runs.select("kept", "kept_start", "n").distinct()
            .select(F.col("kept").alias("key"), F.explode(F.expr("sequence(kept_start, kept_start + n - 1)")).alias("s")).distinct()
            .select("key", "s", (F.col("s") + 1).alias("e"), F.lit(True).alias("stays")))
    return gone.unionByName(kept).groupBy("key").agg(F.collect_list(F.struct("s", "e", "stays")).alias("parts"))


def cut_lines(text: str, ranges: list[dict], bad: set[bytes] = frozenset()) -> tuple[str, int]:
    """The text without the lines of the ranges, which may overlap, and how many lines went; a range with a hash in ``bad`` stays."""
    lines = text.split("\n")
    gone: set[int] = set()
    for r in ranges:
        if not bad or not bad & {_digest(x.encode("utf-8", "replace")) for x in lines[r["s"]:r["e"]]}:
            gone.update(range(r["s"], r["e"]))
    return "\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone)


def _digest(line: bytes) -> bytes:
    return hashlib.blake2b(line, digest_size=16).digest()


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", drop_emptied: bool = False,
                removed: str = "removed_lines") -> DataFrame:
    """``docs`` with repeated chunks cut out of the text, and the number of lines removed."""
    if removed in docs.columns:
        raise ValueError(f"column {removed} exists already")
    at = docs.columns.index(text)
    keyed = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    parts = _parts(runs_to_remove(keyed))
    # the documents travel as one struct, so no name of theirs meets one of this function's
    whole = docs.select(F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"), F.xxhash64(text).alias("text_hash")).alias("own"),
                        F.struct(*(docs[c] for c in docs.columns)).alias("doc"))
    both = whole.join(parts, F.col("own").eqNullSafe(F.col("key")), "left").select("doc", "parts")

    def bodies(batches):
        for b in batches:
            seen = {}
            for doc, found in zip(b.column(0).field(at), b.column(1)):
                if found.is_valid:
                    lines = _lines(doc.as_py())
                    for p in found.as_py():
                        seen.update((x, _digest(x)) for x in lines[p["s"]:p["e"]] if x not in seen)
            yield pa.RecordBatch.from_arrays([pa.array(seen.values(), pa.binary()), pa.array(seen.keys(), pa.binary())], ["hash", "body"])

    # equal hashes of different bytes: none is expected, and one row carries what there is
    unequal = (both.mapInArrow(bodies, "hash binary, body binary").groupBy("hash")
               .agg(F.min("body").alias("a"), F.max("body").alias("b")).where("a != b").agg(F.collect_list("hash").alias("bad")))
    schema = T.StructType([*nullable(docs.schema).fields, T.StructField(removed, T.LongType())])

    def cut(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for b in batches:
            cols, n, keep = b.column(0).flatten(), np.zeros(b.num_rows, np.int64), None
            found, bad = b.column(1), b.column(2)
            if found.null_count < b.num_rows:
                texts, stays = cols[at].to_pylist(), [True] * b.num_rows
                for k, (r, h) in enumerate(zip(found, bad)):
                    r = [p for p in r.as_py() if not p["stays"]] if r.is_valid else []
                    if r:
                        texts[k], n[k] = cut_lines(texts[k], r, set(h.as_py()))
                        stays[k] = bool(texts[k].strip()) or not n[k]
                cols[at], keep = pa.array(texts, cols[at].type), pa.array(stays)
            out = pa.RecordBatch.from_arrays([*cols, pa.array(n)], schema=arrow)
            yield out.filter(keep) if drop_emptied and keep is not None else out
    return both.join(F.broadcast(unequal)).mapInArrow(cut, schema)
