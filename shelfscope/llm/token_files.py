"""Operator 11: token ids as Arrow files of equal-length sequences, read back without copying.

Documents are dealt out by ranges of doc_id and sorted in each, so partition and shard number give the global order.  A task
encodes its documents one after the other, ends each with ``END_ID`` and cuts the stream after whole documents into
shards of about ``SHARD_IDS`` ids.  A shard is one Arrow file (a record-batch stream between magic and footer):

    ids      fixed_size_list<uint16 or uint32>[SEQUENCE]   the shard's ids in order, the last sequence padded with 0
    mask     fixed_size_list<bool>[SEQUENCE]               true where an id belongs to a document
    doc_ids  list<int64>                                   documents that begin in the sequence ...
    begins   list<int32>                                   ... and their places in it

plus the shard's place in the order as schema metadata.  All sequences are of one length, so sequence i lies at a computable place of a
mapped file and ids and masks are views of it (``TokenFile``).  Files are written by Spark's text writer, one row a file
with Arrow's closing magic as line separator, so they go to any store, are committed once and survive lost executors; they are
read by the binary source.

Texts are encoded by the tokenizers library once per distinct blank-delimited chunk, remembered in a bounded dictionary: this
tokenizer drops white space, and neither its normaliser nor its patterns reach across a blank or line feed, so the ids of a
text are those of its chunks in a row (tested against whole texts).

Defined results: a null or empty text is its end id alone; rows that repeat an id stand beside each other (by text) and each
count; null ids come first; a document longer than a shard is a shard of its own; an empty table writes no file and gives no rows;
other columns are not read.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, shared_path

END_ID = 2
SEQUENCE = 2048
BATCH = 64            # sequences of a record batch
SHARD_IDS = 1 << 20   # ids of a shard
REMEMBERED = 800_000  # distinct chunks in a generation of a worker's dictionary
LONG_CHUNK = 64       # longer chunks are not remembered
MAGIC = "ARROW1"      # ends an Arrow file
META = b"token_file"


class ChunkEncoder:
    """ids of whole texts as bytes, by chunks between blanks and line feeds.

    New chunks that are a word of Latin letters, perhaps with marks behind it (no apostrophe, no ``<``, which may begin a
    special token), are encoded many at a time: the patterns cut them into the word and the marks, and each word's last
    token carries the end-of-word suffix, which tells where its ids stop.  Any other chunk is encoded by itself.  Two generations of a dictionary hold what was seen: the young one
    takes over what the old one still serves, and becomes the old one when it is full."""

    LINE = re.compile("^(?:([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+)([!-&(-/:;=-@[-`{-~]*)|.*)$", re.M)
    TEXTS, JOINED = 32, 2000  # texts looked up and words joined at once

    def __init__(self, file: str, dtype: np.dtype):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer, self.dtype, self.young, self.old = Tokenizer.from_file(file), dtype, {}, {}
        self.pack = [struct.Struct(f"<{n}{'H' if dtype.itemsize == 2 else 'I'}").pack for n in range(64)]
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True

    def _ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            yield np.array(e.ids, self.dtype)

    def _alone(self, chunks: list[str]) -> dict[str, bytes]:
        return {c: ids.tobytes() for c, ids in zip(chunks, self._ids(chunks))}

    def _words(self, words: list[str]) -> dict[str, bytes]:
        out, pack, tokens = {}, self.pack, self.tokenizer.model.tokenize
        for w in words:
            if w.isascii():  # lower-case letters, which normaliser, patterns and byte map leave as they are
                ids = [t.id for t in tokens(w)]
                out[w] = pack[len(ids)](*ids) if len(ids) < len(pack) else np.array(ids, self.dtype).tobytes()
        words = [w for w in words if w not in out]
        for k in range(0, len(words), self.JOINED):
            some = words[k:k + self.JOINED]
            ids = next(self._ids([" ".join(some)]))
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some):  # a tokenizer without the suffix
                out |= self._alone(some)
                continue
            raw, cuts = ids.tobytes(), (cuts * self.dtype.itemsize).tolist()
            out.update((w, raw[a:b]) for w, a, b in zip(some, [0, *cuts], cuts))
        return out

    def _learn(self, chunks: set[str]) -> None:
        young, old, unseen = self.young, self.old, []
        for c in chunks:
            if c in old:
                young[c] = old[c]
            else:
                unseen.append(c)
        if not unseen:
            return
        parts = self.LINE.findall("\n".join(unseen))  # a chunk holds no line feed: (word, marks) of each, both empty if it is no word
        words = "\n".join([w for w, _ in parts]).lower().split("\n")
        new = {w for w in words if w and w not in young}
        young.update([(w, old[w]) for w in new if w in old])
        young.update(self._words([w for w in new if w not in young]))
        young.update(self._alone([*[c for c, w in zip(unseen, words, strict=True) if not w], *{m for _, m in parts if m and m not in young}]))
        young.update([(c, young[w] + young[m] if m else young[w]) for c, w, (_, m) in zip(unseen, words, parts, strict=True) if w])

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        texts = iter(texts)
        while some := list(islice(texts, self.TEXTS)):
            cut = [(t or "").replace("\n", " ").split(" ") for t in some]
            known = self.young
            new = set().union(*cut).difference(known)
            self._learn(new)
            for chunks in cut:
                yield b"".join(map(known.__getitem__, chunks))
            for c in new:
                if len(c) > LONG_CHUNK:
                    del known[c]
            if len(known) > REMEMBERED:
                self.young, self.old = {}, known


@functools.lru_cache(1)
def encoder(file: str, dtype: str) -> ChunkEncoder:
    """One encoder a worker process: its dictionary serves all tasks that the worker runs."""
    return ChunkEncoder(file, np.dtype(dtype))


def vocabulary_type(file: str) -> np.dtype:
    from tokenizers import Tokenizer
    return np.dtype("<u2" if Tokenizer.from_file(file).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")


def shard_file(docs: list[tuple[int | None, bytes]], dtype: np.dtype, place: dict) -> bytes:
    """The Arrow file of whole documents (id, ids with the end id)."""
    flat = np.frombuffer(b"".join(ids for _, ids in docs), dtype)
    rows = -(-len(flat) // SEQUENCE)
    ids = np.zeros(rows * SEQUENCE, dtype)
    ids[:len(flat)] = flat
    sizes = np.array([len(x) // dtype.itemsize for _, x in docs], np.int64)
    starts = np.cumsum(sizes) - sizes
    edges = pa.array(np.searchsorted(starts, np.arange(rows + 1) * SEQUENCE), pa.int32())
    mask = np.packbits(np.arange(rows * SEQUENCE) < len(flat), bitorder="little")
    mask = pa.Array.from_buffers(pa.bool_(), rows * SEQUENCE, [None, pa.py_buffer(mask)])
    columns = [pa.FixedSizeListArray.from_arrays(pa.array(ids), SEQUENCE), pa.FixedSizeListArray.from_arrays(mask, SEQUENCE),
               pa.ListArray.from_arrays(edges, pa.array([i for i, _ in docs], pa.int64())),
               pa.ListArray.from_arrays(edges, pa.array(starts % SEQUENCE, pa.int32()))]
    meta = place | {"sequence": SEQUENCE, "batch": BATCH, "end_id": END_ID, "n_ids": len(flat), "n_docs": len(docs)}
    table = pa.table(columns, ["ids", "mask", "doc_ids", "begins"]).replace_schema_metadata({META: json.dumps(meta)})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, table.schema) as out:
        out.write_table(table, max_chunksize=BATCH)
    return sink.getvalue().to_pybytes()


class TokenFile:
    """Random access to a shard: ``ids`` and ``mask`` of sequence i are views of the mapped file (or given buffer)."""

    def __init__(self, source):
        self.source = pa.memory_map(source) if isinstance(source, str) else pa.BufferReader(source)
        self.reader = pa.ipc.open_file(self.source)
        self.meta = json.loads(self.reader.schema.metadata[META])
        self.sequence = self.meta["sequence"]

    def __len__(self) -> int:
        return -(-self.meta["n_ids"] // self.sequence)

    def _row(self, i: int) -> tuple[pa.RecordBatch, int]:
        if not 0 <= i < len(self):
            raise IndexError(i)
        return self.reader.get_batch(i // self.meta["batch"]), i % self.meta["batch"]

    def ids(self, i: int) -> np.ndarray:
        batch, row = self._row(i)
        return batch.column("ids").values.to_numpy(zero_copy_only=True)[row * self.sequence:(row + 1) * self.sequence]

    def mask(self, i: int) -> pa.BooleanArray:
        """The sequence's bits, a slice of the file's bit map."""
        batch, row = self._row(i)
        return batch.column("mask").values.slice(row * self.sequence, self.sequence)

    def stream(self) -> np.ndarray:
        """All ids of the shard's documents."""
        parts = [self.reader.get_batch(k).column("ids").values.to_numpy() for k in range(self.reader.num_record_batches)]
        valid = [self.reader.get_batch(k).column("mask").values.to_numpy(zero_copy_only=False) for k in range(self.reader.num_record_batches)]
        return np.concatenate(parts)[np.concatenate(valid)]

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        """(doc_id, start, n) of the shard's documents, places in the shard's stream."""
        found = []
        for k in range(self.reader.num_record_batches):
            b = self.reader.get_batch(k)
            for r, (ids, at) in enumerate(zip(b.column("doc_ids").to_pylist(), b.column("begins").to_pylist())):
                found += [(i, (k * self.meta["batch"] + r) * self.sequence + a) for i, a in zip(ids, at)]
        ends = chain((s for _, s in found[1:]), [self.meta["n_ids"]])
        yield from ((i, s, e - s) for (i, s), e in zip(found, ends))


def write_files(docs: DataFrame, path: str, tokenizer_file: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode all documents in ascending doc_id order into token files below ``path``."""
    dtype = vocabulary_type(tokenizer_file)
    end = np.array([END_ID], dtype).tobytes()

    def run(batches):
        shard, number, held = [], 0, 0

        def flush():
            place = {"partition": TaskContext.get().partitionId(), "shard": number}
            return pa.RecordBatch.from_arrays([pa.array([shard_file(shard, dtype, place)[:-len(MAGIC)]], pa.binary())], ["value"])

        for b in batches:
            texts = (t.as_py() for t in b.column("text"))
            for i, ids in zip(b.column("doc_id").to_pylist(), encoder(tokenizer_file, dtype.str).encode(texts)):
                shard.append((i, ids + end))
                held += len(ids) // dtype.itemsize + 1
                if held >= SHARD_IDS:
                    yield flush()
                    shard, held, number = [], 0, number + 1
        if shard:
            yield flush()
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    (rows.repartitionByRange(*order).sortWithinPartitions(*order, "text").mapInArrow(run, "value binary")
     .select(F.col("value").cast("string")).write.option("lineSep", MAGIC).option("maxRecordsPerFile", 1)
     .option("compression", "none").text(path))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(partition, shard, doc_id, place, n_tokens, ids_crc32) of every document of the files below ``path``."""
    def run(batches):
        for b in batches:
            for content in b.column("content"):
                if not len(content.as_buffer()):
                    continue
                file = TokenFile(content.as_buffer())
                flat = memoryview(file.stream().astype("<u4")).cast("B")
                found = list(file.documents())
                if len(found) != file.meta["n_docs"] or len(flat) != 4 * file.meta["n_ids"]:
                    raise ValueError(f"token file {file.meta} is cut short")
                ids, at, n = zip(*found)
                crc = [zlib.crc32(flat[4 * s:4 * (s + k)]) for s, k in zip(at, n)]
                where = [pa.array([file.meta[x]] * len(found), pa.int32()) for x in ("partition", "shard")]
                yield pa.RecordBatch.from_arrays(
                    [*where, *(pa.array(x, pa.int64()) for x in (ids, at, n, crc))],
                    ["partition", "shard", "doc_id", "place", "n_tokens", "ids_crc32"])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("content")
    return files.mapInArrow(run, "partition int, shard int, doc_id long, place long, n_tokens long, ids_crc32 long")


def placed(read: DataFrame) -> DataFrame:
    """``read`` plus start, the ids of all documents before: shard totals within a partition, then partition totals."""
    shards = read.groupBy("partition", "shard").agg(F.sum("n_tokens").alias("n"))
    inner = Window.partitionBy("partition").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    parts = shards.groupBy("partition").agg(F.sum("n").alias("n")).select(
        "partition", F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("before_partition"))
    starts = (shards.withColumn("before_shard", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(parts, "partition")
              .select("partition", "shard", (F.col("before_partition") + F.col("before_shard")).alias("before")))
    return read.join(starts, ["partition", "shard"]).withColumn("start", F.col("before") + F.col("place")).drop("before")


def tokenise(docs: DataFrame, tokenizer_file: str, path: str | None = None, **names) -> DataFrame:
    """Write the documents' token files below ``path`` (a fresh shared folder by default) and return what they hold:
    doc_id, start, n_tokens, ids_crc32 and the place in the files (partition, shard, place)."""
    spark = docs.sparkSession
    path = path or shared_path(spark, "tokens")
    write_files(docs, path, tokenizer_file, **names)
    return placed(materialise(read_files(spark, path), "token-index"))
