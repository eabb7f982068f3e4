"""Operator 2: WARC archives with revisit records, and their url index by an external merge.

Writing: payloads are grouped by SHA-1 (partial minima, so a payload shared by a third of the pages is one
row per task); the smallest page_id of a payload is a response, the others revisit it.  Records are text
(the payload is UTF-8), so Spark's text writer with the record terminator as line separator writes proper WARC/1.1
files, gzipped, into the shared folder, at most ``RECORDS_PER_FILE`` records each.

Reading: a task takes one file at a time, unzips it piece by piece, cuts records by Content-Length and checks every
response payload against its digest, so it holds the zipped file and a record.  The index entries of a file are sorted by (url key, time, page): a run.  Runs are kept as a table,
dealt out by ranges of that order (a popular url is split by time, page and place in the archive), as many as keep a range at about
``RANGE_ENTRIES`` entries however many captures there are.  A range's sorted pieces stay Arrow columns and are merged by a
loser tree that holds a few entries of each, so shard and position give the global order of all captures.

Defined results: a null payload is empty; rows that repeat a page_id each get a record, and are both
responses if they share the smallest id of their payload; a null page_id is a response only if no page with an id
has its payload; a null url is recorded as urn:x-page; controls and blanks in urls are escaped; payloads may hold
anything, record terminators included.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import math
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, shared_path

RECORDS_PER_FILE = 4000
RANGE_ENTRIES = 200_000  # index entries merged by a task
PIECE = 1 << 20          # bytes unzipped at a time
END = "\r\n\r\n"
EPOCH = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ENTRY = ("page_id long, url_key string, time string, record_type string, refers_to long, payload_bytes long, "
         "payload_digest string, file string, offset long, length long")
ORDER = ["url_key", "time", "page_id", "file", "offset"]


def _base32(hex_digest):
    """Bare base32 of a SHA-1 in hex: 40 hex digits are 160 bits, 32 letters."""
    bits = [F.lpad(F.conv(F.substring(hex_digest, k * 5 + 1, 5), 16, 2), 20, "0") for k in range(8)]
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    five = [F.conv(F.substring(b, j * 5 + 1, 5), 2, 10).cast("int") for b in bits for j in range(4)]
    return F.concat(*[F.substring(F.lit(letters), v + 1, F.lit(1)) for v in five])


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """One column ``value``: the WARC record of each page, without the terminator."""
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(page_id).cast("long").alias("page"), F.col(url).alias("url"), body.alias("body"),
                        F.sha1(body.cast("binary")).alias("sha1"))
    first = rows.groupBy("sha1").agg(F.min("page").alias("first"))
    rows = rows.join(first, "sha1")
    response = F.col("page").eqNullSafe(F.col("first"))
    target = F.coalesce("url", F.concat(F.lit("urn:x-page:"), F.col("page").cast("string")), F.lit("urn:x-page:"))
    for c in " \r\n\t<>":
        target = F.replace(target, F.lit(c), F.lit(f"%{ord(c):02X}"))
    name = F.coalesce(F.col("page").cast("string"), F.lit(""))
    # capture time: a second per page id, within 64 years
    time = F.date_format(F.timestamp_seconds(F.lit(int(EPOCH.timestamp())) + F.pmod(F.coalesce("page", F.lit(0)), F.lit(2_000_000_000))),
                         "yyyy-MM-dd'T'HH:mm:ss'Z'")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("body").cast("string"), F.lit(END))
    block = F.concat(head, F.when(response, F.col("body")).otherwise(""))
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(response, F.lit("response")).otherwise("revisit"),
        F.lit("\r\nWARC-Record-ID: <urn:x-page:"), name, F.lit(">\r\nWARC-Date: "), time, F.lit("\r\nWARC-Target-URI: "), target,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(response, F.lit("")).otherwise(F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:x-page:"),
                                                      F.coalesce(F.col("first").cast("string"), F.lit("")), F.lit(">"))),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END))
    return rows.withColumn("digest", _base32(F.col("sha1"))).select(F.concat(header, block).alias("value"))


def write_archives(pages: DataFrame, path: str, **names) -> None:
    (records(pages, **names).write.option("lineSep", END).option("maxRecordsPerFile", RECORDS_PER_FILE)
     .option("compression", "gzip").text(path))


def unzip(data: pa.Buffer) -> Iterator[bytes]:
    """The pieces of a gzip file, of one or several members."""
    left = memoryview(data)
    while len(left):
        member = zlib.decompressobj(31)
        at = 0
        while not member.eof:
            feed = member.unconsumed_tail
            if not feed:
                feed = left[at:at + PIECE]
                at += len(feed)
                if not len(feed):
                    raise ValueError("gzip member is cut short")
            yield member.decompress(feed, PIECE)
        left = left[at - len(member.unused_data):]


def parse(pieces: Iterable[bytes]) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, header, block) of the records of a file that comes in pieces."""
    pieces = iter(pieces)
    raw, at, start = bytearray(), 0, 0  # ``start``: offset of raw in the file

    def fill(need: int) -> bool:
        nonlocal at, start
        while len(raw) - at < need:
            more = next(pieces, None)
            if more is None:
                return False
            del raw[:at]
            start, at = start + at, 0
            raw.extend(more)
        return True

    while fill(1):
        seen = 0
        while (end := raw.find(b"\r\n\r\n", at + max(0, seen - 3))) < 0:
            seen = len(raw) - at
            if not fill(seen + 1):
                raise ValueError(f"record at byte {start + at} is cut short")
        lines = raw[at:end].decode("utf-8").split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at byte {start + at}")
        header = dict(x.split(": ", 1) for x in lines[1:])
        size, head = int(header["Content-Length"]), end + 4 - at
        length = head + size + len(END)
        if not fill(length) or raw[at + head + size:at + length] != END.encode():
            raise ValueError(f"record at byte {start + at} is cut short")
        yield start + at, length, header, bytes(raw[at + head:at + head + size])
        at += length


def url_key(url: str) -> str:
    """Host labels reversed and joined by commas, then the rest, lower-cased."""
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)(.*)", url, re.S)
    return (",".join(reversed(m[1].lower().split("."))) + ")" + (m[2] or "/").lower()) if m else url.lower()


def _page(urn: str) -> int | None:
    digits = urn.rsplit(":", 1)[1].rstrip(">")
    return int(digits) if digits else None


def _entry(file: str, offset: int, length: int, header: dict[str, str], block: bytes) -> tuple:
    cut = block.index(b"\r\n\r\n") + 4
    size = int(re.search(rb"\r\nContent-Length: (\d+)\r\n", block[:cut])[1])
    digest = header["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = header["WARC-Type"]
    if kind == "response":
        payload = block[cut:]
        if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"{file}: payload of {header['WARC-Record-ID']} does not match its digest")
    refers = _page(header["WARC-Refers-To"]) if kind == "revisit" else None
    time = re.sub("[^0-9]", "", header["WARC-Date"])
    return (_page(header["WARC-Record-ID"]), url_key(header["WARC-Target-URI"]), time, kind, refers, size, digest, file, offset, length)


def sort_key(entry: tuple) -> tuple:
    """Order of captures: url key, time, page (null first, as Spark orders)."""
    return entry[1], entry[2], entry[0] is not None, entry[0] or 0, entry[7], entry[8]


def _columns(entries: list[tuple]) -> list[pa.Array]:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    cols = list(zip(*entries)) if entries else [[]] * len(kinds)
    return [pa.array(c, k) for c, k in zip(cols, kinds)]


NAMES = [x.split()[0] for x in ENTRY.split(", ")]


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all archives; those of a file in order (a run named by ``file``)."""
    def run(batches):
        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1)):
                name = file.rsplit("/", 1)[1]
                found = parse(unzip(content.as_buffer())) if content.is_valid else ()
                yield pa.RecordBatch.from_arrays(_columns(sorted((_entry(name, *r) for r in found), key=sort_key)), NAMES)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInArrow(run, ENTRY)


class LoserTree:
    """Merge of k sorted runs: each inner node holds the run that lost there, the winner is replaced by its
    run's next entry and replays only its own path, log2(k) comparisons an entry."""

    def __init__(self, runs: list[Iterable[tuple]]):
        self.heads = [iter(r) for r in runs]
        self.k = max(1, len(runs))
        self.now = [next(h, None) for h in self.heads] or [None]
        self.keys = [None if e is None else sort_key(e) for e in self.now]
        self.losers = [-1] * self.k  # node 0 holds the winner
        for leaf in range(self.k):
            self._replay(leaf)

    def _beats(self, a: int, b: int) -> bool:
        if b < 0 or a < 0:
            return a < 0  # while the tree fills, an empty place goes on
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[b] is None and (self.keys[a] is not None or a < b)
        return (self.keys[a], a) < (self.keys[b], b)

    def _replay(self, run: int) -> None:
        node = (run + self.k) // 2
        while node:
            if self._beats(self.losers[node], run):
                run, self.losers[node] = self.losers[node], run
            node //= 2
        self.losers[0] = run

    def __iter__(self) -> Iterator[tuple]:
        while True:
            run = self.losers[0]
            if self.now[run] is None:
                return
            yield self.now[run]
            self.now[run] = entry = next(self.heads[run], None)
            self.keys[run] = None if entry is None else sort_key(entry)
            self._replay(run)


def entries(piece: pa.RecordBatch, step: int = 64) -> Iterator[tuple]:
    """The rows of a batch, few of them as Python values at a time."""
    for at in range(0, len(piece), step):
        yield from zip(*(c.to_pylist() for c in piece.slice(at, step).columns))


def sorted_pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch cut into stretches that are in order (a run, or what a fetch split off one)."""
    start, last = 0, None
    for k, e in enumerate(entries(batch)):
        key = sort_key(e)
        if last is not None and key < last:
            yield batch.slice(start, k - start)
            start = k
        last = key
    if len(batch):
        yield batch.slice(start)


def merge_runs(runs: DataFrame) -> DataFrame:
    """All entries in global order: shard, then position."""
    n = max(1, math.ceil(runs.count() / RANGE_ENTRIES), int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches):
        lists = [entries(p) for b in batches for p in sorted_pieces(b.select(NAMES))]
        shard, at, out = TaskContext.get().partitionId(), 0, []

        def batch():
            return pa.RecordBatch.from_arrays(
                [*_columns(out), pa.array([shard] * len(out), pa.int32()), pa.array(range(at - len(out), at), pa.int64())],
                [*NAMES, "shard", "position"])
        for e in LoserTree(lists) if lists else ():
            out.append(e)
            at += 1
            if len(out) == 5000:
                yield batch()
                out = []
        if out:
            yield batch()
    return runs.repartitionByRange(n, *ORDER).mapInArrow(run, f"{ENTRY}, shard int, position long")


def numbered(merged: DataFrame) -> DataFrame:
    """``merged`` plus capture_no, the place in the global order: one count per shard carries the offsets."""
    counts = merged.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    offsets = counts.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return merged.join(offsets, "shard").withColumn("capture_no", F.col("before") + F.col("position")).drop("before")


def archive(pages: DataFrame, path: str | None = None, **names) -> DataFrame:
    """Write the pages' archives below ``path`` (a fresh shared folder by default), read them back and return the
    merged index: one row per record, globally ordered by capture_no (shard, then position)."""
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    write_archives(pages, path, **names)
    return numbered(materialise(merge_runs(materialise(read_runs(spark, path), "warc-runs")), "warc-index"))
