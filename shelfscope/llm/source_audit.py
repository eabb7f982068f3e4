"""Operator 13: how the sources of a language differ in their words, from term counts in exact arithmetic.

``bytes.translate`` lowers A-Z and blanks separators in one pass, ``bytes.split`` cuts terms, and a Counter per document
gives frequencies; a task adds documents of a (lang, source) group up before rows leave it, so a hot source or word is a few
rows a task.  Counts stay sparse: terms a group lacks share one probability.

The distance of two sources is V * |p0 - q0| for absent terms plus, over terms that occur, the difference to that.  Terms are dealt
into blocks of about ``TERMS`` and sources into blocks of ``SOURCES``; a block pair is one small matrix, whose partial sums (a
row per pair of sources, not per term) are added up.  So memory is bounded by the block and no term emits pairs.

Defined results: null text, lang and source read as empty ones; text without terms still makes its group occur; a
language without kept terms has all distances 0 and no term rows; repeated rows count as often as they
occur, repeated ids too (ids are not read); a single source has no pair rows; empty tables give no rows; other
columns are not read.
"""

from __future__ import annotations

from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_groups, materialise

LEAST_DOCS = 30       # documents of the language that hold a kept term
SMOOTHING = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
TERMS, SOURCES = 4096, 128  # terms and sources of a block
PENDING = 100_000     # distinct (group, term) a task holds before it sends them on

# A-Z are lowered, a-z and bytes of multi-byte characters stay, the rest separates
_LOWERED = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_LOWERED).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group."""
    def run(batches):
        pending: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0

        def rows():
            keys = [(g, t, n, d[t]) for g, (f, d) in pending.items() for t, n in f.items()]
            return pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g, *_ in keys], pa.string()), pa.array([g[1] for g, *_ in keys], pa.string()),
                 pa.array([k[1] for k in keys], pa.binary()), pa.array([k[2] for k in keys], pa.int64()),
                 pa.array([k[3] for k in keys], pa.int64())], ["lang", "source", "term", "n", "docs"])

        for b in batches:
            langs, sources, texts = (b.column(c) for c in ("lang", "source", "text"))
            for lang, source, text in zip(langs.to_pylist(), sources.to_pylist(), (t.as_py() for t in texts)):
                one = Counter(terms(text))
                total, documents = pending.setdefault((lang, source), (Counter(), Counter()))
                held -= len(total)
                total.update(one)
                documents.update(one.keys())
                held += len(total)
                if held >= PENDING:
                    yield rows()
                    pending, held = {}, 0
        if held:
            yield rows()
    out = docs.mapInArrow(run, "lang string, source string, term binary, n long, docs long")
    return out.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def smoothed(count, total, v):
    """1 + floor(SCALE * (count + SMOOTHING) / (total + SMOOTHING * v)), in whole numbers; null without kept terms."""
    over = (F.col(total) + F.lit(SMOOTHING) * F.col(v)).cast("decimal(38,0)")
    share = (F.lit(SCALE).cast("decimal(19,0)") * (count + SMOOTHING).cast("decimal(19,0)")).cast("decimal(38,0)")
    return F.when(F.col(v) > 0, F.call_function("div", share, over) + 1)


def kept_cells(docs: DataFrame) -> DataFrame:
    """Counts of the kept terms per group, with the term's count in the whole language and a mark on one row a term."""
    term = Window.partitionBy("lang", "term")
    return (term_counts(docs)
            .withColumns({"lang_docs": F.sum("docs").over(term), "lang_n": F.sum("n").over(term),
                          "one": (F.row_number().over(term.orderBy("source")) == 1).cast("long")})
            .where(F.col("lang_docs") >= LEAST_DOCS).select("lang", "source", "term", "n", "lang_n", "one"))


def group_stats(docs: DataFrame, cells: DataFrame) -> DataFrame:
    """Every occurring group: number in its language (by source), n_group, v and n_lang over kept terms, p0 of absent terms."""
    langs = cells.groupBy("lang").agg(F.sum("one").alias("v"), F.sum("n").alias("n_lang"))
    groups = cells.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    out = (docs.select("lang", "source").distinct().join(groups, ["lang", "source"], "left").join(langs, "lang", "left")
           .fillna(0, ["v", "n_lang", "n_group"])
           .withColumn("sid", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1))
    return out.withColumn("p0", F.coalesce(smoothed(F.lit(0), "n_group", "v"), F.lit(0)))


def _block_sums(g: pa.RecordBatch, block_sources: int) -> dict | None:
    """Sum over the block's terms of |p - q| - |p0 - q0| for each pair of sources of block i and block j (sid < sid2)."""
    col = {n: g.column(g.schema.names.index(n)) for n in g.schema.names}
    sid, p = np.asarray(col["sid"]), np.asarray(col["p"])
    base = np.asarray(pc.is_null(col["term"]))
    order = np.argsort(sid[base])
    sids, p0 = sid[base][order], p[base][order]
    term = col["term"].filter(pa.array(~base)).dictionary_encode()
    if not len(term) or len(sids) < 2:
        return None
    m = np.repeat(p0[:, None], len(term.dictionary), axis=1)
    m[np.searchsorted(sids, sid[~base]), np.asarray(term.indices)] = p[~base]
    i, j = col["i"][0].as_py(), col["j"][0].as_py()
    left, right = np.flatnonzero(sids // block_sources == i), np.flatnonzero(sids // block_sources == j)
    out = []
    for a in left.tolist():
        b = right[right > a]
        out.append((np.full(len(b), sids[a]), sids[b],
                    np.abs(m[b] - m[a]).sum(axis=1) - m.shape[1] * np.abs(p0[b] - p0[a])))
    sid1, sid2, extra = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
    return {"lang": np.full(len(sid1), col["lang"][0].as_py(), object), "sid": sid1, "sid2": sid2, "extra": extra} if len(sid1) else None


def pair_distances(cells: DataFrame, groups: DataFrame, block_terms: int = TERMS, block_sources: int = SOURCES) -> DataFrame:
    """(lang, source, item, value): summed distance of each source to each other one of its language."""
    size = groups.agg(F.max("sid").alias("sid"), F.max("v").alias("v")).first()
    n_terms = max(1, -(-(size.v or 0) // block_terms))
    n_blocks = (size.sid or 0) // block_sources + 1
    sparse = (cells.select("lang", "sid", "term", "p").withColumn("tb", F.pmod(F.xxhash64("term"), F.lit(n_terms))))
    dense = (groups.where("v > 0").select("lang", "sid", F.lit(None).cast("binary").alias("term"), F.col("p0").alias("p"))
             .withColumn("tb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_terms - 1).cast("long")))))
    rows = sparse.unionByName(dense).withColumn("b", F.floor(F.col("sid") / block_sources)).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    rows = rows.select("lang", "tb", F.least("b", "other").cast("int").alias("i"), F.greatest("b", "other").cast("int").alias("j"),
                       F.col("sid").cast("long").alias("sid"), "term", "p")
    extra = (map_groups(rows, ["lang", "tb", "i", "j"], partial(_block_sums, block_sources=block_sources), "lang string, sid long, sid2 long, extra long")
             .groupBy("lang", "sid", "sid2").agg(F.sum("extra").alias("extra")))
    a = groups.select("lang", "sid", "source", "p0", "v")
    b = groups.select("lang", F.col("sid").alias("sid2"), F.col("source").alias("item"), F.col("p0").alias("q0"))
    pairs = (a.join(b, "lang").where("sid < sid2").join(extra, ["lang", "sid", "sid2"], "left")
             .withColumn("value", F.col("v") * F.abs(F.col("p0") - F.col("q0")) + F.coalesce("extra", F.lit(0))))
    ways = F.explode(F.array(F.struct(F.col("source").alias("s"), F.col("item").alias("t")),
                             F.struct(F.col("item").alias("s"), F.col("source").alias("t"))))
    return pairs.select("lang", "value", ways.alias("w")).select("lang", F.col("w.s").alias("source"), F.col("w.t").alias("item"), "value")


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          block_terms: int = TERMS, block_sources: int = SOURCES) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank; see the module's text."""
    rows = docs.select(F.col(text).cast("binary").alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
                       F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"))
    cells = materialise(kept_cells(rows), "audit-cells")
    groups = materialise(group_stats(rows, cells), "audit-groups")
    cells = cells.join(groups, ["lang", "source"]).withColumns(
        {"p": smoothed(F.col("n"), "n_group", "v"), "q": smoothed(F.col("lang_n"), "n_lang", "v")})
    place = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    pairs = pair_distances(cells, groups, block_terms, block_sources).withColumn("rank", F.row_number().over(place))
    above = (cells.where("p > q").select("lang", "source", F.col("term").cast("string").alias("item"), (F.col("p") - F.col("q")).alias("value"))
             .withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= TOP_TERMS))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank").unionByName(
        above.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
