"""Operator 4: licence scans by an exact set-similarity join of text blocks with licence templates.

A template is a licence notice of some words.  Its blocks in a text are every line, and every line with the fewest lines
behind it that hold as many words as the notice (the longest of neighbouring ones), so a wrapped notice lies in a block wherever it begins.
A block meets the template if it holds at least ``CONTAINMENT`` of its different words.  Notices that differ in a word or two (a
version number, NonCommercial) are neighbours: one holds ``CONTAINMENT`` of the other's words.  Of neighbours met from the same
line only those of the highest containment count, then those of most words.  Words are ordered by their global block frequency, rarest
first (counted over all blocks by partial sums).  A template with m words of which a must be found has one of its
first m - a + 1 words in every block that meets it (prefix filter, on the whole text first); a block with fewer than a template words is out
(length filter); and from the first common word on both sides must have enough words left (positional filter).  What
passes is counted exactly, so no block is missed.  Templates are fixed and small; they are sent to the tasks.

Beside the join, phrases (the base rule of the contract) are found at every place where their words stand in a row.

Defined results: null and empty texts have no words, places or labels and score 0; a text may have several labels; the
score is 1 with a phrase, else the largest containment found; other columns pass through.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import _WORD_TABLE, words

CONTAINMENT = 0.9

# Phrases of the contract and the wording of well-known licence notices.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 "
              "of the License, or (at your option) any later version"),
    ("gpl-2", "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 "
              "of the License, or (at your option) any later version"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]
FOUND = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("line", T.LongType()),
                                  T.StructField("containment", T.DoubleType())]))
PLACES = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("first", T.LongType()),
                                   T.StructField("last", T.LongType())]))


class Join:
    """Prefix index of the templates under a global word order."""

    def __init__(self, templates: list[tuple[str, str]], frequency: dict[bytes, int], threshold: float):
        self.threshold = threshold
        found = [(label, words(t)) for label, t in templates]
        found = [(label, w) for label, w in found if w]
        vocab = set().union(*(w for _, w in found)) if found else set()
        self.rank = {w: k for k, w in enumerate(sorted(vocab, key=lambda w: (frequency.get(w, 0), w)))}
        self.templates, self.index = [], {}
        for label, w in found:
            order = sorted(set(w), key=self.rank.__getitem__)
            need = math.ceil(threshold * len(order) - 1e-9)
            for place, x in enumerate(order[:len(order) - need + 1]):
                self.index.setdefault(x, []).append((len(self.templates), place))
            self.templates.append((label, frozenset(w), need, len(w)))
        self.near = {(i, k) for i, (_, a, need, _) in enumerate(self.templates) for k, (_, b, *_) in enumerate(self.templates)
                     if i != k and len(a & b) >= need}
        #: words of a block behind its first line: as many as the longest of the neighbours, which thus share their blocks
        self.reach = [max([n, *(self.templates[u][3] for t, u in self.near if t == k)]) for k, (*_, n) in enumerate(self.templates)]
        self.prefix = frozenset(self.index)
        self.vocab = frozenset(vocab)

    def meets(self, block: set[bytes]) -> dict[int, float]:
        """Template number -> containment, for every template that the block meets."""
        if self.prefix.isdisjoint(block):
            return {}
        own = sorted(self.vocab & block, key=self.rank.__getitem__)
        seen, out = set(), {}
        for at, w in enumerate(own):
            for t, place in self.index.get(w, ()):
                if t in seen:
                    continue
                seen.add(t)  # its rarest common word: nothing before it is common
                _, s, need, _ = self.templates[t]
                if len(own) < need or min(len(own) - at, len(s) - place) < need:
                    continue
                both = len(s & block)
                if both >= need:
                    out[t] = both / len(s)
        return out

    def text(self, lines: list[list[bytes]]) -> list[tuple[str, int, float]]:
        """(label, line, containment) of all blocks of the text, by line and label."""
        every = [w for x in lines for w in x]
        here = {t for w in self.prefix.intersection(every) for t, _ in self.index[w]}
        here = [t for t in here if len(self.templates[t][1].intersection(every)) >= self.templates[t][2]]
        if not here:
            return []
        ends = list(accumulate(map(len, lines)))
        out = []
        for k, line in enumerate(lines):
            met = {t: c for t, c in self.meets(set(line)).items() if t in here}
            for t in here:
                last = bisect_left(ends, ends[k] + self.reach[t], k)
                run = every[ends[k] - len(line):ends[min(last, len(ends) - 1)]]
                if t not in met and line and len(run) > len(line):
                    met.update((u, c) for u, c in self.meets(set(run)).items() if u == t)
            out += [(self.templates[t][0], k, c) for t, c in met.items()
                    if not any((t, u) in self.near and (c2, len(self.templates[u][1])) > (c, len(self.templates[t][1]))
                               for u, c2 in met.items())]
        return sorted(out, key=lambda x: (x[1], x[0], -x[2]))


def _blocks(raw: bytes) -> list[list[bytes]]:
    return [x.translate(_WORD_TABLE).split() for x in raw.split(b"\n")]


def block_frequency(docs: DataFrame, vocab: frozenset[bytes], text: str = "text") -> dict[bytes, int]:
    """In how many blocks of all documents each word of ``vocab`` stands."""
    def run(batches):
        n = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    for block in _blocks(t.encode("utf-8", "replace").lower()):
                        n.update(vocab.intersection(block))
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], ["w", "n"])

    rows = docs.select(text).mapInArrow(run, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()
    return {bytes(r.w): r.n for r in rows}


def phrase_places(w: list[bytes], phrases: dict[bytes, tuple[str, int]]) -> list[tuple[str, int, int]]:
    joined = b" " + b" ".join(w) + b" "
    out = []
    for phrase, (label, n) in phrases.items():
        at = joined.find(phrase)
        while at >= 0:
            first = joined.count(b" ", 0, at)
            out.append((label, first, first + n - 1))
            at = joined.find(phrase, at + 1)
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def scan(docs: DataFrame, text: str = "text", phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES,
         threshold: float = CONTAINMENT, names: tuple[str, str, str] = ("n_words", "places", "found")) -> DataFrame:
    """``docs`` plus the number of words, every place of a phrase (words from 0) and every block that meets a template
    (lines from 0)."""
    clash = set(names) & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    vocab = Join(templates, {}, threshold).vocab
    join = docs.sparkSession.sparkContext.broadcast(Join(templates, block_frequency(docs, vocab, text), threshold))
    wanted = {b" " + b" ".join(words(p)) + b" ": (label, len(words(p))) for p, label in phrases.items()}
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.LongType()), T.StructField(names[1], PLACES),
                           T.StructField(names[2], FOUND)])
    arrow = to_arrow_schema(schema)

    def run(batches):
        j = join.value
        for b in batches:
            count, places, found = [], [], []
            for t in b.column(at).to_pylist():
                blocks = _blocks(t.encode("utf-8", "replace").lower()) if t else []
                count.append(sum(map(len, blocks)))
                found.append([{"label": label, "line": k, "containment": c} for label, k, c in j.text(blocks)])
                places.append([{"label": x, "first": f, "last": e}
                               for x, f, e in phrase_places([w for block in blocks for w in block], wanted)])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(count, pa.int64()), pa.array(places, arrow.field(names[1]).type),
                 pa.array(found, arrow.field(names[2]).type)], schema=arrow)
    return docs.mapInArrow(run, schema)


def digests(scanned: DataFrame) -> DataFrame:
    place_labels, found_labels = (F.transform(c, lambda x: x["label"]) for c in ("places", "found"))
    some = F.size("places") > 0
    return scanned.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.when(some, F.array_min(F.transform("places", lambda x: x["first"]))).alias("first_word"),
        F.when(some, F.array_max(F.transform("places", lambda x: x["first"]))).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(place_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(place_labels, found_labels)), ",").alias("labels"),
        F.when(some, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("found", lambda x: x["containment"])), F.lit(0.0))).alias("score"))
