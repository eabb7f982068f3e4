"""Operator 8: SentencePiece BPE encoding and decoding, exactly as the library does it.

Encoding does not replay the merges of a text.  A sequence of pieces is the BPE encoding of a string if
and only if every adjacent pair of pieces is *compatible* (re-merging the two would not have joined
something across their border first).  So each stretch of text is encoded left to right: an Aho-Corasick
automaton over the vocabulary gives the longest piece at a position, a piece is accepted if it is compatible with
the one before it, else its longest proper prefix piece is tried, and when none is left the last piece is
taken back.  A bit per position remembers starts from which no encoding exists, so each is tried once.

No piece has a non-blank character before a blank marker, so a text falls apart before each run of blanks
and its stretches repeat; their ids are kept in a bounded dictionary per task.

Defined results: a null text is the empty text (no ids, decoded ''); an empty text has no ids; characters
outside the vocabulary become UTF-8 byte pieces; lone surrogates cannot occur in Spark strings.  All other columns
are passed through untouched and the new ones must not clash with them (``prefix`` renames the new ones).
"""

from __future__ import annotations

from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
STRETCHES_KEPT = 200_000  # per task and generation; workers are reused, so all of a pipeline's dictionaries add up
PARTS_KEPT = 100_000
PAIRS_KEPT = 300_000
CACHED_CHARS = 64        # longer stretches are encoded each time


class PieceModel:
    """Vocabulary tables of one BPE model file (loaded once per Python worker)."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        self.byte_id: dict[int, int] = {}
        self.id_of: dict[str, int] = {}
        self.piece_bytes: list[bytes] = [b""] * n
        self.unknown = sp.unk_id()
        score = {}
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.piece_bytes[i] = bytes([value])
            elif sp.is_unknown(i):
                self.piece_bytes[i] = " ⁇ ".encode()
            elif not sp.is_control(i):
                self.id_of[piece] = i
                score[i] = sp.get_score(i)
                self.piece_bytes[i] = piece.replace(BLANK, " ").encode()
        blanks = [p for p in self.id_of if not p.strip(BLANK)]
        self.longest_blank = max(map(len, blanks), default=0)
        lowest = min(score.values())
        # merge order: better score first; the tied pieces of blanks only are handled by `blanks`
        order = sorted((i for p, i in self.id_of.items() if len(p) > 1 and p.strip(BLANK)), key=lambda i: -score[i])
        if (any(BLANK in p.lstrip(BLANK) or p.startswith(BLANK * 2) and p.strip(BLANK) for p in self.id_of)
                or BLANK not in self.id_of
                or any(score[self.id_of[p]] != lowest for p in blanks if len(p) > 1)
                or len({score[i] for i in order}) < len(order)):
            raise ValueError("the blank pieces or tied scores of this model need a full merge replay")
        self.rank = {i: k for k, i in enumerate(order)}
        self.text = {i: p for p, i in self.id_of.items()}
        self.halves: dict[int, tuple[int, int]] = {}   # piece -> the two pieces whose merge makes it
        self.merged: dict[tuple[int, int], int] = {}   # the reverse
        self.shorter: dict[int, int] = {}              # piece -> its longest proper prefix piece
        self.valid: dict[tuple[int, int], bool] = {}
        self._learn_merges(order)
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id_of.items():
            if i in self.rank or len(p) == 1:
                self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.sizes = {i: len(p) for p, i in self.id_of.items()}
        # two characters that no piece holds side by side: no merge crosses the place between them
        self.pairs = {pair for p in self.id_of for pair in zip(p, p[1:])}
        most = self.longest_blank
        if any(self._leftmost(most + n) != [most, *self._leftmost(n)] for n in range(2 * most)):
            raise ValueError("runs of blanks of this model need a full merge replay")

    def _learn_merges(self, order: list[int]) -> None:
        """In merge order, encode each piece with the better pieces only: two pieces are left, its halves.
        A piece that cannot be made by merging stays out of the vocabulary."""
        for i in order:
            piece = self.text[i]
            for cut in range(len(piece) - 1, 0, -1):
                a, b = self.id_of.get(piece[:cut]), self.id_of.get(piece[cut:])
                if (a is not None and b is not None and self._known(a) and self._known(b)
                        and self.rank.get(a, -1) < self.rank[i] and self.rank.get(b, -1) < self.rank[i]
                        and self.compatible(a, b)):
                    self.halves[i], self.merged[a, b] = (a, b), i
                    break
            else:
                del self.rank[i]
        self.valid.clear()  # pairs judged while the table was growing
        for i in self.rank:
            piece = self.text[i]
            self.shorter[i] = next((j for cut in range(len(piece) - 1, 0, -1)
                                    if (j := self.id_of.get(piece[:cut])) is not None and self._known(j)), -1)

    def _known(self, i: int) -> bool:
        return i in self.halves or len(self.text[i]) == 1

    def compatible(self, left: int, right: int) -> bool:
        """Would merging the characters of the two pieces leave their border alone?  Undo the later of
        the two pieces' merges again and again; the border is crossed if the pieces that face each other
        there can merge earlier than the merge undone last."""
        key = (left, right)
        got = self.valid.get(key)
        if got is None:
            got = self._compatible(left, right)
            if len(self.valid) < PAIRS_KEPT:
                self.valid[key] = got
        return got

    def _compatible(self, left: int, right: int) -> bool:
        rank, halves = self.rank, self.halves
        limit = len(rank) + 1  # a merge across the border must rank below this to come first
        while True:
            joint = self.merged.get((left, right))
            if joint is not None and rank[joint] < limit:
                return False
            a = rank[left] if left in halves else -1
            b = rank[right] if right in halves else -1
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = a, halves[left][1]
            else:  # at equal ranks the right merge is the later one, and the border lies left of it
                limit, right = b + 1, halves[right][0]

    def blanks(self, n: int) -> list[int]:
        """Ids of n blanks.  All scores are equal, so the leftmost pair that makes a piece merges first:
        whole longest pieces, then the rest."""
        whole, rest = divmod(n, self.longest_blank)
        return [self.id_of[BLANK * k] for k in [self.longest_blank] * whole + self._leftmost(rest)]

    def _leftmost(self, n: int) -> list[int]:
        runs, at = [1] * n, 0
        while at + 1 < len(runs):
            if BLANK * (runs[at] + runs[at + 1]) in self.id_of:
                runs[at:at + 2] = [runs[at] + runs[at + 1]]
                at = max(0, at - 1)
            else:
                at += 1
        return runs

    def encode_known(self, chars: str) -> list[int]:
        """Encoding of characters that are all pieces, by backtracking."""
        n = len(chars)
        if n == 1:
            return [self.id_of[chars]]
        longest = [None] * n
        for end, match in self.automaton.iter(chars):
            longest[end + 1 - match[1]] = match  # ends grow, so the last match of a start is its longest
        whole = longest[0]
        if whole[1] == n:  # a piece is its own encoding
            return [whole[0]]
        shorter, valid, sizes = self.shorter, self.valid, self.sizes
        failed = bytearray(n // 8 + 1)
        out: list[int] = []
        at, last, (token, size) = 0, -1, whole
        while True:
            end = at + size
            if not failed[end >> 3] >> (end & 7) & 1:
                fits = last < 0 or valid.get((last, token))
                if fits is None:
                    fits = self.compatible(last, token)
                if fits:
                    out.append(token)
                    if end == n:
                        return out
                    at, last, (token, size) = end, token, longest[end]
                    continue
            token = shorter.get(token, -1)
            while token < 0:  # no piece is left at this position
                failed[at >> 3] |= 1 << (at & 7)
                token = out.pop()
                at -= sizes[token]
                last = out[-1] if out else -1
                token = shorter.get(token, -1)
            size = sizes[token]

    def encode_stretch(self, stretch: str, part_ids) -> list[int]:
        """A run of blanks followed by characters other than blanks; ``part_ids(part)`` encodes the
        parts between which no piece reaches."""
        word = stretch.lstrip(BLANK)
        n = len(stretch) - len(word)
        if not word:
            return self.blanks(n)
        known = (BLANK if n else "") + word
        pairs, start, out = self.pairs, 0, []
        cuts = [k for k, pair in enumerate(zip(known, known[1:]), 1) if pair not in pairs]
        for cut in [*cuts, len(known)]:
            out += part_ids(known[start:cut])
            start = cut
        if n and out[0] == self.id_of[BLANK]:  # the last blank did not merge with the word
            return self.blanks(n) + out[1:]
        return (self.blanks(n - 1) if n > 1 else []) + out

    def encode_part(self, part: str) -> list[int]:
        """Characters without a piece never merge: they stand alone here and become their bytes."""
        if len(part) == 1 and part not in self.id_of:
            return [self.byte_id.get(b, self.unknown) for b in part.encode("utf-8", "replace")]
        return self.encode_known(part)

    def decode(self, ids) -> str:
        """Text of a list of ids; each byte that is no valid UTF-8 becomes U+FFFD, the first blank goes."""
        ids = ids.tolist() if isinstance(ids, np.ndarray) else list(ids)
        raw = b"".join(map(self.piece_bytes.__getitem__, ids))
        try:
            text = raw.decode("utf-8")
        except UnicodeDecodeError:
            text = raw.decode("utf-8", "one-by-one")
        return text[1:] if ids and self.text.get(ids[0], "").startswith(BLANK) else text


class _Kept(dict):
    """Results by string in two generations of ``most`` each: what is still in use moves on."""

    def __init__(self, make, most: int):
        self.make, self.older, self.most = make, {}, most

    def __missing__(self, key: str):
        got = self.older.get(key)
        if got is None:
            got = self.make(key)
        if len(key) <= CACHED_CHARS:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = got
        return got


def _one_by_one(error):
    return "�", error.start + 1


@lru_cache(maxsize=2)
def _loaded(model_file: str) -> tuple[PieceModel, _Kept]:
    import codecs

    codecs.register_error("one-by-one", _one_by_one)
    model = PieceModel(model_file)
    parts = _Kept(lambda part: tuple(model.encode_part(part)), PARTS_KEPT)
    # ids as the bytes of 32-bit integers: those of a text are joined at once
    return model, _Kept(lambda stretch: array("i", model.encode_stretch(BLANK + stretch, parts.__getitem__)).tobytes(), STRETCHES_KEPT)


def stretches(text: str) -> list[str]:
    """The text with the blank in front that the model adds, cut before each run of blanks; each stretch
    without its first blank."""
    if BLANK in text:
        text = text.replace(BLANK, " ")
    parts = text.split(" ")
    if "" not in parts:
        return parts  # no run of blanks anywhere
    out, run = [], 0
    for part in parts:
        if part:
            out.append(BLANK * run + part)
            run = 0
        else:
            run += 1
    if run:
        out.append(BLANK * (run - 1))
    return out


def encode_text(model_file: str, text: str | None) -> np.ndarray:
    """Ids (int32) of a whole text."""
    if not text:
        return np.empty(0, np.int32)
    _, kept = _loaded(model_file)
    return np.frombuffer(b"".join(map(kept.__getitem__, stretches(text))), np.int32)


def decode_ids(model_file: str, ids) -> str:
    return _loaded(model_file)[0].decode(ids)


def encode_decode(docs: DataFrame, model_file: str, text: str = "text", ids: str = "ids",
                  decoded: str = "decoded") -> DataFrame:
    """``docs`` plus ``ids`` array<int> and ``decoded`` string for the whole text of every row.
    One narrow pass, no shuffle; memory is one Arrow batch and the bounded dictionary."""
    clash = {ids, decoded} & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    at = docs.columns.index(text)
    names = docs.columns

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        model, _ = _loaded(model_file)
        sizes, parts, texts = [0], [], []
        for t in b.column(at).to_pylist():
            got = encode_text(model_file, t)
            parts.append(got)
            sizes.append(sizes[-1] + len(got))
            texts.append(model.decode(got))
        flat = np.concatenate(parts) if parts else np.empty(0, np.int32)
        lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat, pa.int32()))
        return pa.RecordBatch.from_arrays([*b.columns, lists, pa.array(texts, pa.string())], names=[*names, ids, decoded])

    from pyspark.sql import types as T
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())])
    return docs.mapInArrow(_sliced(batch, 1000), schema)


def _sliced(fn, rows: int):
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, rows):
                yield fn(b.slice(at, rows))
    return run


def digests(encoded: DataFrame, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of encoded rows."""
    return encoded.select(
        "doc_id", F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded).cast("binary"), 256).alias("decoded_sha256"))
