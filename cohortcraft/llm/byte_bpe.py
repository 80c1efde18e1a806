"""Byte-level BPE by prefix dynamic programming, over whole texts.

A text is split by the vocabulary's pattern and every match is encoded alone.
For a match the table holds, per byte prefix, the last token of that prefix's
encoding. Encodings of prefixes are nested: of the tokens that end at a byte,
exactly one is a valid neighbour of the last token where it begins, so the
table grows by a byte without touching what is there (exact appends), and an
edit changes it only from the edited byte to where it falls into step with the
old table again. The ids are read off backwards.

Two tokens are valid neighbours when merging their joined bytes by rank never
crosses the seam. ``Vocabulary.neighbours`` decides this by undoing their merges
latest first and asking at each step whether a merge over the seam would have
come before the merges that are still undone.

Over a batch of texts the tables of all new pieces grow together, byte by byte,
in numpy (``prefix_tables``). Texts are cut before white space that follows other
characters and between a letter and an ASCII sign other than the apostrophe,
where no match of the pattern can reach over, and equal chunks are encoded once;
a worker keeps their ids.

A vocabulary file holds one token and its rank per line, in base64; ranks are
ids. A match that is itself a token takes its id, as the public library does.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cohortcraft.llm import kernels as K
from cohortcraft.llm.workers import ship_package

CACHE = 450_000
"""Distinct chunks that a worker keeps; beyond it the cache starts anew (results do not change)."""
LONGEST = 48
"""Bytes of the longest piece whose table grows with those of others, and of the longest chunk that is kept."""
SLICE = 1 << 20
"""Bytes of text behind one output batch (a longer text stands alone)."""
DECODED = 1 << 18
"""Ids that are decoded at a time (a longer list stands alone)."""


def tokens(path: str) -> dict[int, bytes]:
    """Id -> bytes of a vocabulary file."""
    with open(path, "rb") as f:
        pairs = (line.split() for line in f if line.strip())
        return {int(rank): base64.b64decode(token) for token, rank in pairs}


class Vocabulary:
    def __init__(self, path: str, pattern: str) -> None:
        self.token = tokens(path)
        self.rank = {token: rank for rank, token in self.token.items()}
        self.split = regex.compile(pattern).findall
        # every ending of a token, with its id where it is one itself, else -1: ends the search for tokens at a byte
        self.endings = {token[k:]: -1 for token in self.rank for k in range(len(token))}
        self.endings.update(self.rank)
        self.longest = max(map(len, self.rank))
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}

    def merged(self, data: bytes) -> list[int]:
        """Ids of ``data`` by plain merging, lowest rank and leftmost first (used for single tokens)."""
        ids = [self.rank[data[i : i + 1]] for i in range(len(data))]
        while len(ids) > 1:
            best, at = None, 0
            for i in range(len(ids) - 1):
                rank = self.rank.get(self.token[ids[i]] + self.token[ids[i + 1]])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            ids[at : at + 2] = [best]
        return ids

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge gives ``token``; None for single bytes and tokens that merging never reaches."""
        if token not in self.parts:
            data, found = self.token[token], None
            # merging everything but the last step leaves the two halves
            if len(data) > 1 and self.merged(data) == [token]:
                for cut in range(1, len(data)):
                    left, right = self.rank.get(data[:cut]), self.rank.get(data[cut:])
                    if left is not None and right is not None and left < token and right < token:
                        if self.merged(data[:cut]) == [left] and self.merged(data[cut:]) == [right] and self._seam(left, right, token):
                            found = (left, right)
                            break
            self.parts[token] = found
        return self.parts[token]

    def reachable(self, token: int) -> bool:
        return len(self.token[token]) == 1 or self.halves(token) is not None

    def _seam(self, left: int, right: int, limit: int | None = None) -> bool:
        """Whether no merge over the seam of two tokens comes before rank ``limit`` (None: ever)."""
        x, y = left, right
        # ranks at which x joins what stands before it, and y what stands after it
        x_joins = y_joins = float("inf") if limit is None else limit
        while True:
            over = self.rank.get(self.token[x] + self.token[y])
            # the leftmost of equal ranks goes first: y's own merge comes after one over the seam
            if over is not None and over < x_joins and (over <= y_joins if y_joins != limit else over < y_joins):
                return False
            undo_x = (x > y or len(self.token[y]) == 1) and len(self.token[x]) > 1
            if undo_x:
                x_joins, x = x, self.halves(x)[1]
            elif len(self.token[y]) > 1:
                y_joins, y = y, self.halves(y)[0]
            else:
                return True

    def neighbours(self, left: int, right: int) -> bool:
        """Whether two tokens may stand side by side in an encoding."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHE // 4:
                self.pairs.clear()
            known = self.pairs[key] = self.joins_here(left, right)
        return known

    def joins_here(self, left: int, right: int) -> bool:
        return self.reachable(left) and self.reachable(right) and self._seam(left, right)

    def piece(self, piece: str) -> list[int]:
        """Ids of one match of the pattern."""
        data = piece.encode("utf-8")
        whole = self.rank.get(data)
        return [whole] if whole is not None else PrefixTable(self, data).ids()

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text; a null has none."""
        return list(chain.from_iterable(map(self.piece, self.split(text)))) if text else []

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class PrefixTable:
    """Last token of every byte prefix of one piece of bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary = vocabulary
        self.data = bytearray()
        self.last = array("q", [-1])
        self.append(data)

    def append(self, data: bytes) -> None:
        """Grow by ``data``; what stands is not touched."""
        v, last, done = self.vocabulary, self.last, len(self.data)
        back = min(done, v.longest)
        self.data += data
        window, shift = bytes(self.data[done - back :]), done - back
        ending_of, pairs, neighbours = v.endings.get, v.pairs.get, v.neighbours
        for end in range(back + 1, len(window) + 1):
            for start in range(end - 1, -1, -1):
                token = ending_of(window[start:end])
                if token is None:  # no token ends like this
                    raise ValueError(f"no token ends at byte {shift + end}")
                if token >= 0:
                    before = last[shift + start]
                    if before < 0:
                        valid = v.reachable(token)
                    else:
                        valid = pairs(before << 32 | token)
                        if valid is None:
                            valid = neighbours(before, token)
                    if valid:
                        last.append(token)
                        break
            else:
                raise ValueError(f"no token ends at byte {shift + end}")

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in the place of bytes start..stop; returns how many prefixes were computed anew.

        Behind the edit the work stops once as many prefixes in a row as the
        longest token has bytes end in the tokens they ended in before.
        """
        longest = self.vocabulary.longest
        old, tail = self.last[stop + 1 :], bytes(self.data[stop:])
        before = len(self.data)
        del self.data[start:], self.last[start + 1 :]
        self.append(new)
        same = 0
        for k, byte in enumerate(tail):
            self.append(bytes([byte]))
            # a token that reaches over the edit is not the old one, whatever its id
            inside = len(self.vocabulary.token[old[k]]) <= k + 1
            same = same + 1 if inside and self.last[-1] == old[k] else 0
            if same >= longest:
                self.data += tail[k + 1 :]
                self.last += old[k + 1 :]
                return len(new) + k + 1
        return len(new) + min(len(tail), before - stop)

    def ids(self) -> list[int]:
        out, at = [], len(self.data)
        while at:
            out.append(self.last[at])
            at -= len(self.vocabulary.token[self.last[at]])
        return out[::-1]


class EditedText:
    """A text with its ids, kept exact under appends and edits by encoding only near the change."""

    def __init__(self, vocabulary: Vocabulary, text: str = "") -> None:
        self.vocabulary = vocabulary
        self.matches = vocabulary.split(text)

    @property
    def text(self) -> str:
        return "".join(self.matches)

    def append(self, text: str) -> None:
        length = sum(map(len, self.matches))
        self.replace(length, length, text)

    def replace(self, start: int, stop: int, new: str) -> None:
        """Put ``new`` in the place of characters start..stop.

        Matches are split anew from two before the edit, until they agree with
        the old ones; the pattern looks one character ahead and never back.
        """
        at, first = 0, 0
        while first < len(self.matches) and at + len(self.matches[first]) <= start:
            at += len(self.matches[first])
            first += 1
        for _ in range(2):
            if first:
                first -= 1
                at -= len(self.matches[first])
        end, last = at, first
        while last < len(self.matches) and end < stop:
            end += len(self.matches[last])
            last += 1
        # whole white-space runs and the match after them may join what stands before the seam
        while True:
            reach = min(len(self.matches), last + 2)
            while reach < len(self.matches) and self.matches[reach - 1].isspace():
                reach += 1
            window = "".join(self.matches[first:reach])
            fresh = self.vocabulary.split(window[: start - at] + new + window[stop - at :])
            if reach == len(self.matches) or fresh[-1:] == self.matches[reach - 1 : reach]:
                break
            last = reach
        self.matches[first:reach] = fresh

    def ids(self) -> list[int]:
        return [i for m in self.matches for i in self.vocabulary.piece(m)]


def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of byte strings."""
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


class _Pairs:
    """Which pairs of tokens are neighbours, as a direct-mapped table in front of the vocabulary's own answers."""

    BITS = 20

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.key = np.full(1 << self.BITS, -1, np.int64)
        self.valid = np.zeros(1 << self.BITS, bool)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        spot = (K.mix(key.astype(np.uint64)) >> np.uint64(64 - self.BITS)).astype(np.int64)
        out = self.valid[spot]
        new = np.flatnonzero(self.key[spot] != key)
        if len(new):
            answers = self.vocabulary.joins_here
            found = np.fromiter(map(answers, left[new].tolist(), right[new].tolist()), bool, len(new))
            out[new] = found
            self.key[spot[new]] = key[new]
            self.valid[spot[new]] = False  # spots that two new keys share are settled below
            same = self.key[spot[new]] == key[new]
            self.valid[spot[new[same]]] = found[same]
        return out


class BatchEncoder:
    """Ids of whole columns of texts."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = v = vocabulary
        tokens = sorted(v.token.items())
        flat, at = _joined([t for _, t in tokens])
        hashes = K.word_hashes(flat, at[:-1], at[1:])
        order = np.argsort(hashes)
        self.hashes, self.ids_by_hash = hashes[order], np.array([r for r, _ in tokens], np.int64)[order]
        self.size = np.zeros(max(v.token) + 1, np.int64)
        self.size[[r for r, _ in tokens]] = np.diff(at)
        self.pairs = _Pairs(v)
        self.reach = np.full(max(v.token) + 1, -1, np.int8)  # -1: not asked yet
        self._reset()

    def _reset(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.kept, self.lengths = array("I"), array("I")

    def prefix_tables(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of many pieces; all tables grow by one byte at a time."""
        flat, at = _joined(pieces)
        begin, size = at[:-1], np.diff(at)
        longest = int(size.max(initial=0))
        last = np.full((len(pieces), longest + 1), -1, np.int64)
        for end in range(1, longest + 1):
            rows = np.flatnonzero(size >= end)
            for start in range(end - 1, max(-1, end - 1 - self.vocabulary.longest), -1):
                if not len(rows):
                    break
                token = self._tokens(flat, begin[rows] + start, end - start)
                there = token >= 0
                valid = there.copy()
                if start:
                    spots = np.flatnonzero(there)
                    valid[spots] = self.pairs(last[rows[spots], start], token[spots])
                else:
                    own = token[there]
                    for t in np.unique(own[self.reach[own] < 0]).tolist():
                        self.reach[t] = self.vocabulary.reachable(t)
                    valid[there] = self.reach[own] == 1
                last[rows[valid], end] = token[valid]
                rows = rows[~valid]
            if len(rows):
                raise ValueError(f"no token ends at byte {end} of {pieces[rows[0]]!r}")
        out: list[list[int]] = [[] for _ in pieces]
        left, rows = size.copy(), np.flatnonzero(size)
        while len(rows):  # read off backwards
            token = last[rows, left[rows]]
            for r, t in zip(rows.tolist(), token.tolist(), strict=True):
                out[r].append(t)
            left[rows] -= self.size[token]
            rows = rows[left[rows] > 0]
        return [ids[::-1] for ids in out]

    def _tokens(self, flat: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
        """Token that each run of ``size`` bytes is, -1 where it is none."""
        value = K.run_hashes(flat, begin, size)
        at = np.minimum(np.searchsorted(self.hashes, value), len(self.hashes) - 1)
        return np.where(self.hashes[at] == value, self.ids_by_hash[at], -1)

    def _new_chunks(self, chunks: list[bytes]) -> list[list[int]]:
        v, rank, split = self.vocabulary, self.vocabulary.rank, self.vocabulary.split
        cut = [split(c.decode("utf-8")) for c in chunks]
        pieces = [[c] if len(ps) == 1 else [p.encode("utf-8") for p in ps] for c, ps in zip(chunks, cut, strict=True)]
        unknown = {p for ps in pieces for p in ps if p not in rank}
        known: dict[bytes, list[int]] = {p: PrefixTable(v, p).ids() for p in unknown if len(p) > LONGEST}
        short = [p for p in unknown if len(p) <= LONGEST]
        tables = self.prefix_tables(short)
        if v.decode(chain.from_iterable(tables)) != b"".join(short):  # hashes only found the tokens
            tables = [ids if v.decode(ids) == p else PrefixTable(v, p).ids() for p, ids in zip(short, tables, strict=True)]
        known.update(zip(short, tables, strict=True))
        ids_of = lambda p: known[p] if p in known else [rank[p]]
        return [ids_of(ps[0]) if len(ps) == 1 else [i for p in ps for i in ids_of(p)] for ps in pieces]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): ids of every text, one after the other; a null has none."""
        data, offsets = K.buffer(column)
        start = chunk_starts(data, offsets)
        end = np.append(start[1:], len(data))
        _, spot, which = np.unique(K.word_hashes(data, start, end), return_index=True, return_inverse=True)
        raw = data.tobytes()
        if len(self.slot) >= CACHE:
            self._reset()
        words = [raw[a:b] for a, b in zip(start[spot].tolist(), end[spot].tolist(), strict=True)]
        slots = list(map(self.slot.get, words))
        new = [i for i, s in enumerate(slots) if s is None]
        for i, ids in zip(new, self._new_chunks([words[i] for i in new]), strict=True):
            slots[i] = len(self.lengths)
            if len(words[i]) <= LONGEST:
                self.slot[words[i]] = slots[i]
            self.kept.extend(ids)
            self.lengths.append(len(ids))
        at = np.array(slots, np.int64)[which.reshape(-1)] if slots else np.zeros(0, np.int64)
        lengths = np.array(self.lengths, np.int64)
        begin = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        sizes = lengths[at]
        out = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        where = np.arange(out[-1]) - np.repeat(out[:-1] - begin[at], sizes)
        return np.array(self.kept, np.uint32)[where], out[np.searchsorted(start, offsets)]


def _space_ends(data: np.ndarray) -> np.ndarray:
    """Bytes that may end a white-space character of any kind (or a control that some call white space)."""
    out = K.SPACE[data] | ((data >= 0x1C) & (data <= 0x1F))
    back = lambda k: np.concatenate([np.zeros(min(k, len(data)), np.uint8), data[: len(data) - k]]) if k else data
    two = (back(1) == 0xC2) & ((data == 0x85) | (data == 0xA0))
    lead, mid = back(2), back(1)
    three = (
        ((lead == 0xE1) & (mid == 0x9A) & (data == 0x80))
        | ((lead == 0xE2) & (mid == 0x80) & (((data >= 0x80) & (data <= 0x8A)) | np.isin(data, [0xA8, 0xA9, 0xAF])))
        | ((lead == 0xE2) & (mid == 0x81) & (data == 0x9F))
        | ((lead == 0xE3) & (mid == 0x80) & (data == 0x80))
    )
    return out | two | three


def _byte_mask(text: bytes) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(text)] = True
    return mask


_ASCII_LETTER = _byte_mask(bytes(c for c in range(128) if chr(c).isalpha()))
_ASCII_SIGN = _byte_mask(bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"))


def _letter_ends(data: np.ndarray) -> np.ndarray:
    """Bytes that end an ASCII or Latin-1 letter (of two bytes, the first of them C3, but the signs 97 and B7)."""
    latin = np.zeros(len(data), bool)
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    return _ASCII_LETTER[data] | latin


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts may be cut: at their starts, before ASCII white space that follows anything else, between a letter and an ASCII sign."""
    cut = np.zeros(len(data) + 1, bool)
    if len(data):
        cut[1:-1] = K.SPACE[data[1:]] & ~_space_ends(data)[:-1]
        cut[1:-1] |= _ASCII_SIGN[data[1:]] & _letter_ends(data)[:-1]
    cut[offsets] = True
    cut[len(data) :] = False
    return np.flatnonzero(cut)


_ENCODERS: dict[tuple[str, str], BatchEncoder] = {}


def encoder(path: str, pattern: str) -> BatchEncoder:
    """The worker's encoder for a vocabulary file and a pattern."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = BatchEncoder(Vocabulary(path, pattern))
    return _ENCODERS[path, pattern]


def vocabulary(path: str, pattern: str) -> Vocabulary:
    return encoder(path, pattern).vocabulary


def _mapped(df: DataFrame, column: str, out: str, kind: T.DataType, work) -> DataFrame:
    """``df`` with ``out`` computed from ``column`` in Arrow batches; an ``out`` that is there is replaced."""
    ship_package(df.sparkSession)
    keep = [c for c in df.columns if c != out]
    source = df.select(*keep, df[column].alias("_source")) if column == out else df.select(*keep)
    name = "_source" if column == out else column

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(batch.schema.get_field_index(name))
            kept = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            for a, b, result in work(values):
                yield pa.RecordBatch.from_arrays([c.slice(a, b - a) for c in kept] + [result], names=[*keep, out])

    schema = T.StructType([source.schema[c] for c in keep] + [T.StructField(out, kind, False)])
    return source.mapInArrow(run, schema)


def encoded(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of every whole text as array<int>; other columns stay.

    A null or empty text has no ids; equal rows stay rows of their own; an
    empty table gives an empty one. A column named like ``ids`` is replaced, as
    ``withColumn`` does.
    """

    def work(values: pa.Array):
        encode = encoder(path, pattern).encode
        for a, b in K.slices(K.buffer(values)[1], SLICE):
            ids, first = encode(values.slice(a, b - a))
            yield a, b, pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids.astype(np.int32)))

    return _mapped(docs, text, ids, T.ArrayType(T.IntegerType(), False), work)


def decoded(docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of its ids as binary; a null list has none. A column named like ``out`` is replaced."""

    def work(values: pa.Array):
        table = _token_bytes(path)
        lengths = np.asarray(pc.fill_null(pc.list_value_length(values), 0)).astype(np.int64)
        first = np.concatenate([[0], np.cumsum(lengths)])
        flat = values.flatten()  # a null list has no ids
        for a, b in K.slices(first, DECODED):
            data, at = table.decode(flat.slice(first[a], first[b] - first[a]), first[a : b + 1] - first[a])
            yield a, b, pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(at), pa.py_buffer(data)]).cast(pa.binary())

    return _mapped(docs, ids, out, T.BinaryType(), work)


class TokenBytes:
    """The bytes of a vocabulary's tokens, one after the other, for whole columns of ids."""

    def __init__(self, table: dict[int, bytes]) -> None:
        ranks = np.array(sorted(table), np.int64)
        self.data, at = _joined([table[r] for r in ranks.tolist()])
        last = int(ranks.max(initial=-1))
        self.begin, self.size = np.zeros(last + 1, np.int64), np.full(last + 1, -1, np.int64)
        self.begin[ranks], self.size[ranks] = at[:-1], np.diff(at)

    def decode(self, ids: pa.Array, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the lists ``first`` cuts ``ids`` into; an id that is no token raises."""
        if ids.null_count:
            raise KeyError(None)
        ids = np.asarray(ids).astype(np.int64)
        known = (ids >= 0) & (ids < len(self.size))
        known[known] = self.size[ids[known]] >= 0
        if not known.all():
            raise KeyError(int(ids[~known][0]))
        sizes = self.size[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        where = np.arange(ends[-1]) + np.repeat(self.begin[ids] - ends[:-1], sizes)
        return self.data[where], ends[first]


@lru_cache(maxsize=2)
def _token_bytes(path: str) -> TokenBytes:
    return TokenBytes(tokens(path))
