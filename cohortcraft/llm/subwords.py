"""Subword ids of whole texts with the ``tokenizers`` library, word by word.

The tokenizer's own steps (normalizer, pre-tokenizer, model) run once per
distinct word and the results are kept in a bounded cache of the worker. This
equals encoding the whole text, as no step of the tokenizer crosses ASCII white
space. A word of Latin letters, with or without ASCII signs after them, is two
pieces whose normal form is their lower case, so only the model has to run,
once per distinct piece: such words are cut into their pieces before any look-up.
A word that holds a special token's marker goes through ``encode``.
"""

from __future__ import annotations

import json
from array import array

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from cohortcraft.llm import kernels as K

CACHE = 250_000
"""Distinct units (pieces, and words that are no such pieces) that a worker keeps; beyond it the cache starts anew (results do not change)."""

# Plain words are precomposed Latin-1 letters, then ASCII signs but the apostrophe (which opens
# contractions) and the less-than sign (which opens special tokens).
_OTHER, _LETTER, _SIGN = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KIND[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in "'<"]] = _SIGN
_WHOLE = K.U64(0x77686F6C65776F72)


def _counts(flags: np.ndarray) -> np.ndarray:
    """How many flags are set before each position."""
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def units(data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(bytes, start, end, whole, first) of the units of words: letters in lower case, then signs; other words ``whole``."""
    kind, low = _KIND[data], K.lower(data)
    lead = np.flatnonzero(data[:-1] == 0xC3)  # letters U+00C0 to U+00FF, without the signs of multiplication and division
    lead = lead[~np.isin(data[lead + 1], (0x97, 0xB7))]
    kind[lead] = kind[lead + 1] = _LETTER
    low[lead + 1] += np.where(data[lead + 1] < 0x9F, 0x20, 0).astype(np.uint8)
    wrong = kind == _OTHER
    wrong[1:] |= (kind[:-1] == _SIGN) & (kind[1:] == _LETTER)
    wrong[start] = kind[start] != _LETTER
    wrongs, signs = _counts(wrong), _counts(kind == _SIGN)
    plain = wrongs[end] == wrongs[start]
    if not plain.all():
        edge = np.zeros(len(data) + 1, np.int8)
        edge[start[~plain]] = 1
        edge[end[~plain]] -= 1
        kept = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
        low[kept] = data[kept]
    split = end - (signs[end] - signs[start])
    two = plain & (split < end)
    at = np.concatenate([[0], np.cumsum(1 + two)])
    begin, stop = np.empty(at[-1], np.int64), np.empty(at[-1], np.int64)
    begin[at[:-1]], stop[at[1:] - 1] = start, end
    begin[at[:-1][two] + 1] = stop[at[:-1][two]] = split[two]
    return low, begin, stop, np.repeat(~plain, 1 + two), at[first]


class Encoder:
    def __init__(self, path: str) -> None:
        self.tokenizer = t = Tokenizer.from_file(path)
        self.size = t.get_vocab_size(with_added_tokens=True)
        with open(path, encoding="utf-8") as f:
            self.special = [x["content"] for x in json.load(f)["added_tokens"]]
        spelled = lambda c: t.pre_tokenizer.pre_tokenize_str(c)[0][0]  # noqa: E731  byte-level form of a letter
        self.spelling = {c: s for c in range(0xDF, 0x100) if chr(c).isalpha() and (s := spelled(chr(c)))}
        self._reset()

    def _reset(self) -> None:
        self.hashes, self.slots = np.zeros(0, K.U64), np.zeros(0, np.int64)  # of the units kept, by hash
        self.ids, self.lengths = array("I"), array("I")

    def piece(self, piece: str) -> array:
        """Ids of one piece in its normal form."""
        return array("I", [x.id for x in self.tokenizer.model.tokenize(piece if piece.isascii() else piece.translate(self.spelling))])

    def word(self, word: str) -> array:
        """Ids of a text without ASCII white space inside."""
        t = self.tokenizer
        if "<" in word and any(s in word for s in self.special):
            return array("I", t.encode(word, add_special_tokens=False).ids)
        normal = t.normalizer.normalize_str(word)
        return array("I", [x.id for piece, _ in t.pre_tokenizer.pre_tokenize_str(normal) for x in t.model.tokenize(piece)])

    def _slots(self, hashes: np.ndarray, raw: bytes, start: np.ndarray, end: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Slot of each of the distinct units, given by ascending hash; new ones are encoded."""
        if len(self.lengths) >= CACHE:
            self._reset()
        at = np.searchsorted(self.hashes, hashes)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == hashes[known]
        out = np.empty(len(hashes), np.int64)
        out[known] = self.slots[at[known]]
        new = np.flatnonzero(~known)
        out[new] = len(self.lengths) + np.arange(len(new))
        for a, b, w in zip(start[new].tolist(), end[new].tolist(), whole[new].tolist(), strict=True):
            text = raw[a:b].decode("utf-8")
            ids = self.word(text) if w else self.piece(text)
            self.ids.extend(ids)
            self.lengths.append(len(ids))
        self.hashes = np.insert(self.hashes, at[new], hashes[new])
        self.slots = np.insert(self.slots, at[new], out[new])
        return out

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids uint32, first): ids of every text, one after the other; a null has none."""
        data, offsets = K.buffer(column)
        return self.encode_words(data, *K.words(data, offsets))

    def encode_words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` of texts that are cut into their words (``kernels.words``)."""
        data, start, end, whole, first = units(data, start, end, first)
        hashes = K.word_hashes(data, start, end)
        hashes[whole] ^= _WHOLE
        # equal units of the batch are looked up once
        distinct, spot, which = np.unique(hashes, return_index=True, return_inverse=True)
        at = self._slots(distinct, data.tobytes(), start[spot], end[spot], whole[spot])[which.reshape(-1)]
        lengths = np.array(self.lengths, np.int64)
        begin = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        sizes = lengths[at]
        out = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        where = np.arange(out[-1]) - np.repeat(out[:-1] - begin[at], sizes)
        return np.array(self.ids, np.uint32)[where], out[first]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
