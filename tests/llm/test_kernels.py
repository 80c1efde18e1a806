import re
import tracemalloc

import numpy as np
import pyarrow as pa
from brute import ALNUM_WORD, SPACE_WORD, low
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortcraft.llm import kernels as K
from cohortcraft.llm.fm_index import FMIndex

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aAbZ09é\t \n\x0b\x1c|!ß漢"), max_size=40)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_equal_regular_expressions(texts):
    data, offsets = K.buffer(pa.array(texts, pa.string()))
    lowered = K.lower(data)
    for breaks, pattern in ((K.SPACE, SPACE_WORD), (K.ALNUM_BREAK, ALNUM_WORD)):
        start, end, first = K.words(lowered, offsets, breaks)
        for d, text in enumerate(texts):
            own = [bytes(lowered[a:b]).decode() for a, b in zip(start[first[d] : first[d + 1]], end[first[d] : first[d + 1]], strict=True)]
            assert own == pattern.findall(low(text))
        hashes = K.word_hashes(lowered, start, end)
        spelled = [bytes(lowered[a:b]) for a, b in zip(start, end, strict=True)]
        assert len(set(hashes.tolist())) == len(set(spelled))


def test_sliced_column_and_long_text():
    column = pa.array(["x y", None, "a " * 200_000, ""]).slice(1)
    data, offsets = K.buffer(column)
    start, _, first = K.words(data, offsets)
    assert np.diff(first).tolist() == [0, 200_000, 0]
    assert K.slices(offsets, 1000) == [(0, 1), (1, 2), (2, 3)] or K.slices(offsets, 1000)[-1][1] == 3


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 4))
def test_fm_index_finds_every_occurrence(symbols, m):
    codes = np.array([*symbols, 0], np.int64)
    index = FMIndex(codes, 3)
    patterns = np.array(np.meshgrid(*[[1, 2, 3]] * m)).T.reshape(-1, m)
    low_rows, high_rows = index.search(patterns)
    for p, a, b in zip(patterns, low_rows, high_rows, strict=True):
        expected = [i for i in range(len(codes) - m + 1) if codes[i : i + m].tolist() == p.tolist()]
        assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == expected


def test_byte_classes():
    assert [c for c in range(256) if K.SPACE[c]] == [9, 10, 11, 12, 13, 32]
    assert all(bool(re.match(r"[a-z0-9]", chr(c))) != K.ALNUM_BREAK[c] for c in range(128))


def test_hashes_of_a_large_buffer_take_bounded_memory_and_equal_those_of_parts():
    text = " ".join(f"w{k % 5000}" for k in range(600_000)) + " " + "x" * (2 * K.HASHED) + " end"
    data, offsets = K.buffer(pa.array([text]))
    start, end, _ = K.words(data, offsets)
    K._powers.cache_clear()
    tracemalloc.start()
    hashes = K.word_hashes(data, start, end)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6  # tables and sums over the whole buffer take 150 MB
    own = lambda a, b: K.word_hashes(data[a:b], np.array([0]), np.array([b - a]))[0]
    assert all(hashes[k] == own(start[k], end[k]) for k in [*range(0, len(start), 9973), len(start) - 2, len(start) - 1])
