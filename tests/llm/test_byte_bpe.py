"""Prefix-table BPE against the public library: whole texts, appends, edits, bytes back."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortcraft.llm import byte_bpe
from cohortcraft.llm.queries import op12_byte_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SMOKE = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n\n  \t", "a", "don't I'll we've", "x" * 5000, "  " * 300 + "end", "😀é漢字" * 40, "\x00\x01", "á ½ ٣"]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.vocabulary(PATH, PATTERN)


LETTERS = st.text(alphabet=st.sampled_from(list("aabcdeinorst  \n\t's19é€😀.,!")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(LETTERS)
def test_ids_equal_the_library(vocabulary, library, text):
    ids = vocabulary.encode(text)
    assert ids == library.encode_ordinary(text)
    assert vocabulary.decode(ids) == text.encode()


UNICODE_SPACES = st.text(alphabet=st.sampled_from(list("ab'1. \n\t\r\x0b\x1c\x1f\x85\xa0\u1680\u2003\u2028\u202f\u205f\u3000é")), max_size=40)


SIGNS = st.text(alphabet=st.sampled_from(list("aZé×÷ßÿ'’.,!-_@[{~ 7²\u0301\n")), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), LETTERS, UNICODE_SPACES, SIGNS), max_size=8))
def test_batches_equal_the_library(library, texts):
    """Tables of many pieces at once, texts cut at white space."""
    ids, first = byte_bpe.encoder(PATH, PATTERN).encode(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert ids[first[i] : first[i + 1]].tolist() == library.encode_ordinary(t or "")


def test_caches_start_anew(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE", 5)
    encoder = byte_bpe.BatchEncoder(byte_bpe.vocabulary(PATH, PATTERN))
    for texts in (["some words here and more of them"], ["other words", "here and there"], ["some words here"]):
        ids, first = encoder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == [library.encode_ordinary(t) for t in texts]


def test_plain_merging_agrees(vocabulary):
    rng = random.Random(4)
    for _ in range(300):
        data = bytes(rng.choice(b"aeinorst\xc3\xa9") for _ in range(rng.randint(1, 25)))
        assert byte_bpe.PrefixTable(vocabulary, data).ids() == vocabulary.merged(data)


@pytest.mark.parametrize("text", [t for t in ODD if t])
def test_odd_texts(vocabulary, library, text):
    assert vocabulary.encode(text) == library.encode_ordinary(text)


def test_appends_leave_what_stands(vocabulary):
    rng = random.Random(5)
    whole, table = b"", byte_bpe.PrefixTable(vocabulary)
    for _ in range(40):
        more = bytes(rng.choice(b"thenationing") for _ in range(rng.randint(1, 9)))
        stands = list(table.last)
        table.append(more)
        whole += more
        assert list(table.last)[: len(stands)] == stands
        assert table.ids() == vocabulary.merged(whole)


def test_edits_work_near_the_change(vocabulary):
    rng = random.Random(6)
    data = bytes(rng.choice(b"thenationingserd") for _ in range(3000))
    table, anew = byte_bpe.PrefixTable(vocabulary, data), []
    for _ in range(25):
        a = rng.randrange(len(data) - 40)
        b, new = a + rng.randrange(0, 12), bytes(rng.choice(b"aeiou") for _ in range(rng.randrange(0, 9)))
        data = data[:a] + new + data[b:]
        anew.append(table.replace(a, b, new))
        fresh = byte_bpe.PrefixTable(vocabulary, data)
        assert table.last == fresh.last and table.data == fresh.data
    assert sorted(anew)[len(anew) // 2] < 600  # of about 3,000


@settings(max_examples=150, deadline=None)
@given(LETTERS, LETTERS, st.integers(0, 60), st.integers(0, 12))
def test_edited_text_equals_the_library(vocabulary, library, text, new, start, length):
    edited = byte_bpe.EditedText(vocabulary, text)
    start = min(start, len(text))
    edited.replace(start, min(len(text), start + length), new)
    assert edited.text == text[:start] + new + text[start + length :]
    assert edited.ids() == library.encode_ordinary(edited.text)
    edited.append(text)
    assert edited.ids() == library.encode_ordinary(edited.text)


def test_operator_on_odd_rows(spark, docs_of, library):
    docs = docs_of(list(enumerate(ODD)) + [(3, "same id"), (3, "same id"), (None, "no id")])
    docs = docs.withColumnRenamed("lang", "ids").withColumnRenamed("source", "decoded")  # clashing names
    out = byte_bpe.decoded(byte_bpe.encoded(docs, PATH, PATTERN), PATH)
    assert set(out.columns) == {"doc_id", "text", "n_chars", "ids", "decoded"}
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["ids"] == library.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    assert byte_bpe.encoded(docs.limit(0), PATH, PATTERN).count() == 0
    again = byte_bpe.encoded(docs.select("text"), PATH, PATTERN, ids="text")  # in place of the text itself
    assert again.columns == ["text"] and again.count() == docs.count()


def test_query_against_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()}
    rows = op12_byte_bpe(spark, SMOKE).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        ids = library.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_lists_of_ids_decode_at_once():
    table = byte_bpe.TokenBytes({0: b"a", 2: b"bc", 5: "\u00e9".encode()})
    data, at = table.decode(pa.array([2, 0, 5, 5, 2], pa.int32()), np.array([0, 1, 1, 4, 5]))
    assert [bytes(data[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)] == [b"bc", b"", "a\u00e9\u00e9".encode(), b"bc"]
    for wrong in ([1], [6], [-1], [None]):
        with pytest.raises(KeyError):
            table.decode(pa.array(wrong, pa.int32()), np.array([0, 1]))
    assert byte_bpe.TokenBytes({}).decode(pa.array([], pa.int32()), np.array([0]))[1].tolist() == [0]
