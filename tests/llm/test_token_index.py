import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortcraft.llm import token_index
from cohortcraft.llm.storage import folder
from cohortcraft.llm.subwords import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abcXYZ's't \n\t\x0b\x1c\x85\xa0́éÉ漢😀!#<|>_0123"), st.characters(codec="utf-8")), max_size=60), max_size=4))
def test_word_by_word_equals_whole_text(texts):
    import pyarrow as pa

    whole, own = Tokenizer.from_file(PATH) if not hasattr(test_word_by_word_equals_whole_text, "t") else test_word_by_word_equals_whole_text.t, Encoder(PATH)
    test_word_by_word_equals_whole_text.t = whole
    texts = [*texts, "a<|endoftext|>b <|startoftext|>", ""]
    ids, first = own.encode(pa.array(texts, pa.string()))
    for k, t in enumerate(texts):
        assert ids[first[k] : first[k + 1]].tolist() == whole.encode(t, add_special_tokens=False).ids, t


def test_words_that_share_pieces_look_them_up_once(tokenizer):
    own, asked = Encoder(PATH), []
    piece = own.piece
    own.piece = lambda p: asked.append(p) or piece(p)
    texts = ["Maple, maple! MAPLE maple...", "é, É! ×é maple,", "maple's maple<s> <|endoftext|>, 3maple É"]
    ids, first = own.encode(pa.array(texts))
    assert sorted(asked) == sorted(["maple", ",", "!", "...", "é"])
    assert len(own.lengths) == 5 + 5  # and the words that are no such pieces
    for k, t in enumerate(texts):
        assert ids[first[k] : first[k + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids
    before = len(own.lengths)
    own.encode(pa.array(["MAPLE! É... maple's"]))
    assert len(own.lengths) == before


@given(st.sets(st.integers(0, 2**64 - 1), max_size=300))
def test_perfect_hash_is_minimal(keys):
    keys = np.array(sorted(keys), np.uint64)
    table = token_index.PerfectHash.build(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(len(keys)))


def test_round_trip(spark, docs_of, tokenizer, monkeypatch):
    pairs = [(k * 3, f"Text {k} mit Wörtern " * (k % 7)) for k in range(120)]
    pairs += [(12, "twice"), (12, "twice"), (None, "no key"), (None, None), (-5, "negative"), (10**12, None), (6, "x " * 3000)]
    monkeypatch.setattr(token_index, "SHARD_IDS", 500)
    path = folder(spark, "test-ids")
    token_index.write_shards(docs_of(pairs), path, PATH)
    shards = token_index.read_shards(spark, path)
    rows = sorted(token_index.documents_of(shards).collect(), key=lambda r: r.start)
    assert len(rows) == len(pairs) and rows[0].start == 0
    keys = [r.doc_id for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    want = {}
    for key, text in pairs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.setdefault(key, []).append((len(ids), zlib.crc32(ids.tobytes())))
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    wanted = spark.createDataFrame([(9,), (10,), (-5,), (7777,)], "key bigint")
    found = {r.key: r.ids for r in token_index.look_up(shards, wanted).collect()}
    assert set(found) == {9, -5} and found[-5] == [*tokenizer.encode("negative", add_special_tokens=False).ids, 2]


def test_look_up_finds_first_documents_in_any_shard(spark, docs_of, monkeypatch):
    """Keys over several written partitions and shards; a repeated key crosses shards."""
    monkeypatch.setattr(token_index, "SHARD_IDS", 40)
    monkeypatch.setattr(token_index, "SLICE", 200)
    pairs = [(k * 2 - 100, f"text {k} " * (k % 5)) for k in range(400)] + [(301, f"same {k}") for k in range(60)] + [(None, "none")]
    path = folder(spark, "test-lookup")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_index.write_shards(docs_of(pairs).repartition(5), path, PATH)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    shards = token_index.read_shards(spark, path)
    assert shards.count() > 10 and shards.select("part").distinct().count() > 1
    wanted = spark.createDataFrame([(k,) for k in [*range(-110, 720), None, 10**15, 10, 10]], "key bigint")
    found = {r.key: r.ids for r in token_index.look_up(shards, wanted).collect()}
    assert set(found) == {k for k, _ in pairs if k is not None}
    first = {}
    for r in shards.orderBy("part", "seq").collect():
        shard = token_index.Shard(bytes(r["image"]))
        for k, ordinal in zip(r["keys"], shard.first_documents(token_index._plain_keys(pa.array(r["keys"], pa.int64()))).tolist()):
            first.setdefault(k, shard.document(ordinal).tolist())
    assert all(found[k] == first[k] for k in found)
    assert token_index.look_up(shards.limit(0), wanted).count() == 0


def test_empty_table(spark, docs_of):
    path = folder(spark, "test-empty")
    token_index.write_shards(docs_of([]), path, PATH)
    assert token_index.documents_of(token_index.read_shards(spark, path)).count() == 0


def test_unknown_keys_and_wrong_images():
    keys = np.arange(50, dtype=np.uint64)
    shard = token_index.Shard(token_index.build_image(keys, np.arange(100, dtype=np.uint32), np.arange(0, 101, 2)))
    assert (shard.first_documents(keys) == np.arange(50)).all()
    assert (shard.first_documents(np.arange(1000, 3000, dtype=np.uint64)) == -1).all()
    assert shard.document(3).tolist() == [6, 7]
    with pytest.raises(ValueError):
        token_index.Shard(b"something else")
