"""Block-Max MaxScore against scoring every document, on odd rows, shared hashes and many small shards."""

import math
import random
import re
import tracemalloc
from collections import Counter
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from cohortcraft.llm import block_max
from cohortcraft.llm import kernels as K

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [w.translate(LOWER) for w in TERM.findall(text or "")]


def brute(docs, items, k=10):
    """{item: [(doc_id, score)]} by scoring every document."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = {}
    for item, words in asked.items():
        found = []
        for doc_id, counts in held:
            n, score = sum(counts.values()), 0
            for t in words & set(counts):
                m = 10 + (90 * n * n_docs) // total
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * counts[t]) // (1000 * counts[t] + 8 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        rows = [(d, -s) for s, _, _, d in sorted(found)[:k]]
        if rows:
            out[item] = rows
    return out


def ranked(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        assert r["rank"] == len(out.setdefault(r["item_id"], [])) + 1
        out[r["item_id"]].append((r["doc_id"], r["score"]))
    return out


def corpus(seed, n, vocabulary=400):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeinorst") for _ in range(rng.randint(1, 6))) for _ in range(vocabulary)]
    common = [1 / (1 + i) for i in range(vocabulary)]
    return [(i, " ".join(rng.choices(words, common, k=rng.randint(1, 90)))) for i in range(n)], words, rng


@pytest.mark.parametrize("shard_bytes", [3_000, 1 << 20])
def test_search_equals_scoring_every_document(spark, docs_of, monkeypatch, shard_bytes):
    docs, words, rng = corpus(1, 900)
    docs += [(7, docs[7][1]), (2000, docs[3][1]), (1999, docs[3][1].upper())]  # repeated rows and ties
    items = [(i, " ".join(rng.sample(words, rng.randint(1, 30)))) for i in range(40)]
    monkeypatch.setattr(block_max, "SHARD_BYTES", shard_bytes)
    shards = block_max.build(docs_of(docs).repartition(3))
    found = ranked(block_max.search(shards, spark.createDataFrame(items, "item_id long, text string")))
    assert found == brute(docs, items)


def test_blocks_are_skipped(monkeypatch):
    """A long non-essential list is unpacked in part only, and windows do not change results."""
    docs, _, rng = corpus(2, 12_000, vocabulary=3000)
    docs = [(i, t + " the" * rng.randint(1, 3) if i % 2 else t) for i, t in docs]
    row = block_max._shard(pa.array([t for _, t in docs]), pa.array([i for i, _ in docs]))
    shard = block_max.Shard(row)
    impact = block_max.impacts(row["documents"], row["total"])
    rare = [w for w, n in Counter(w for _, t in docs for w in set(terms(t))).items() if 40 < n < 80][:2]
    asked = [w.encode() for w in ["the", *rare]]
    hashes = np.array([K.word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0] for w in asked])
    at = shard.find(hashes, asked)
    held = [(int(t), block_max.weight(row["documents"], int(shard.df[t]))) for t in at]
    results = []
    for window in (256, 4096, 1 << 20):
        monkeypatch.setattr(block_max, "WINDOW", window)
        best = block_max.Best(10)
        block_max.search_shard(shard, held, impact, best)
        results.append((best.score.tolist(), best.id.tolist()))
    assert results[0] == results[1] == results[2]
    unpacked, common = set(), int(at[0])
    monkeypatch.setattr(block_max, "WINDOW", 256)
    real = shard.blocks
    monkeypatch.setattr(shard, "blocks", lambda t, a, b: (unpacked.update((t, x) for x in range(a, b)), real(t, a, b))[1])
    block_max.search_shard(shard, held, impact, block_max.Best(10))
    of_common = sum(t == common for t, _ in unpacked)
    assert 0 < of_common < 0.75 * len(shard.lists(common, impact)[0]), of_common
    want = brute(docs, [(0, " ".join(["the", *rare]))])[0]
    assert list(zip(results[0][1], results[0][0], strict=True)) == want


def test_skyline_bounds_are_exact():
    docs, _, _ = corpus(3, 700, vocabulary=60)
    row = block_max._shard(pa.array([t for _, t in docs]), pa.array([i for i, _ in docs]))
    shard = block_max.Shard(row)
    for n_docs, total in ((700, 30_000), (10_000, 90_000)):
        shard.known.clear()
        impact = block_max.impacts(n_docs, total)
        for t in range(len(shard.hashes)):
            first, last, best, top = shard.lists(t, impact)
            for b in range(len(first)):
                doc, tf = shard.blocks(t, b, b + 1)
                assert (doc[0], doc[-1]) == (first[b], last[b])
                assert best[b] == impact(tf, shard.lengths[doc]).max()
            assert top == best.max()


def test_words_that_share_a_hash_stay_apart(spark, docs_of, monkeypatch):
    real = K.word_hashes
    monkeypatch.setattr(K, "word_hashes", lambda *a: real(*a) % np.uint64(5))
    docs, words, _ = corpus(4, 120, vocabulary=50)
    row = block_max._shard(pa.array([t for _, t in docs]), pa.array([i for i, _ in docs]))
    shard = block_max.Shard(row)
    df = Counter(w for _, t in docs for w in set(terms(t)))
    asked = [w.encode() for w in df] + [b"absent"]
    flat, ends = np.frombuffer(b"".join(asked), np.uint8), np.cumsum([len(w) for w in asked])
    at = shard.find(K.word_hashes(flat, ends - np.array([len(w) for w in asked]), ends), asked)
    assert at[-1] == -1
    assert {w.decode(): int(shard.df[t]) for w, t in zip(asked[:-1], at[:-1], strict=True)} == dict(df)


def test_odd_rows(spark, docs_of):
    long_text = " ".join(f"w{i % 977}" for i in range(60_000))
    docs = [(0, None), (1, ""), (2, " .,;\n"), (3, "Émile ÉMILE x"), (4, long_text), (None, "émile w1"), (5, "w1"), (5, "w1 w2")]
    items = [(0, "w1 Émile"), (1, None), (2, ""), (None, "x W2"), (3, "nothing here"), (0, "w3"), (4, "!!!")]
    frame = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS rank")
    table = docs_of(docs).withColumnRenamed("lang", "item_id").withColumnRenamed("source", "score")
    assert ranked(block_max.search(block_max.build(table), frame)) == brute(docs, items)
    empty = docs_of(docs).limit(0)
    assert block_max.search(block_max.build(empty), frame).count() == 0
    assert block_max.search(block_max.build(docs_of(docs)), frame.limit(0)).count() == 0


def test_items_in_blocks(spark, docs_of, monkeypatch):
    docs, words, rng = corpus(6, 300)
    items = [(f"item {i}", " ".join(rng.sample(words, 12))) for i in range(30)]
    monkeypatch.setattr(block_max, "BLOCK_TERMS", 100)
    found = ranked(block_max.search(block_max.build(docs_of(docs)), spark.createDataFrame(items, "item_id string, text string")))
    assert found == brute(docs, items)


def test_a_full_shard_takes_bounded_memory():
    texts = pa.array([" ".join(f"w{(k * j) % 20_011}" for j in range(700)) for k in range(1, 1800)])
    K._powers.cache_clear()
    tracemalloc.start()
    row = block_max._shard(texts, pa.array(range(len(texts)), pa.int64()))
    kept, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert row["total"] == 700 * len(texts)
    assert peak < 200e6 and kept - sum(len(v) for v in row.values() if isinstance(v, bytes)) < 20e6


def test_a_task_holds_one_shard_at_a_time(spark, docs_of, monkeypatch):
    docs, words, rng = corpus(9, 400)
    items = [(i, " ".join(rng.sample(words, 8))) for i in range(5)]
    setting, handed, write = next(iter(block_max.ONE_BY_ONE)), [], block_max.written

    def watched(df, name, *more):
        handed.append((name, spark.conf.get(setting)))
        return write(df, name, *more)

    was = spark.conf.get(setting)
    monkeypatch.setattr(block_max, "SHARD_BYTES", 3_000)
    monkeypatch.setattr(block_max, "written", watched)
    shards = block_max.build(docs_of(docs).coalesce(1))
    found = ranked(block_max.search(shards, spark.createDataFrame(items, "item_id long, text string")))
    assert found == brute(docs, items)
    for f in shards.inputFiles():
        stored = pq.ParquetFile(unquote(urlparse(f).path)).metadata
        assert stored.num_row_groups == stored.num_rows > 5  # a reader decodes a row group at a time
    assert dict(handed)["search-heaps"] == "1" and dict(handed)["search-shards"] == was
    assert spark.conf.get(setting) == was
