import pickle
import random
import tracemalloc
from types import SimpleNamespace

import pyarrow as pa
from brute import contamination
from pyspark.sql import functions as F

from cohortcraft.llm import decontaminate
from cohortcraft.llm import kernels as K


def _tables(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["É", "x9", "漢字"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.choice([1, 2, 5, 13, 14, 30]))) for k in range(25)] + [(25, None), (26, "--"), (7, text(20)), (None, text(15))]
    docs = []
    for k in range(150):
        parts = [text(rng.randrange(0, 40))]
        if rng.random() < 0.5:
            parts += [rng.choice(items)[1] or "", text(5)]
        docs.append((k, ", ".join(parts).upper() if rng.random() < 0.2 else "\n".join(parts)))
    return docs + [(900, None), (901, ""), (902, "..."), (903, items[0][1] * 3)], items


def test_equals_brute_force_also_in_many_blocks_and_shards(spark, docs_of, monkeypatch):
    docs, items = _tables()
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    expected = contamination(docs, [("" if i is None else i, t) for i, t in items])
    for block, shard, held in ((decontaminate.BLOCK, decontaminate.SHARD, 8), (300, 500, 8), (300, 700, 1), (100, 900, 3)):
        monkeypatch.setattr(decontaminate, "BLOCK", block)
        monkeypatch.setattr(decontaminate, "HELD", held)
        monkeypatch.setattr(decontaminate, "SHARD", shard)
        rows = decontaminate.mark_contaminated(docs_of(docs), benchmark, keep_text=True).collect()
        assert len(rows) == len(docs)
        for r in rows:
            n, hit, found = expected[r.doc_id]
            assert (r.n_words, r.n_hit, sorted(r["items"])) == (n, len(hit), found), r.doc_id
            assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= n)
            assert all(r.text[s.start : s.end].strip() for s in r.spans)


def test_empty_tables_and_clashing_columns(spark, docs_of):
    benchmark = spark.createDataFrame([], "item_id bigint, text string")
    docs = docs_of([(1, "a b"), (None, None)])
    assert {r.n_hit for r in decontaminate.mark_contaminated(docs, benchmark).collect()} == {0}
    assert decontaminate.mark_contaminated(docs.limit(0), benchmark).count() == 0
    clash = docs.withColumn("n_words", F.lit("own"))
    left = decontaminate.without_contaminated(clash, spark.createDataFrame([(1, "a b")], "item_id bigint, text string"))
    assert left.columns == clash.columns and [r.n_words for r in left.collect()] == ["own"]


def test_spans_cut_the_phrase(spark, docs_of):
    phrase = " ".join(f"p{k}" for k in range(13))
    docs = docs_of([(1, f"Vor é {phrase}. Nach")])
    row = decontaminate.mark_contaminated(docs, spark.createDataFrame([(1, phrase)], "item_id bigint, text string"), keep_text=True).first()
    assert decontaminate.without_spans(row.text, row.spans) == "Vor é . Nach"


def test_marking_a_full_shard_takes_bounded_memory():
    texts = pa.array([" ".join(f"w{(k * j) % 20_011}" for j in range(700)) for k in range(1, 1800)])
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), texts], names=["doc_id", "text"])
    blocks = [("test", SimpleNamespace(value=[pickle.dumps(decontaminate.Phrases(["1"], [texts[5].as_py()], 13))]))]
    mark = decontaminate._marker(blocks, "text", ["doc_id"], False, True)
    K._powers.cache_clear()
    tracemalloc.start()
    out = list(mark(iter([rows])))
    kept, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert sum(b.num_rows for b in out) == len(texts) and out[0].column("n_hit")[5].as_py() == 700
    assert peak < 200e6 and kept < 30e6
