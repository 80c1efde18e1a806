import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from brute import SPACE_WORD, low
from pyspark.sql import functions as F

from cohortcraft.llm import attention_lm as A
from cohortcraft.llm import lm_scoring

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    v = 20
    p = {k: x.astype(np.float64) for k, x in A.initial(v + 1).items()}
    ids, place = rng.integers(0, v, 40), np.concatenate([np.arange(25), np.arange(15)])
    target = rng.integers(0, A.CLASSES, 40)
    _, g, own = A.gradient(p, ids, place, target)
    for k in p:
        spot = tuple(rng.integers(0, s) for s in p[k].shape)
        spot = (own[2], 3) if k == "E" else spot
        up, down = ({n: x.copy() for n, x in p.items()} for _ in range(2))
        up[k][spot] += 1e-2
        down[k][spot] -= 1e-2
        slope = (A.gradient(up, ids, place, target)[0] - A.gradient(down, ids, place, target)[0]) / 2e-2
        assert (g[k][2, 3] if k == "E" else g[k][spot]) == pytest.approx(slope, rel=2e-2, abs=2e-5)


def test_blocks_score_each_id_once_as_one_pass_would(monkeypatch):
    rng = np.random.default_rng(1)
    v = 50
    p, class_of = A.initial(v + 1), rng.integers(0, A.CLASSES, v + 1)
    logs = A.in_class_logs(rng.integers(0, 9, v + 1), class_of)
    first = np.array([0, 0, 30, 31, 200])
    ids = rng.integers(0, v, 200)
    whole = A.score(p, ids, first, v, class_of, logs)
    monkeypatch.setattr(A, "BLOCK", 20)
    assert A.score(p, ids, first, v, class_of, logs) == pytest.approx(whole, rel=1e-5)
    alone = [A.score(p, ids[a:b], np.array([0, b - a]), v, class_of, logs)[0] for a, b in zip(first[:-1], first[1:], strict=True)]
    assert alone == pytest.approx(whole, rel=1e-5)


def plain_log_probability(p, text, end, class_of, log_in_class):
    """ln P of one text, one token at a time, every sum a loop."""
    d, total = A.D, 0.0
    dot = lambda a, b: sum(float(x) * float(y) for x, y in zip(a, b, strict=True))
    times = lambda v, m: [dot(v, m[:, j]) for j in range(m.shape[1])]
    symbols = [end, *text]
    for t, following in enumerate([*text, end]):
        x = p["E"][symbols[t]]
        q, lags = times(x, p["Q"]), range(min(A.SPAN, t + 1))
        scores = [dot(q, times(p["E"][symbols[t - lag]], p["K"])) / math.sqrt(d) + float(p["b"][lag]) for lag in lags]
        weights = [math.exp(s - max(scores)) for s in scores]
        values = [times(p["E"][symbols[t - lag]], p["V"]) for lag in lags]
        c = [sum(w * v[j] for w, v in zip(weights, values, strict=True)) / sum(weights) for j in range(d)]
        u = [a + b + float(z) for a, b, z in zip(times(x, p["A"]), times(np.array(c), p["B"]), p["a"], strict=True)]
        h = np.array([v / (1 + abs(v)) for v in u])
        group, member = divmod(int(class_of[following]), A.MEMBERS)
        for scores, at in ((np.array(times(h, p["G"])) + p["g"], group), (np.array(times(h, p["O"][group])) + p["o"][group], member)):
            total += float(scores[at]) - math.log(sum(math.exp(s) for s in scores))
        total += float(log_in_class[following])
    return total


def test_scores_equal_a_plain_attention_loop():
    rng = np.random.default_rng(6)
    v = 30
    p = {k: x + rng.normal(0, 0.2, x.shape).astype(np.float32) for k, x in A.initial(v + 1).items()}
    class_of = rng.integers(0, A.CLASSES, v + 1)
    logs = A.in_class_logs(rng.integers(0, 9, v + 1), class_of)
    texts = [rng.integers(0, v, n) for n in (0, 1, 7, 8, 9, 25)]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = A.score(p, np.concatenate(texts), first, v, class_of, logs)
    assert got == pytest.approx([plain_log_probability(p, t.tolist(), v, class_of, logs) for t in texts], rel=1e-4)


def test_probabilities_sum_to_one():
    v = 12
    p = A.initial(v + 1)
    class_of = np.arange(v + 1) % A.CLASSES
    logs = A.in_class_logs(np.arange(v + 1), class_of)
    used = np.unique(class_of)
    ids, place = np.array([v, 3, 4]), np.arange(3)
    per_class = {c: A.class_log_probabilities(p, ids, place, np.full(3, c), 0)[-1] for c in range(A.CLASSES)}
    assert sum(math.exp(x) for x in per_class.values()) == pytest.approx(1, rel=1e-5)
    for c in used:
        assert np.exp(logs[class_of == c]).sum() == pytest.approx(1)


@pytest.fixture(scope="module")
def scored(spark):
    from cohortcraft.llm.queries import QUERIES

    return QUERIES["op6_lm_scoring"](spark, "/root/testdata/sf0.01").toPandas()


def test_base_score_equals_brute_force(spark, scored):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    counts = Counter()
    for d, t in docs:
        if not held(d):
            counts.update(SPACE_WORD.findall(low(t)))
            counts["<end>"] += 1
    n, v = sum(counts.values()), len(counts)
    rows = scored.set_index("doc_id")
    assert set(scored.train_tokens) == {n}
    for d, t in docs:
        tokens = [*SPACE_WORD.findall(low(t)), "<end>"]
        r = rows.loc[d]
        assert (r.held_out, r.n_tokens, r.n_known) == (held(d), len(tokens), sum(counts[w] > 0 for w in tokens))
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens), rel=1e-9)


def test_scores_are_log_probabilities(scored):
    assert np.isfinite(scored.score).all() and (scored.score < 0).all()


def test_model_beats_unigrams_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 3000").select("doc_id", "text")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    rows = lm_scoring.scored(docs, held, PATH).where("held_out").toPandas()
    assert rows.score.sum() > rows.base_score.sum()


def test_rare_words_meet_their_counts_in_the_join(spark, docs_of, monkeypatch):
    docs = docs_of([(k, f"alpha beta w{k % 5} v{k}") for k in range(40)] + [(100, None), (101, "")])
    want = {r.doc_id: (r.n_known, r.base_score) for r in lm_scoring.scored(docs, F.lit(False), PATH).collect()}
    monkeypatch.setattr(lm_scoring, "HEAD", 2)
    got = {r.doc_id: (r.n_known, r.base_score) for r in lm_scoring.scored(docs, F.lit(False), PATH).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], rel=1e-12)


def test_edges(spark, docs_of):
    assert lm_scoring.scored(docs_of([]), F.lit(False), PATH).count() == 0
    rows = lm_scoring.scored(docs_of([(1, None), (None, "a b"), (1, None)]), F.lit(True), PATH).collect()
    assert sorted(r.n_tokens for r in rows) == [1, 1, 3] and all(r.n_known == 0 and r.train_tokens == 0 for r in rows)


def test_training_takes_every_row(spark, docs_of, monkeypatch):
    keep, trained = lm_scoring.written, []

    def watched(df, name):
        out = keep(df, name)
        if name == "trained":
            trained.append(out)
        return out

    monkeypatch.setattr(lm_scoring, "written", watched)
    rows = spark.range(4000).select(F.xxhash64("id").alias("key"), F.lit(b"\x01\x00\x02\x00").alias("ids"))
    lm_scoring.fit_model(rows, 100, "<u2")
    assert sum(t.where("piece = 0").agg(F.sum("weight")).first()[0] or 0 for t in trained) == 4000 * 3


def test_classes_come_from_all_rows(spark):
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 300, 20) for _ in range(1600)] + [rng.integers(300, 310, 20) for _ in range(30)]
    rows = spark.createDataFrame([(k, bytearray(t.astype("<u2").tobytes())) for k, t in enumerate(texts)], "key bigint, ids binary")
    class_of = lm_scoring.fit_model(rows, 310, "<u2").class_of
    assert (class_of[300:310] < A.CLASSES - 1).all()  # not the class of ids without context


def plain_neighbours(texts, project, end):
    """(ids, PROFILE) sums, one neighbour at a time."""
    out = np.zeros((end + 1, A.PROFILE))
    half = A.PROFILE // 2
    for text in texts:
        symbols = [end, *text.tolist(), end]
        for before, after in zip(symbols[:-1], symbols[1:], strict=True):
            out[after, :half] += project[before]
            out[before, half:] += project[after]
    return out


@pytest.mark.parametrize("end", [40, 70_000])
def test_neighbour_sums_equal_a_plain_loop(monkeypatch, end):
    monkeypatch.setattr(A, "PAIRS", 7)  # runs of an id's neighbours go over the edges of the blocks
    rng = np.random.default_rng(8)
    texts = [rng.integers(0, end, n) for n in (0, 1, 2, 60, 90)] + [np.full(9, end - 1), np.zeros(0, np.int64)]
    project, total = A.projection(end + 1), np.zeros((end + 1, A.PROFILE))
    A.add_neighbours(total, texts[:4], project)
    A.add_neighbours(total, texts[4:], project)
    assert (total == plain_neighbours(texts, project, end)).all()


def test_neighbours_take_one_look_at_each_distinct_pair():
    class Counted(np.ndarray):
        rows = 0

        def take(self, at, **how):
            Counted.rows += len(at)
            return np.asarray(self).take(at, **how)

    texts = [np.tile(np.arange(5), 400)] * 3
    total = np.zeros((51, A.PROFILE))
    A.add_neighbours(total, texts, A.projection(51).view(Counted))
    assert 0 < Counted.rows <= 2 * 7  # of 6,003 neighbours on each side


def test_gradient_of_every_parameter_equals_differences():
    rng = np.random.default_rng(11)
    v, n = 12, 30
    p = {k: x.astype(np.float64) + rng.normal(0, 0.1, x.shape) for k, x in A.initial(v + 1).items()}
    ids, place = rng.integers(0, v, n), np.concatenate([np.arange(3), np.arange(20), np.arange(7)])
    target = rng.integers(0, A.CLASSES, n)
    _, g, own = A.gradient(p, ids, place, target)
    assert own.tolist() == np.unique(ids).tolist()
    for k, of in g.items():
        way = rng.normal(0, 1, p[k].shape)
        moved = lambda by: A.gradient({**p, k: p[k] + by * way}, ids, place, target)[0]  # noqa: B023, E731
        assert (of * (way[own] if k == "E" else way)).sum() == pytest.approx((moved(1e-5) - moved(-1e-5)) / 2e-5, rel=1e-4, abs=1e-8), k


def test_blocks_shorter_than_the_span():
    rng = np.random.default_rng(12)
    p = A.initial(10)
    for n in (1, 2, A.SPAN - 1):
        loss, g, own = A.gradient(p, rng.integers(0, 9, n), np.arange(n), rng.integers(0, A.CLASSES, n))
        assert np.isfinite(loss) and all(np.isfinite(x).all() for x in g.values()) and len(own) <= n


@pytest.mark.parametrize("size", [1, 2, 5, 1000])
def test_frequent_words_are_found_by_their_leading_bits(size):
    rng = np.random.default_rng(size)
    words = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
    for own in (words, np.unique(words >> np.uint64(30)), np.unique(words | np.uint64(2**64 - 2**40))):  # spread, and all in few buckets
        asked = np.concatenate([own, own + np.uint64(1), rng.integers(0, 2**64, 500, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)])
        at = lm_scoring._places(own, lm_scoring._bounds(own), asked)
        assert ((own[at] == asked) == np.isin(asked, own)).all()
