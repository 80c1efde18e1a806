import math

import numpy as np
import pytest

from cohortcraft.llm import hashed_words as H
from cohortcraft.llm import mixing, quality_classifier

SF = "/root/testdata/sf0.01"


def _auc(score, label):
    rank = np.empty(len(score))
    rank[np.argsort(score, kind="stable")] = np.arange(1, len(score) + 1)
    n1 = label.sum()
    return (rank[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


def test_features_and_products_equal_a_loop():
    import pyarrow as pa

    texts = ["The the cat!! sat", None, "", "x", "a a a"]
    table = np.random.default_rng(0).normal(size=(1 << 10, 2))
    for i, j, flat, first in H.features(pa.array(texts), 10):
        assert (i, j) == (0, 5) and np.diff(first).tolist() == [5 + 4 + 1, 0, 0, 1, 3 + 2 + 2]
        products = H.linear(flat, first, table)
        for k in range(5):
            own, values = H.counted(flat[first[k] : first[k + 1]])
            assert products[k] == pytest.approx(values @ table[own] if len(own) else np.zeros(2))


def test_quality_on_held_out_rows(spark):
    from cohortcraft.llm.queries import QUERIES

    rows = QUERIES["op7_quality_classifier"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert _auc(rows.score.to_numpy(), rows.quality.to_numpy()) > 0.98
    assert (rows.predicted == rows.quality).mean() > 0.95


def test_quality_edges(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "good words"), (3, "good words"), (None, "bad")]).select("doc_id", "text")
    nothing = spark.createDataFrame([], "doc_id bigint, label int")
    weights = quality_classifier.fit(docs, nothing)
    assert {r.score for r in quality_classifier.scored(docs, weights).collect()} == {0.5}
    labels = spark.createDataFrame([(3, 1), (2, None), (None, 0)], "doc_id bigint, label int")
    rows = quality_classifier.scored(docs, quality_classifier.fit(docs, labels)).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert quality_classifier.scored(docs.limit(0), weights).count() == 0


def test_rates_meet_the_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = mixing.mix(docs, labels).toPandas()
    totals = np.array([(rows.n_tokens * rows.rate * rows[f"p_{d}"]).sum() for d in mixing.DOMAINS])
    share = np.array([mixing.TARGETS[d] for d in mixing.DOMAINS])
    assert totals / totals.sum() == pytest.approx(share / share.sum(), abs=1e-6)
    assert (rows.rate >= 0).all() and np.abs(rows[[f"p_{d}" for d in mixing.DOMAINS]].sum(axis=1) - 1).max() < 1e-9
    copies = np.array([(rows.n_tokens * rows.copies * rows[f"p_{d}"]).sum() for d in mixing.DOMAINS])
    assert copies.sum() == pytest.approx(totals.sum(), rel=0.1)
    known = rows.merge(labels.toPandas(), on="doc_id")
    truth = np.where(known.toxic == 1, 2, np.where(known.quality == 0, 1, 0))
    assert (known[[f"p_{d}" for d in mixing.DOMAINS]].to_numpy().argmax(axis=1) == truth).mean() > 0.95


def test_projected_gradient_equals_a_plain_solver(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.3, 0.3, 0.3], 300)
    n = rng.integers(1, 500, 300)
    members = spark.createDataFrame([(int(k), *map(float, x)) for k, x in zip(n, p, strict=True)], "n_tokens bigint, p_clean double, p_low double, p_toxic double")
    fit = mixing.fit_rates(members, {"clean": 0.7, "low": 0.25, "toxic": 0.05}, anchor=None)
    rate = np.ones(300)
    goal = np.array([0.7, 0.25, 0.05]) * n.sum()
    for _ in range(20_000):  # plain projected gradient, small steps
        rate = np.maximum(0, rate - p @ ((rate * n) @ p - goal) / n.sum())
    assert fit.residual <= 1e-9
    assert members.withColumn("r", mixing._rate(fit.steps)).toPandas().r.to_numpy() @ (n[:, None] * p) == pytest.approx(goal, rel=1e-6)
    assert (rate * n) @ p == pytest.approx(goal, rel=1e-3)


def test_mixing_edges(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "some words"), (3, "some words"), (None, "x")])
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = mixing.mix(docs, labels).collect()
    assert len(rows) == 5 and all(r.rate >= 0 for r in rows)
    assert mixing.mix(docs.limit(0), labels).count() == 0
    blank = docs_of([(1, None), (2, "")])
    assert {r.rate for r in mixing.mix(blank, labels).collect()} == {1.0}
    assert mixing.mixed(docs.withColumnRenamed("lang", "p_clean"), labels).columns == ["doc_id", "text", "p_clean", "source", "n_chars"]


def test_ftrl_equals_a_plain_loop():
    """The published update, coordinate by coordinate."""
    from cohortcraft.llm.quality_classifier import Ftrl

    rng = np.random.default_rng(9)
    alpha, beta, l1, l2 = 0.3, 1.0, 0.02, 0.1
    model, z, n = Ftrl(12, alpha, beta, l1, l2), {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        sign = 1.0 if z[i] > 0 else -1.0
        return -(z[i] - sign * l1) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(300):
        at = np.sort(rng.choice(13, rng.integers(1, 6), replace=False))
        x, y = rng.integers(1, 4, len(at)).astype(float), float(rng.integers(0, 2))
        w = {int(i): weight(int(i)) for i in at}
        p = 1 / (1 + math.exp(-sum(w[int(i)] * v for i, v in zip(at, x))))
        model.update(at, x, y)
        for i, v in zip(map(int, at), x):
            g = (p - y) * v
            sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha
            z[i], n[i] = z.get(i, 0.0) + g - sigma * w[i], n.get(i, 0.0) + g * g
    assert model.weights() == pytest.approx([weight(i) if i in z else 0.0 for i in range(13)], abs=1e-12)
