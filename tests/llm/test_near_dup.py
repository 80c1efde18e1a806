import random

import numpy as np
from brute import near_duplicates as brute_force

from cohortcraft.llm import minhash, near_dup
from cohortcraft.llm.components import connected_components


def _corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base = [[word() for _ in range(rng.choice([3, 5, 9, 60, 200]))] for _ in range(40)]
    docs = {}
    for i in range(400):
        w = list(rng.choice(base)) if rng.random() < 0.7 else [word() for _ in range(50)]
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            w[rng.randrange(len(w))] = word()
        docs[i * 7] = " ".join(w) if rng.random() < 0.9 else " ".join(w).upper()
    docs[9001], docs[9002], docs[9003] = None, "", " \n\t"
    return docs


def test_components_equal_brute_force(spark, docs_of, monkeypatch):
    docs = _corpus()
    for block in (700,):  # large groups meet in many pairs of blocks
        monkeypatch.setattr(minhash, "BLOCK", block)
        rows = near_dup.near_duplicates(docs_of(docs.items())).collect()
        assert len(rows) == len(docs)
        expected = brute_force(docs)
        for r in rows:
            assert (r.n_shingles, r.component_id) == expected[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)


def test_edge_rows(spark, docs_of):
    pairs = [(5, "a b c d e f"), (5, "a b c d e f"), (2, "A b c D e f"), (None, "a b c d e f"), (None, None), (8, "solo"), (9, "solo")]
    rows = near_dup.near_duplicates(docs_of(pairs)).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in rows) == sorted(
        [("5", "2", False), ("5", "2", False), ("2", "2", True), ("None", "None", False), ("None", "None", False), ("8", "8", True), ("9", "8", False)]
    )
    assert near_dup.near_duplicates(docs_of([])).count() == 0


def test_stage_keeps_one_row_per_group_and_all_columns(spark, docs_of):
    pairs = [(1, "a b c d e f g"), (1, "a b c d e f g"), (3, "a b c d e f g"), (4, None), (5, "x y"), (None, "k")]
    left = near_dup.without_near_duplicates(docs_of(pairs))
    assert left.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(str(r.doc_id) for r in left.collect()) == ["1", "4", "5", "None"]


def test_tuned_bands_reach_their_recall():
    b = near_dup.BANDING
    assert b.recall(0.85) >= 1 - 5e-6
    assert minhash.tune(0.8, 0.01, 3).recall(0.8) >= 0.99


def test_alternating_stars(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(500, 500), (600, 601), (601, 600), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 600: 600, 601: 600}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_other_texts_of_a_repeated_id_stay(spark, docs_of):
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(30))
    docs = docs_of([(1, text(1)), (1, text(2)), (1, text(1)), (2, text(3)), (3, text(3)), (None, text(4)), (None, text(4))])
    left = near_dup.without_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == sorted([(1, text(1)), (1, text(2)), (2, text(3)), (0, text(4)), (0, text(4))])


def test_large_units_compare_only_sets_that_share_a_rare_shingle(monkeypatch):
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(120):
        base = rng.choice(100_000, 21, replace=False)
        for changed in (0, 1, 2, 4):
            copy = base.copy()
            copy[:changed] = rng.integers(100_000, 200_000, changed)
            sets.append(np.unique(copy).astype("<u4"))
    dense = minhash.spanning_links(sets, np.zeros(len(sets), np.int64), 80)
    compared = []
    sums = minhash._sums
    monkeypatch.setattr(minhash, "DENSE", 0)
    monkeypatch.setattr(minhash, "_sums", lambda seen, codes, first, sizes: compared.append(len(first)) or sums(seen, codes, first, sizes))
    assert minhash.spanning_links(sets, np.zeros(len(sets), np.int64), 80) == dense
    assert sum(compared) < len(sets) ** 2 // 10
    side = rng.integers(0, 2, len(sets))
    across = minhash.spanning_links(sets, side, 80)
    monkeypatch.setattr(minhash, "DENSE", 1 << 30)
    assert minhash.spanning_links(sets, side, 80) == across
