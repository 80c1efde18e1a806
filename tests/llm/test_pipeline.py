"""The pipeline against plain Python versions of its stages."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from brute import contamination, near_duplicates
from tokenizers import Tokenizer

import corpus_pipeline
from cohortcraft.llm import mixing
from cohortcraft.llm import quality_rules as rules
from cohortcraft.llm.storage import table, written

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before the first stage and after each one."""
    docs = table(spark, SF, "documents")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "test-stage")
        seen.append(docs)
    return seen


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:-1])
    assert stages[-1].columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_rules_and_near_dedup(stages):
    kept = {r.doc_id for r in rules.quality_rules(stages[0]).where("kept").collect()}
    assert {r.doc_id for r in stages[1].collect()} == kept
    docs = {r.doc_id: r.text for r in stages[1].collect()}
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(i for i, (_, c) in near_duplicates(docs).items() if i == c)


def test_decontamination(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [(r.doc_id, r.text) for r in stages[2].collect()]
    clean = sorted(d for d, (n, hit, _) in contamination(docs, items).items() if not hit or 20 * len(hit) < n)
    assert sorted(r.doc_id for r in stages[3].collect()) == clean and len(clean) < len(docs)


def test_mixing_meets_its_targets(spark, stages):
    """Expected token shares of the drawn rows, by the stage's own posteriors, against the stage's targets."""
    before, after = stages[3], stages[4]
    weights = mixing.fit(before.select("doc_id", "text"), table(spark, SF, "labels"))
    shares = []
    for rows in (before, after):
        m = mixing.memberships(rows.select("doc_id", "text"), weights).toPandas()
        totals = np.array([(m.n_tokens * m[f"p_{d}"]).sum() for d in mixing.DOMAINS])
        shares.append(totals / totals.sum())
    want = np.array([corpus_pipeline.TARGETS[d] for d in mixing.DOMAINS])
    kept = np.minimum(want, shares[0])  # no row is repeated, so a domain never grows
    assert np.abs(shares[1] - kept / kept.sum()).max() < 0.005, (shares, want)


def test_mixing_drops_toxic_and_keeps_clean(spark, stages):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = ({r.doc_id for r in s.collect()} for s in stages[3:5])
    assert after <= before
    toxic = {d for d in before if d in labels and labels[d].toxic == 1}
    clean = {d for d in before if d in labels and labels[d].toxic == 0 and labels[d].quality == 1}
    assert len(toxic & after) <= 0.05 * len(toxic) + 1 and len(clean - after) <= 0.01 * len(clean)
    assert set(mixing.TARGETS) == set(mixing.DOMAINS)


def test_token_ids_of_the_rest(stages):
    texts = sorted((r.doc_id, r.text) for r in stages[4].collect())
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, want = 0, []
    for (d, _), e in zip(texts, t.encode_batch([x for _, x in texts], add_special_tokens=False), strict=True):
        ids = np.array([*e.ids, 2], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in stages[5].collect()) == want


def test_run_goes_through_all_stages(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and 0 < rows.count() < 200


def test_stages_take_odd_rows(spark, docs_of, tmp_path):
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    odd = docs_of([(1, None), (1, None), (None, ""), (None, None), (2, "x")])
    for rows in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, rows, str(tmp_path)).collect()


def test_a_fit_that_misses_its_targets_warns(spark):
    members = spark.createDataFrame([(100, 0.5, 0.5, 0.0)], "n_tokens bigint, p_clean double, p_low double, p_toxic double")
    with pytest.warns(UserWarning, match="miss the targets"):
        mixing.fit_rates(members, accept=True)
    with pytest.raises(mixing.MissedTargets, match="miss the targets"):
        mixing.fit_rates(members)
