"""Counters of the write itself and mergeable profiles against the full-scan profile."""

import json

from pyspark.sql import functions as F

from cohortcraft.operators import layer_profile, quality
from cohortcraft.operators.typed import typed_contracts
from cohortcraft.plans import catalog, jobs
from cohortcraft.sources.contract import contract_raw

SMOKE = "/root/testdata/sf0.001"


def test_typed_job_counts_while_it_writes(spark, tmp_path):
    raw = contract_raw(spark, SMOKE)
    path = jobs.typed_job(raw, str(tmp_path / "a"))
    doc = json.loads((tmp_path / "a" / "typed" / "quality.json").read_text())
    written = spark.read.parquet(path)
    want = quality.typed_profile(written).first().asDict()
    for name, value in want.items():
        assert doc[name] == (value.isoformat() if hasattr(value, "isoformat") else value), name
    groups = {r["status_group"]: r["n"] for r in written.groupBy("status_group").agg(F.count("*").alias("n")).collect()}
    assert doc["status_groups"] == groups
    assert list(doc["status_groups"].values()) == sorted(groups.values(), reverse=True)
    assert [c["name"] for c in doc["columns"]][:2] == ["loan_id", "record_hash"] or len(doc["columns"]) == len(written.columns)


def test_sketch_form_reads_nothing_back(spark, tmp_path):
    raw = contract_raw(spark, SMOKE)
    jobs.typed_job(raw, str(tmp_path / "b"), exact_distinct=False)
    doc = json.loads((tmp_path / "b" / "typed" / "quality.json").read_text())
    exact = typed_contracts(raw).agg(F.count_distinct("loan_id")).first()[0]
    assert abs(doc["distinct_non_null_loan_ids"] - exact) <= 4 * layer_profile.STANDARD_ERROR * exact + 1


def test_a_grown_layer_is_profiled_by_its_arrivals(spark, tmp_path):
    typed = catalog.typed_layer(spark, SMOKE)
    path = str(tmp_path / "profiles")
    years = [r[0] for r in typed.select("issue_year").distinct().collect()]
    for year in years:
        layer_profile.store_profiles(layer_profile.partition_profiles(typed.where(F.col("issue_year") == year), ["issue_year"]), path)
    merged = layer_profile.merged_profile(spark.read.parquet(path), ["issue_year"]).first().asDict()
    want = quality.typed_profile(typed).first().asDict()
    distinct = want.pop("distinct_non_null_loan_ids")
    assert abs(merged.pop("estimated_distinct_loan_ids") - distinct) <= 4 * layer_profile.STANDARD_ERROR * distinct + 1
    assert merged == want


def test_overlapping_arrivals_do_not_count_ids_twice(spark):
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("loan_id"), F.lit(1).alias("part"))
    measures = [F.count("*").alias("row_count")]
    twice = layer_profile.partition_profiles(rows, ["part"], measures).unionByName(layer_profile.partition_profiles(rows, ["part"], measures))
    merged = layer_profile.merged_profile(twice, ["part"]).first()
    assert merged["row_count"] == 40_000
    assert abs(merged["estimated_distinct_loan_ids"] - 20_000) <= 4 * layer_profile.STANDARD_ERROR * 20_000
