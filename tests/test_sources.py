"""Raw text reading (quoting, BOM, malformed rows), writers, digests, layered jobs."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from cohortcraft.operators.typed import TYPED_COLUMNS
from cohortcraft.plans import jobs
from cohortcraft.sources import sinks, text
from cohortcraft.sources.contract import contract_raw


def _write(path, content: str, encoding="utf-8"):
    with open(path, "w", encoding=encoding, newline="") as fh:
        fh.write(content)


def test_quoted_newline_and_doubled_quote(spark, tmp_path):
    p = tmp_path / "raw.csv"
    _write(p, 'id,desc,loan_status\n1,"a ""b""\nc",Fully Paid\n2,,Current\n')
    df = text.read_text(spark, str(p))
    rows = df.orderBy("id").collect()
    assert len(rows) == 2
    assert rows[0].desc == 'a "b"\nc'
    assert rows[1].desc is None


def test_bom_header_and_contract(spark, tmp_path):
    p = tmp_path / "bom.csv"
    _write(p, "﻿id,loan_amnt\n1,5000\n")
    assert text.read_header(spark, str(p)) == ["id", "loan_amnt"]
    df = text.read_text(spark, str(p))
    assert text.missing_columns(df.columns, text.REQUIRED_RAW_COLUMNS)[:2] == ["addr_state", "annual_inc"]
    with pytest.raises(ValueError):
        text.require_columns(df, text.REQUIRED_RAW_COLUMNS)


def test_malformed_modes(spark, tmp_path):
    p = tmp_path / "bad.csv"
    _write(p, "a,b\n1,2\n3\n4,5,6\n7,8\n")
    cols = ["a", "b"]
    lenient = text.read_text(spark, str(p), columns=cols, mode="DROPMALFORMED")
    assert sorted(r.a for r in lenient.collect()) == ["1", "7"]
    strict = text.read_text(spark, str(p), columns=cols, mode="FAILFAST")
    with pytest.raises(Exception):
        strict.collect()


def test_columnar_extract_document_digest(spark, tmp_path):
    df = spark.createDataFrame([(2014, "a"), (2015, "b")], "issue_year int, k string")
    out = sinks.write_columnar(df, str(tmp_path / "t"), partition_by=["issue_year"])
    back = spark.read.parquet(out)
    assert back.where(F.col("issue_year") == 2015).count() == 1
    assert any(f.startswith("issue_year=") for f in os.listdir(out))
    files = [f for f in os.listdir(out + "/issue_year=2014") if f.endswith(".parquet")]
    assert "zstd" in files[0]
    sinks.write_extract(df, str(tmp_path / "csv"), single_file=True)
    doc = df.agg(F.struct(F.count("*").alias("n"), F.lit("é").alias("s")).alias("x"))
    sinks.write_document(doc, str(tmp_path / "doc.json"))
    raw = (tmp_path / "doc.json").read_text(encoding="utf-8")
    assert raw.endswith("\n") and "é" in raw and json.loads(raw) == {"x": {"n": 2, "s": "é"}}
    dig = {os.path.basename(r.path): r for r in sinks.file_digests(spark, str(tmp_path / "doc.json")).collect()}
    assert dig["doc.json"].sha256 == hashlib.sha256(raw.encode("utf-8")).hexdigest()
    assert dig["doc.json"].size_bytes == len(raw.encode("utf-8"))


def test_layered_jobs_end_to_end(spark, tmp_path):
    out = str(tmp_path / "out")
    paths = jobs.run_all(spark, contract_raw(spark, "/root/testdata/sf0.001"), out)
    typed = spark.read.parquet(paths["typed"])
    cohort = spark.read.parquet(paths["cohort"] + "/analysis_cohort")
    quarterly = text.read_typed_text(spark, paths["cohort"] + "/quarterly_risk_metrics")
    assert quarterly.agg(F.sum("total_loans")).first()[0] == cohort.count()
    doc = json.loads(open(paths["cohort"] + "/governed_metrics.json").read())
    assert doc["overall_portfolio"]["total_loans"] == cohort.count()
    assert doc["generated_at_utc"].endswith("+00:00")
    check = spark.read.option("header", True).csv(paths["cohort"] + "/governed_metrics_check")
    assert check.count() == 10 and check.where("passed = 'false'").count() == 0
    q = json.loads(open(out + "/typed/quality.json").read())
    assert sum(q["status_groups"].values()) == q["row_count"] == typed.count()
    assert {"name": "term_months", "type": "smallint", "nullable": True} in q["columns"]
    man = json.loads(open(paths["cohort"] + "/manifest.json").read())
    assert man["cohort_definition"]["term_months"] == 36 and man["row_count"] == cohort.count()
    table = spark.read.parquet(out + "/cohort_files").collect()
    assert man["file_count"] == len(table) and man["total_bytes"] == sum(r.size_bytes for r in table)
    some = next(r for r in table if r.folder == "analysis_cohort")
    local = os.path.join(paths["cohort"], some.folder, some.file)
    assert some.size_bytes == os.path.getsize(local)
    assert some.sha256 == hashlib.sha256(open(local, "rb").read()).hexdigest()
    assert [c["name"] for c in q["columns"]] == list(TYPED_COLUMNS)  # layer order
    prof = json.loads(open(out + "/raw/profile.json").read())
    assert sum(prof["loan_status_distribution"].values()) == prof["row_count"]
    counts = list(prof["loan_status_distribution"].values())
    assert counts == sorted(counts, reverse=True)
    verdict = spark.read.option("header", True).csv(paths["claims"] + "/verdict").collect()
    assert {r.verdict for r in verdict} <= {"PASS", "REVIEW", "BLOCK"}
    recon = spark.read.option("header", True).csv(paths["claims"] + "/reconcile")
    assert recon.where("passed = 'false'").count() == 0
    assert typed.count() >= cohort.count()
    # the typed layer is partitioned by year, so the cohort's date bounds prune files
    plan = typed.where("issue_date >= DATE '2014-01-01' AND issue_year >= 2014")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_run_from_gzip_text(spark, tmp_path):
    raw = contract_raw(spark, "/root/testdata/sf0.001")
    src = str(tmp_path / "raw_csv")
    raw.coalesce(1).write.option("header", True).option("escape", '"').option("compression", "gzip").csv(src)
    assert any(f.endswith(".csv.gz") for f in os.listdir(src))
    out = str(tmp_path / "out")
    paths = jobs.run_from_text(spark, src, out)
    landed = spark.read.parquet(paths["landed"])
    assert landed.count() == raw.count()
    from cohortcraft.operators.typed import typed_contracts as tc
    assert spark.read.parquet(paths["typed"]).count() == tc(raw).count()
    prof = json.loads(open(out + "/raw/profile.json").read())
    assert prof["row_count"] == raw.count() and prof["column_count"] == len(raw.columns)


def test_run_from_text_rejects_missing_columns(spark, tmp_path):
    p = tmp_path / "bad.csv"
    _write(p, "id,loan_amnt\n1,5\n")
    with pytest.raises(ValueError):
        jobs.run_from_text(spark, str(p), str(tmp_path / "o"))


def test_document_goes_to_a_uri(spark, tmp_path):
    doc = spark.range(1).select(F.col("id").alias("n"))
    sinks.write_document(doc, f"file://{tmp_path}/deep/doc.json")
    assert json.loads((tmp_path / "deep" / "doc.json").read_text()) == {"n": 0}
    with pytest.raises(Exception):
        sinks.write_text(spark, f"file://{tmp_path}/deep/doc.json", "x", overwrite=False)


def test_other_header_order_fails(spark, tmp_path):
    (tmp_path / "in").mkdir()
    _write(tmp_path / "in" / "a.csv", "a,b\n1,2\n")
    _write(tmp_path / "in" / "b.csv", "b,a\n1,2\n")
    with pytest.raises(Exception):
        text.read_text(spark, str(tmp_path / "in"), columns=["a", "b"]).collect()


def test_strict_jobs_stop_on_a_broken_output(spark, tmp_path):
    out = str(tmp_path / "out")
    paths = jobs.run_all(spark, contract_raw(spark, "/root/testdata/sf0.001"), out)
    gold = paths["cohort"]
    broken = text.read_typed_text(spark, f"{gold}/risk_by_grade").withColumn("total_loans", F.col("total_loans") + 1)
    sinks.write_extract(spark.createDataFrame(broken.collect(), broken.schema), f"{gold}/risk_by_grade", single_file=True)
    with pytest.raises(jobs.CheckFailed):
        jobs.require(jobs.written_rollup_checks(spark, gold), "written rollups")
    jobs.require(jobs.written_rollup_checks(spark, gold), "written rollups", strict=False)
    stored = spark.read.parquet(f"{gold}/governed_metrics")
    wrong = stored.withColumn("overall_total_loans", F.col("overall_total_loans") + 1)
    sinks.write_columnar(spark.createDataFrame(wrong.collect(), wrong.schema), f"{gold}/governed_metrics")
    with pytest.raises(jobs.CheckFailed):
        jobs.require(jobs.metric_checks(spark, gold), "governed metrics")
    with pytest.raises(RuntimeError):
        jobs.claims_job(spark, paths["typed"] , gold, out)  # the governed row no longer agrees with the scope
