"""Recurring audit sample and file-manifest reconciliation."""

import datetime as dt

from pyspark.sql import functions as F

from cohortcraft.operators.audit import audit_sample
from cohortcraft.operators.quality import manifest_check
from cohortcraft.sources.sinks import file_digests


def test_audit_sample_is_deterministic_and_proportional(spark):
    answers = spark.range(20000).select(
        F.col("id").alias("answer_id"),
        (F.lit(dt.datetime(2024, 1, 1)) + F.make_interval(hours=(F.col("id") % 500).cast("int"))).alias("ts"),
    )
    a = audit_sample(answers, "answer_id", "ts", 0.1, seed=3)
    b = audit_sample(answers, "answer_id", "ts", 0.1, seed=3)
    n = a.count()
    assert 1700 < n < 2300
    assert a.select("answer_id").exceptAll(b.select("answer_id")).count() == 0
    assert a.where(F.col("audit_period").isNull()).count() == 0
    assert audit_sample(answers, "answer_id", "ts", 0.0).count() == 0
    assert audit_sample(answers, "answer_id", "ts", 1.0).count() == 20000


def test_manifest_check(spark, tmp_path):
    (tmp_path / "a.txt").write_text("hello")
    (tmp_path / "b.txt").write_text("world!")
    digests = file_digests(spark, str(tmp_path / "*.txt"))
    good = {r.file: r for r in digests.select(F.element_at(F.split("path", "/"), -1).alias("file"), "size_bytes", "sha256").collect()}
    manifest = spark.createDataFrame(
        [("a.txt", good["a.txt"].size_bytes, good["a.txt"].sha256), ("b.txt", 99, good["b.txt"].sha256),
         ("c.txt", 1, "x")],
        "file string, size_bytes long, sha256 string",
    )
    got = {r.file: r.status for r in manifest_check(digests, manifest).collect()}
    assert got == {"a.txt": "ok", "b.txt": "size_mismatch", "c.txt": "missing"}
