"""Incremental landing equals the batch typed build over the same files."""

from pyspark.sql import functions as F

from cohortcraft.operators.typed import typed_contracts
from cohortcraft.sources.contract import contract_raw
from cohortcraft.sources.text import read_text
from cohortcraft.streaming import land_raw_files


def test_landing_two_drops_matches_batch(spark, tmp_path):
    raw = contract_raw(spark, "/root/testdata/sf0.001")
    landing = tmp_path / "landing"
    half = raw.where(F.col("id").cast("long") % 2 == 0)
    rest = raw.where(F.col("id").cast("long") % 2 == 1)
    half.coalesce(1).write.option("header", True).option("escape", '"').csv(str(landing / "drop1"))
    out = str(tmp_path / "typed")
    ckpt = str(tmp_path / "ckpt")
    q = land_raw_files(spark, str(landing / "*"), raw.columns, out, checkpoint_location=ckpt)
    q.awaitTermination(300)
    first = spark.read.parquet(out).count()
    rest.coalesce(1).write.option("header", True).option("escape", '"').csv(str(landing / "drop2"))
    q = land_raw_files(spark, str(landing / "*"), raw.columns, out, checkpoint_location=ckpt)
    q.awaitTermination(300)
    streamed = spark.read.parquet(out)
    batch = typed_contracts(read_text(spark, str(landing / "*"), columns=raw.columns))
    assert 0 < first < streamed.count()
    assert streamed.count() == batch.count() == typed_contracts(raw).count()
    cols = ["loan_id", "record_hash", "default_flag"]
    assert streamed.select(cols).exceptAll(batch.select(cols)).count() == 0
