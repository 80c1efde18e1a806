"""Outputs as one versioned set: readers see whole sets, a stopped build publishes nothing."""

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest

from cohortcraft.plans import jobs, versions
from cohortcraft.sources.contract import contract_raw

SMOKE = "/root/testdata/sf0.001"


def small_build(spark, value, folder):
    spark.range(value).write.parquet(f"{folder}/table")
    spark.range(3).selectExpr("id", "id % 2 AS k").write.partitionBy("k").parquet(f"{folder}/other/parts")
    return {}


def test_sets_are_published_whole(spark, tmp_path):
    root = str(tmp_path / "root")
    with pytest.raises(versions.NothingPublished):
        versions.current(spark, root)
    first = versions.run_versioned(spark, 5, root, small_build)
    assert versions.current(spark, root) == first
    old = spark.read.parquet(f"{first}/table")

    def stops(spark_, value, folder):
        small_build(spark_, value, folder)
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError, match="killed"):
        versions.run_versioned(spark, 7, root, stops)
    assert versions.current(spark, root) == first
    second = versions.run_versioned(spark, 9, root, small_build)
    assert versions.current(spark, root) == second
    assert old.count() == 5 and spark.read.parquet(f"{second}/table").count() == 9
    assert [n for n, _ in versions.published(spark, root)] == [1, 2]
    assert versions.retire(spark, root, keep=1) == [first]
    assert versions.current(spark, root) == second and not Path(first).exists()


def test_a_changed_file_is_not_published(spark, tmp_path):
    root = str(tmp_path / "root")
    folder = versions.run_versioned(spark, 5, root, small_build)
    broken = next(Path(folder, "other").rglob("part-*.parquet"))
    for crc in broken.parent.glob(f".{broken.name}.crc"):
        crc.unlink()
    broken.write_bytes(broken.read_bytes() + b"x")
    with pytest.raises(jobs.CheckFailed, match="size_mismatch"):
        versions.publish(spark, root, folder)
    broken.unlink()
    with pytest.raises(jobs.CheckFailed, match="missing"):
        versions.publish(spark, root, folder)
    assert len(versions.published(spark, root)) == 1


def test_concurrent_publishers_get_numbers_of_their_own(spark, tmp_path):
    root = str(tmp_path / "root")
    with ThreadPoolExecutor(4) as pool:
        folders = list(pool.map(lambda n: versions.run_versioned(spark, n, root, small_build), range(1, 5)))
    found = versions.published(spark, root)
    assert [n for n, _ in found] == [1, 2, 3, 4] and {f for _, f in found} == set(folders)


def test_a_stopped_full_build_keeps_the_previous_set(spark, tmp_path, monkeypatch):
    """The whole layered build; its last job fails the second time."""
    root, raw = str(tmp_path / "root"), contract_raw(spark, SMOKE)
    build = lambda s, r, folder: jobs.run_all(s, r, folder, strict=False)
    first = versions.run_versioned(spark, raw, root, build)
    rows = spark.read.parquet(f"{versions.current(spark, root)}/cohort/analysis_cohort").count()

    def fails(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(jobs, "vintage_job", fails)
    with pytest.raises(RuntimeError, match="killed"):
        versions.run_versioned(spark, raw, root, build)
    assert versions.current(spark, root) == first
    assert spark.read.parquet(f"{first}/cohort/analysis_cohort").count() == rows > 0
    assert Path(first, "vintage", "logit_vintage_effect").exists()
