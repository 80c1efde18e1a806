"""Layers follow their inputs and their code; concurrent builders agree on one table."""

import shutil
from concurrent.futures import ThreadPoolExecutor

from cohortcraft.plans import catalog

SMOKE = "/root/testdata/sf0.001"


def _inputs(tmp_path):
    d = tmp_path / "sf"
    d.mkdir()
    for t in ("orders", "customer"):
        shutil.copyfile(f"{SMOKE}/{t}.parquet", d / f"{t}.parquet")
    return str(d)


def test_changed_input_is_seen_in_the_same_session(spark, tmp_path):
    d = _inputs(tmp_path)
    before = catalog.typed_layer(spark, d).count()
    half = spark.read.parquet(f"{SMOKE}/orders.parquet").where("o_orderkey % 2 = 0").toPandas()
    half.to_parquet(f"{d}/orders.parquet", coerce_timestamps="us")
    after = catalog.typed_layer(spark, d).count()
    assert 0 < after < before


def test_changed_code_rebuilds(spark, tmp_path, monkeypatch):
    d = _inputs(tmp_path)
    first = catalog._layer_root(spark, d)
    assert first == catalog._layer_root(spark, d)
    monkeypatch.setattr(catalog, "_code_version", lambda: "other")
    assert first != catalog._layer_root(spark, d)


def test_concurrent_builders_publish_one_table(spark, tmp_path):
    path = str(tmp_path / "layer")
    build = lambda _: catalog._materialized(spark, lambda: spark.range(100), path)
    with ThreadPoolExecutor(4) as pool:
        found = list(pool.map(build, range(4)))
    assert {df.count() for df in found} == {100}
    assert len({tuple(sorted(df.inputFiles())) for df in found}) == 1


def test_layers_are_built_in_methods_that_the_jvm_compiles(spark, tmp_path, monkeypatch):
    key = "spark.sql.codegen.hugeMethodLimit"
    before, seen = spark.conf.get(key), []
    write = catalog.write_columnar

    def watched(df, path, **options):
        seen.append((int(spark.conf.get(key)), options.get("block_size_bytes")))
        return write(df, path, **options)

    monkeypatch.setattr(catalog, "write_columnar", watched)
    rows = catalog._materialized(spark, lambda: spark.range(3).selectExpr("id", "id % 2 AS p"), str(tmp_path / "raw"))
    assert sorted(r["id"] for r in rows.collect()) == [0, 1, 2]
    assert seen == [(8000, catalog.LAYER_BLOCK)]
    assert spark.conf.get(key) == before
