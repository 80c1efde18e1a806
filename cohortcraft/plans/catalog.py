"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query starts from the driver's tables (through the contract adapter)
so its work grows with them. The raw and typed layers are derived once per
input version and written under the shared checkpoint folder; queries read
them back. Nothing row-sized is collected (the logistic fits return one
summary row per model).
"""

from __future__ import annotations

import hashlib
import inspect
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from threading import Lock

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortcraft.functions import classify, parse
from cohortcraft.functions.metrics import n_rows
from cohortcraft.operators import claims, difference, layer_profile, quality, rollup, scope_cube, stats, typed
from cohortcraft.operators.audit import audit_sample, reconciled_audit
from cohortcraft.operators.claim_table import check_claims, metric_values
from cohortcraft.operators.cohort import (
    GRADE_SCOPES, PRIMARY_SCOPE, SCOPES, SENSITIVITY_SCOPES, SUBGRADE_SCOPES, analysis_cohort, dashboard_extract,
)
from cohortcraft.operators.document import governed_metrics
from cohortcraft.operators.model import binary_logit, fitted_totals, rounded_single_predictor, vintage_logit
from cohortcraft.operators.typed import TYPED_COLUMNS, typed_contracts
from cohortcraft.session import checkpoint_dir
from cohortcraft.sources import adapters, contract, records, sinks, text
from cohortcraft.sources.columnar import driver_table
from cohortcraft.sources.contract import contract_raw, lineitem_contracts
from cohortcraft.sources.sinks import file_system, write_columnar, write_text

Query = Callable[[SparkSession, str], DataFrame]


# Layer materialization. The raw and typed layers are written once per input
# version as Parquet tables under the shared folder named by
# ``spark.checkpoint.dir`` (the typed layer partitioned by issue_year) and every
# query reads them back: lineage is cut at stable storage, and scans get
# pushdown and partition pruning. The key covers the input files (path, size,
# modification time; summed on the executors) and the sources of the modules
# that make the layers, and is computed anew on every call, so neither changed
# inputs nor changed code can meet an old layer.
_INPUTS = ("orders", "customer")
_LAYER_MODULES = (contract, typed, parse, classify, sinks)


def _code_version() -> str:
    text = "".join(inspect.getsource(m) for m in _LAYER_MODULES)
    return hashlib.sha1(text.encode()).hexdigest()


def _input_key(spark: SparkSession, sf_dir: str) -> str:
    files = spark.read.format("binaryFile").load([f"{sf_dir.rstrip('/')}/{t}.parquet" for t in _INPUTS])
    mark = F.xxhash64("path", "length", "modificationTime")  # metadata only, content is never read
    seen = files.agg(F.count("*").alias("n"), F.sum(mark.cast("decimal(38,0)")).alias("s"), F.bit_xor(mark).alias("x")).first()
    return hashlib.sha1(f"{_code_version()}|{sf_dir}|{seen['n']}|{seen['s']}|{seen['x']}".encode()).hexdigest()[:16]


def _published(spark: SparkSession, pointer: str) -> str | None:
    """Folder that the pointer file names; None while there is no pointer."""
    fs, target = file_system(spark, pointer)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


@contextmanager
def _compiled_methods(spark: SparkSession):
    """Within it, Spark generates code in methods that the JVM compiles.

    One method for the layers' thirty columns has more bytecode than HotSpot
    compiles (8000 bytes) and would be interpreted; beyond the limit Spark
    splits the projection into smaller methods. Builders in several threads of
    a session share the setting; the last one puts the old value back.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    with _LOCK:
        if not _BUILDERS:
            _BUILDERS.append(spark.conf.get(key))
            spark.conf.set(key, "8000")
        _BUILDERS.append(key)
    try:
        yield
    finally:
        with _LOCK:
            _BUILDERS.pop()
            if len(_BUILDERS) == 1:
                spark.conf.set(key, _BUILDERS.pop())


_LOCK, _BUILDERS = Lock(), []  # the value from before, then one entry per running builder


LAYER_BLOCK = 8 << 20
"""Bytes of a row group of the layers: their text is dear to parse, so that few rows make a task's share."""


def _materialized(spark: SparkSession, df_fn: Callable[[], DataFrame], path: str,
                  partition_by: list[str] | None = None) -> DataFrame:
    """Read the published table at ``path``, building it first if needed.

    A builder writes a folder of its own and then creates one small pointer
    file, which fails if there is one: the first builder publishes, the others
    read what it published. Nothing is renamed or overwritten.
    """
    pointer = f"{path}.pointer"
    place = _published(spark, pointer)
    if place is None:
        own = f"{path}-{uuid.uuid4().hex}"
        with _compiled_methods(spark):
            write_columnar(df_fn(), own, partition_by=partition_by, block_size_bytes=None if partition_by else LAYER_BLOCK)
        try:
            write_text(spark, pointer, own, overwrite=False)
        except Py4JJavaError:
            if _published(spark, pointer) is None:
                raise
        place = _published(spark, pointer)
    return spark.read.parquet(place)


def _layer_root(spark: SparkSession, sf_dir: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/cohortcraft-layers/{_input_key(spark, sf_dir)}"


def raw_layer(spark: SparkSession, sf_dir: str, root: str | None = None) -> DataFrame:
    root = root or _layer_root(spark, sf_dir)
    return _materialized(spark, lambda: contract_raw(spark, sf_dir), f"{root}/raw")


def typed_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _layer_root(spark, sf_dir)
    return _materialized(
        spark,
        lambda: typed_contracts(raw_layer(spark, sf_dir, root)),
        f"{root}/typed",
        partition_by=["issue_year"],
    ).select(*TYPED_COLUMNS)


def cohort_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis_cohort(typed_layer(spark, sf_dir))


def _on_cohort(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(cohort_layer(spark, sf_dir))


def _on_typed(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(typed_layer(spark, sf_dir))


def _status_taxonomy(typed: DataFrame) -> DataFrame:
    keys = ["loan_status", "status_group", "default_flag", "is_resolved", "is_current", "is_delinquent"]
    return typed.groupBy(*keys).agg(n_rows().alias("loans"))


def _bands(cohort: DataFrame) -> DataFrame:
    return cohort.groupBy("income_band", "dti_band", "loan_amount_band").agg(n_rows().alias("loans"))


def _rollup_reconcile(cohort: DataFrame) -> DataFrame:
    return rollup.rollup_reconcile(
        cohort,
        {
            # counts come from the rollups' own aggregation; medians are not summed
            "quarterly": rollup.quarterly_rollup(cohort, medians=False),
            "grade": rollup.grade_rollup(cohort, medians=False),
            "purpose": rollup.purpose_rollup(cohort, medians=False),
        },
    )


def _layer_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.layer_reconcile(raw_layer(spark, sf_dir), typed_layer(spark, sf_dir))


def _distribution_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.distribution_reconcile(raw_layer(spark, sf_dir), typed_layer(spark, sf_dir))


def _scope_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = typed_layer(spark, sf_dir)
    # the nine gold checks compare no median, so the governed row skips them
    return claims.scope_reconcile(claims.scope_metrics(typed), governed_metrics(analysis_cohort(typed), medians=False))


def _claim_status(typed: DataFrame) -> DataFrame:
    return claims.claim_status(claims.scope_metrics(typed))


def _claim_verdict(typed: DataFrame) -> DataFrame:
    return claims.claim_verdict(claims.claim_status(claims.scope_metrics(typed)))


def _landed_orders(spark: SparkSession, sf_dir: str, broken: bool, strict: bool) -> tuple[DataFrame, DataFrame]:
    source = adapters.orders_text(spark, sf_dir, broken)
    out = f"{checkpoint_dir(spark).rstrip('/')}/orders-landed-{uuid.uuid4().hex}"
    return records.land(spark, source, adapters.ORDER_COLUMNS, out, header=False, strict=strict)


def _orders_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against a written later version of them: some keys gone, some new, some values changed."""
    old = driver_table(spark, sf_dir, "orders")
    out = f"{checkpoint_dir(spark).rstrip('/')}/orders-version-{uuid.uuid4().hex}"
    write_columnar(adapters.next_orders(old), out)
    return difference.difference(old, spark.read.parquet(out), ["o_orderkey"])


CUBE_SCOPES = (*SCOPES, *SENSITIVITY_SCOPES, *GRADE_SCOPES, *SUBGRADE_SCOPES)


def _scope_cube(typed: DataFrame) -> DataFrame:
    fine = scope_cube.cells(typed)
    return claims.scope_metrics(typed, CUBE_SCOPES, aggregates=scope_cube.scope_aggregates(fine, CUBE_SCOPES))


def _partition_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters per year, stored in two arrivals and merged without a rescan; the sketch is held against the exact count."""
    typed_ = typed_layer(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/profiles-{uuid.uuid4().hex}"
    late = F.col("issue_year") >= 2013
    for arrival in (typed_.where(~late), typed_.where(late)):
        layer_profile.store_profiles(layer_profile.partition_profiles(arrival, ["issue_year"]), path)
    merged = layer_profile.merged_profile(spark.read.parquet(path), ["issue_year"])
    exact = typed_.agg(F.count_distinct("loan_id").alias("distinct_non_null_loan_ids"))
    both = merged.withColumn("_one", F.lit(1)).join(exact.withColumn("_one", F.lit(1)), "_one").drop("_one")  # two single rows
    off = F.abs(F.col("estimated_distinct_loan_ids") - F.col("distinct_non_null_loan_ids"))
    within = off <= F.ceil(4 * layer_profile.STANDARD_ERROR * F.col("distinct_non_null_loan_ids"))
    return both.withColumn("sketch_within_error", within).drop("estimated_distinct_loan_ids")


def _typed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` through the CSV sink, its header check and the typed scan."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/customer-csv-{uuid.uuid4().hex}"
    source = driver_table(spark, sf_dir, "customer")
    sinks.write_extract(source, path)
    missing = text.missing_columns(text.read_header(spark, path), source.columns)
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return text.read_typed_text(spark, path, source.schema)


QUERIES: dict[str, Query] = {
    # text sources
    "text_rows": lambda spark, d: _landed_orders(spark, d, broken=False, strict=True)[0],
    "text_rows_lenient": lambda spark, d: _landed_orders(spark, d, broken=True, strict=False)[0],
    "text_rejects": lambda spark, d: _landed_orders(spark, d, broken=True, strict=False)[1].select("text", "reason"),
    "text_typed": _typed_customers,
    # raw and typed layers
    "raw_profile": lambda spark, d: quality.raw_profile(raw_layer(spark, d)),
    "silver_rows": typed_layer,
    "status_taxonomy": _on_typed(_status_taxonomy),
    "status_distribution": _on_typed(quality.status_distribution),
    "distribution_reconcile": _distribution_reconcile,
    "layer_reconcile": _layer_reconcile,
    "quality_counters": _on_typed(quality.typed_profile),
    "maturity": _on_typed(quality.maturity),
    "table_fingerprint": _on_typed(quality.table_fingerprint),
    # cohort and governed rollups
    "cohort_rows": cohort_layer,
    "bands": _on_cohort(_bands),
    "dashboard_extract": _on_cohort(dashboard_extract),
    "quarterly_rollup": _on_cohort(rollup.quarterly_rollup),
    "grade_rollup": _on_cohort(rollup.grade_rollup),
    "purpose_rollup": _on_cohort(rollup.purpose_rollup),
    "lineitem_rollup": lambda spark, d: rollup.grade_rollup(lineitem_contracts(spark, d)),
    "governed_metrics": _on_cohort(governed_metrics),
    "cohort_rules": _on_cohort(quality.cohort_profile),
    "rollup_reconcile": _on_cohort(_rollup_reconcile),
    # vintage statistics
    "ztest_battery": _on_cohort(stats.hypothesis_battery),
    "ztest_pvalues": _on_cohort(lambda c: stats.with_p_values(stats.hypothesis_battery(c))),
    "mix_rate_decomposition": _on_cohort(stats.mix_rate_decomposition),
    "grade_period_comparison": _on_cohort(stats.grade_period_comparison),
    "price_vs_risk": _on_cohort(lambda c: stats.price_vs_risk(stats.grade_period_comparison(c))),
    "band_shift": _on_cohort(stats.band_shift),
    "quarter_trend_pivot": _on_cohort(stats.quarter_trend),
    "vintage_logit": _on_cohort(rounded_single_predictor),
    "vintage_logit_full": _on_cohort(vintage_logit),
    "vintage_logit_totals": _on_cohort(fitted_totals),
    "band_lookup": _on_cohort(lambda c: stats.band_shift(c).where(F.col("dti_band") == "30+")),
    # multi-scope claim validation
    "scope_metrics": _on_typed(claims.scope_metrics),
    "claim_status": _on_typed(_claim_status),
    "claim_verdict": _on_typed(_claim_verdict),
    "scope_reconcile": _scope_reconcile,
    "sensitivity_scope_metrics": _on_typed(lambda t: claims.scope_metrics(t, SCOPES + SENSITIVITY_SCOPES)),
    "segment_scope_metrics": _on_typed(lambda t: claims.scope_metrics(t, (PRIMARY_SCOPE, *GRADE_SCOPES, *SUBGRADE_SCOPES))),
    "cohort_assertions": _on_cohort(quality.key_and_domain),
    "scope_cube": _on_typed(_scope_cube),
    "partition_profile": _partition_profile,
    "orders_difference": _orders_difference,
    "claim_table": lambda spark, d: check_claims(adapters.customer_claims(spark, d), metric_values(typed_layer(spark, d))),
    "audit_reconciled": lambda spark, d: reconciled_audit(adapters.event_answers(spark, d), adapters.event_metric_versions(spark, d), 25),
    "audit_sample": lambda spark, d: audit_sample(driver_table(spark, d, "events").select("event_id", "ts"), "event_id", "ts", 0.1),
    # the same statistics on a second 2x2 input: toxic rate by quality label
    "labels_ztest": lambda spark, d: stats.group_proportion_test(driver_table(spark, d, "labels"), "quality", "toxic", 1, 0),
    "labels_logit": lambda spark, d: binary_logit(driver_table(spark, d, "labels"), "toxic", "quality", "toxic_by_quality"),
}

# Queries whose result is order-sensitive output of a global sort.
ORDERED = {"dashboard_extract"}

__all__ = ["QUERIES", "ORDERED", "typed_layer", "cohort_layer", "raw_layer"]
