"""Composite jobs: the layered build, each layer written once and re-read.

``run_all`` chains them like the reference's four steps:

1. raw profile of the text layer (document);
2. typed layer written as Parquet partitioned by ``issue_year`` plus its
   quality profile (the write is the lineage cut);
3. cohort (Parquet), dashboard extract, three rollups, governed metrics
   document and a manifest with per-file digests -- every consumer reads
   the written cohort, whose date bounds prune partitions of the typed layer;
4. multi-scope claim validation (single scan) with its reconciliation;
5. vintage statistics tables.

Paths are plain strings under ``out_root``; on a cluster that is shared
storage. Nothing row-sized is collected; documents are one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortcraft.functions.classify import STATUS_GROUPS
from cohortcraft.functions.metrics import half_even, n_where
from cohortcraft.operators import claims, layer_profile, quality, rollup, stats
from cohortcraft.operators.cohort import analysis_cohort, dashboard_extract
from cohortcraft.operators.document import governed_document, governed_metrics
from cohortcraft.operators.model import vintage_logit
from cohortcraft.operators.typed import TYPED_COLUMNS, typed_contracts
from cohortcraft.sources import text
from cohortcraft.sources.columnar import read_columnar
from cohortcraft.sources.sinks import file_digests, with_generated_at, write_columnar, write_document, write_extract


def raw_profile_job(raw: DataFrame, out_root: str) -> DataFrame:
    profile = quality.raw_profile(raw)
    # status -> count, largest first (ties by status), as an ordered map
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("loans")).alias("k"), "loan_status", "loans")))
    entries = F.transform(ordered, lambda e: F.struct(e["loan_status"], e["loans"]))
    doc = profile.agg(
        F.first("row_count").alias("row_count"),
        F.lit(len(raw.columns)).alias("column_count"),
        F.first("first_issue_date").alias("first_issue_date"),
        F.first("last_issue_date").alias("last_issue_date"),
        F.first("distinct_loan_statuses").alias("distinct_loan_statuses"),
        F.map_from_entries(entries).alias("loan_status_distribution"),
        F.array(*[F.lit(c) for c in raw.columns]).alias("columns"),
    )
    write_document(with_generated_at(doc), f"{out_root}/raw/profile.json")
    return doc


def _one_row_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Combine two one-row frames side by side (a constant-key join of single rows)."""
    return left.withColumn("_one", F.lit(1)).join(right.withColumn("_one", F.lit(1)), "_one").drop("_one")


def typed_job(raw: DataFrame, out_root: str, exact_distinct: bool = True) -> str:
    """Write the typed layer and its quality document.

    The counters and the status distribution come from the write itself. The
    exact distinct id count reads the written id column once; without
    ``exact_distinct`` a sketch of the same pass gives it and nothing is read.
    """
    path = f"{out_root}/typed/contracts"
    spark = raw.sparkSession
    typed = typed_contracts(raw)
    groups = [n_where(F.col("status_group") == g).alias(f"group_{i}") for i, g in enumerate(STATUS_GROUPS)]
    measures = [*layer_profile.counters(typed), *groups]
    if not exact_distinct:
        measures.append(layer_profile.sketch())
    seen = layer_profile.write_profiled(typed, path, measures, partition_by=["issue_year"])
    counted = {g: seen.pop(f"group_{i}") for i, g in enumerate(STATUS_GROUPS)}
    written = read_columnar(spark, path).select(*TYPED_COLUMNS)
    if exact_distinct:
        distinct = written.agg(F.count_distinct("loan_id").alias("n")).first()["n"]
    else:
        held = spark.createDataFrame([(seen.pop("loan_id_sketch"),)], "s binary")
        distinct = held.select(F.hll_sketch_estimate("s").alias("n")).first()["n"]
    columns = [(n, t, nl) for n, t, nl in quality.schema_rows(written)]
    first = {"row_count": seen.pop("row_count"), "distinct_non_null_loan_ids": distinct}
    fields = {**first, **seen, "status_groups": {g: n for g, n in counted.items() if n}}
    kinds = [f"{name} {'date' if name.endswith('issue_date') else 'bigint'}" for name in fields if name != "status_groups"]
    doc = spark.createDataFrame(
        [(*fields.values(), columns)],
        ", ".join([*kinds, "status_groups map<string,bigint>", "columns array<struct<name:string,type:string,nullable:boolean>>"]),
    )
    write_document(with_generated_at(doc), f"{out_root}/typed/quality.json")
    return path


class CheckFailed(RuntimeError):
    """A layer does not meet its checks; the failed ones are listed."""


def require(checks: DataFrame, name: str, strict: bool = True, limit: int = 20) -> None:
    """Raise when a row of ``checks`` (with a boolean ``passed``) has not passed."""
    if not strict:
        return
    failed = checks.where(~F.coalesce(F.col("passed"), F.lit(False))).limit(limit).collect()  # shown in the error only
    if failed:
        raise CheckFailed(f"{name}: " + "; ".join(str(r.asDict()) for r in failed))


ROLLUPS = {"quarterly": "quarterly_risk_metrics", "grade": "risk_by_grade", "purpose": "risk_by_purpose"}


def written_rollup_checks(spark: SparkSession, gold: str) -> DataFrame:
    """Sums of the written rollup files against the written cohort."""
    cohort = read_columnar(spark, f"{gold}/analysis_cohort")
    tables = {name: text.read_typed_text(spark, f"{gold}/{folder}") for name, folder in ROLLUPS.items()}
    return rollup.rollup_reconcile(cohort, tables).withColumn("passed", F.col("difference") == 0)


def metric_checks(spark: SparkSession, gold: str) -> DataFrame:
    """The written overall and segment counts against plain filters over the written cohort (another route than the document's)."""
    cohort = read_columnar(spark, f"{gold}/analysis_cohort")
    stored = read_columnar(spark, f"{gold}/governed_metrics")
    parts = {"overall": cohort, "segment": cohort.where(F.col("purpose") == "debt_consolidation")}
    found = None
    for name, rows in parts.items():
        one = rows.groupBy().agg(
            F.count("*").alias(f"{name}_total_loans"),
            F.count(F.when(F.col("outcome") == "Defaulted", 1)).alias(f"{name}_defaulted_loans"),
            (100.0 * F.count(F.when(F.col("outcome") == "Defaulted", 1)) / F.count("default_flag")).alias(f"{name}_default_rate_pct"),
            (F.sum("loan_amount") / F.count("loan_amount")).alias(f"{name}_average_loan_amount_usd"),
            (F.sum("interest_rate_pct") / F.count("interest_rate_pct")).alias(f"{name}_average_interest_rate_pct"),
        )
        found = one if found is None else _one_row_join(found, one)
    return quality.compare_metrics(stored.select(*found.columns), found, {}, default_tolerance=0.006)


def cohort_job(spark: SparkSession, typed_path: str, out_root: str, strict: bool = True) -> str:
    typed = read_columnar(spark, typed_path)
    gold = f"{out_root}/cohort"
    write_columnar(analysis_cohort(typed), f"{gold}/analysis_cohort")
    cohort = read_columnar(spark, f"{gold}/analysis_cohort")
    write_extract(dashboard_extract(cohort), f"{gold}/dashboard_extract")
    write_extract(rollup.quarterly_rollup(cohort), f"{gold}/{ROLLUPS['quarterly']}", single_file=True)
    write_extract(rollup.grade_rollup(cohort), f"{gold}/{ROLLUPS['grade']}", single_file=True)
    write_extract(rollup.purpose_rollup(cohort), f"{gold}/{ROLLUPS['purpose']}", single_file=True)
    flat = governed_metrics(cohort, rounding=half_even)
    write_columnar(flat.coalesce(1), f"{gold}/governed_metrics")
    stored = read_columnar(spark, f"{gold}/governed_metrics")
    write_document(with_generated_at(governed_document(stored)), f"{gold}/governed_metrics.json")
    check = metric_checks(spark, gold)
    write_extract(check, f"{gold}/governed_metrics_check", single_file=True)
    require(check, "governed metrics", strict)
    require(written_rollup_checks(spark, gold), "written rollups", strict)
    definition = F.struct(
        F.lit("2014-01-01").alias("issue_date_start"),
        F.lit("2016-01-01").alias("issue_date_end_exclusive"),
        F.lit(36).alias("term_months"),
        F.lit(True).alias("resolved_only"),
    )
    # size and SHA-256 of every part file, kept as a table; the document has their number and total
    listed = f"{gold}/*/part-*"
    digests = file_digests(spark, listed)
    named = digests.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.element_at(F.split("path", "/"), -2).alias("folder"), "size_bytes", "sha256")
    write_columnar(named, f"{out_root}/cohort_files")
    table = read_columnar(spark, f"{out_root}/cohort_files")
    checked = quality.manifest_check(file_digests(spark, listed), table)
    require(checked.withColumn("passed", F.col("status") == "ok"), "files against the manifest", strict)
    files = table.agg(F.count("*").alias("file_count"), F.sum("size_bytes").alias("total_bytes"))
    manifest = _one_row_join(quality.cohort_profile(cohort).withColumn("cohort_definition", definition), files)
    write_document(with_generated_at(manifest.withColumn("file_table", F.lit("cohort_files"))), f"{gold}/manifest.json")
    return gold


def claims_job(spark: SparkSession, typed_path: str, gold: str, out_root: str, strict: bool = True) -> DataFrame:
    typed = read_columnar(spark, typed_path)
    metrics = claims.scope_metrics(typed)
    write_columnar(metrics.coalesce(1), f"{out_root}/claims/scope_metrics")
    metrics = read_columnar(spark, f"{out_root}/claims/scope_metrics")
    if strict:
        claims.assert_scopes_ok(metrics)
    governed = read_columnar(spark, f"{gold}/governed_metrics")
    reconciled = claims.scope_reconcile(metrics, governed)
    write_extract(reconciled, f"{out_root}/claims/reconcile", single_file=True)
    require(reconciled, "scope rules", strict)
    statuses = claims.claim_status(metrics)
    write_extract(statuses, f"{out_root}/claims/claim_status", single_file=True)
    verdict = claims.claim_verdict(statuses)
    write_extract(verdict, f"{out_root}/claims/verdict", single_file=True)
    return verdict


def vintage_job(spark: SparkSession, gold: str, out_root: str) -> None:
    cohort = read_columnar(spark, f"{gold}/analysis_cohort")
    base = f"{out_root}/vintage"
    write_extract(stats.with_p_values(stats.hypothesis_battery(cohort)), f"{base}/hypothesis_tests", single_file=True)
    write_extract(stats.mix_rate_decomposition(cohort), f"{base}/decomposition", single_file=True)
    comparison = stats.grade_period_comparison(cohort)
    write_extract(comparison, f"{base}/grade_period_comparison", single_file=True)
    write_extract(stats.price_vs_risk(comparison), f"{base}/price_vs_risk", single_file=True)
    write_extract(stats.band_shift(cohort), f"{base}/dti_band_shift", single_file=True)
    write_extract(stats.quarter_trend(cohort), f"{base}/quarterly_trend", single_file=True)
    write_extract(vintage_logit(cohort), f"{base}/logit_vintage_effect", single_file=True)


def run_all(spark: SparkSession, raw: DataFrame, out_root: str, strict: bool = True) -> dict[str, str]:
    """All layers in dependency order; returns the written locations.

    ``strict`` stops the build with ``CheckFailed`` (or the scope's error) at
    the first layer whose checks fail; otherwise the check tables alone tell.
    """
    raw_profile_job(raw, out_root)
    return run_layers(spark, raw, out_root, strict)


def run_from_text(spark: SparkSession, raw_path: str, out_root: str, strict: bool = True) -> dict[str, str]:
    """The whole build from raw delimited text (e.g. a gzip CSV extract).

    1. the 16-column contract is checked on the header before any scan;
    2. the profile reads leniently (malformed records skipped);
    3. the typed build reads strictly (a malformed record fails the job);
    4. gzip and multi-line text decode in one task per file, so the consumed
       columns are landed as Parquet once, rebalanced into files of a bounded
       size; everything downstream reads the landed copy in parallel.
    """
    header = text.read_header(spark, raw_path)
    missing = text.missing_columns(header, text.REQUIRED_RAW_COLUMNS)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    raw_profile_job(text.read_text(spark, raw_path, columns=header, mode="DROPMALFORMED"), out_root)
    scan = text.read_text(spark, raw_path, columns=header, mode="FAILFAST")
    landed_path = f"{out_root}/raw/landed"
    write_columnar(scan.hint("rebalance"), landed_path)
    done = run_layers(spark, read_columnar(spark, landed_path), out_root, strict)
    return {"landed": landed_path, **done}


def run_layers(spark: SparkSession, landed: DataFrame, out_root: str, strict: bool = True) -> dict[str, str]:
    """Typed layer and everything after it from landed raw rows."""
    typed_path = typed_job(landed, out_root)
    gold = cohort_job(spark, typed_path, out_root, strict)
    claims_job(spark, typed_path, gold, out_root, strict)
    vintage_job(spark, gold, out_root)
    return {"typed": typed_path, "cohort": gold, "claims": f"{out_root}/claims", "vintage": f"{out_root}/vintage"}
