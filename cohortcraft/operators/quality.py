"""Profiles, rule counters and cross-layer reconciliation.

Rules are (name, predicate) pairs evaluated as ``count_if`` in one
aggregate pass; a rule's count is the number of violating rows. Profiles
that need a distinct count let Catalyst expand the aggregate (one extra
shuffle on the id), everything else is map-side combined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortcraft.functions.classify import GRADE_DOMAIN
from cohortcraft.functions.metrics import n_rows, n_where
from cohortcraft.functions.parse import blank_to_null, month_year
from cohortcraft.operators.typed import reject_reason
from cohortcraft.functions.metrics import round_to

NULL_STATUS = "__NULL__"


@dataclass(frozen=True)
class Rule:
    """A named predicate that flags *violating* rows; ``expected`` violations."""

    name: str
    predicate: Column
    expected: int | None = 0


def typed_rules() -> list[Rule]:
    """Counters of the typed-layer quality profile."""
    c = F.col
    return [
        Rule("invalid_loan_amounts", c("loan_amount").isNull() | (c("loan_amount") <= 0)),
        Rule(
            "invalid_interest_rates",
            c("interest_rate_pct").isNull() | (c("interest_rate_pct") < 0) | (c("interest_rate_pct") > 100),
            None,
        ),
        Rule("invalid_terms", ~c("term_months").isin(36, 60) | c("term_months").isNull()),
        Rule("invalid_grades", ~c("grade").isin(*GRADE_DOMAIN) | c("grade").isNull()),
        Rule("unknown_statuses", c("status_group") == "unknown", None),
        Rule("resolved_rows", c("default_flag").isNotNull(), None),
        Rule("defaulted_rows", c("default_flag") == 1, None),
        Rule("missing_annual_income", c("annual_income").isNull(), None),
        Rule("missing_dti", c("debt_to_income_ratio").isNull(), None),
        Rule("missing_fico", c("fico_score_avg").isNull(), None),
    ]


def cohort_rules(start: str = "2014-01-01", end: str = "2016-01-01", term: int = 36) -> list[Rule]:
    """Counters of the cohort manifest and the cohort domain rules."""
    c = F.col
    return [
        Rule("missing_default_flags", c("default_flag").isNull()),
        Rule("invalid_default_flags", ~c("default_flag").isin(0, 1)),
        Rule("missing_loan_amounts", c("loan_amount").isNull(), None),
        Rule("missing_grades", c("grade").isNull(), None),
        Rule("missing_purposes", c("purpose").isNull(), None),
        Rule("wrong_term", (c("term_months") != term) | c("term_months").isNull()),
        Rule(
            "outside_window",
            (c("issue_date") < F.lit(start).cast("date")) | (c("issue_date") >= F.lit(end).cast("date")),
        ),
        Rule(
            "outcome_flag_mismatch",
            ((c("default_flag") == 1) & (c("outcome") != "Defaulted"))
            | ((c("default_flag") == 0) & (c("outcome") != "Fully paid")),
        ),
    ]


def rule_counts(df: DataFrame, rules: list[Rule]) -> list[Column]:
    return [n_where(r.predicate).alias(r.name) for r in rules]


def typed_profile(typed: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """One-row quality profile of the typed layer.

    The exact distinct id count shuffles every distinct id once;
    ``exact_distinct=False`` uses a HyperLogLog++ sketch (about 1 % error).
    """
    distinct = F.count_distinct("loan_id") if exact_distinct else F.approx_count_distinct("loan_id", 0.01)
    return typed.agg(
        n_rows().alias("row_count"),
        distinct.alias("distinct_non_null_loan_ids"),
        n_where(F.col("loan_id").isNull()).alias("missing_loan_ids"),
        F.min("issue_date").alias("first_issue_date"),
        F.max("issue_date").alias("last_issue_date"),
        *rule_counts(typed, typed_rules()),
    )


def cohort_profile(cohort: DataFrame) -> DataFrame:
    """One-row cohort manifest profile plus cohort domain rules."""
    return cohort.agg(
        n_rows().alias("row_count"),
        F.count_distinct("loan_id").alias("distinct_loan_ids"),
        F.min("issue_date").alias("first_issue_date"),
        F.max("issue_date").alias("last_issue_date"),
        *rule_counts(cohort, cohort_rules()),
    )


def rule_report(profile: DataFrame, rules: list[Rule]) -> DataFrame:
    """Long form of a one-row profile: (rule, violations, expected, passed)."""
    checked = [r for r in rules if r.expected is not None]
    stacked = profile.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(r.name).alias("rule"), F.col(r.name).cast("long").alias("violations"),
                             F.lit(r.expected).cast("long").alias("expected"))
                    for r in checked
                ]
            )
        ).alias("r")
    ).select("r.*")
    return stacked.withColumn("passed", F.col("violations") == F.col("expected"))


def raw_status(raw: DataFrame, status_col: str = "loan_status") -> Column:
    return F.coalesce(blank_to_null(status_col), F.lit(NULL_STATUS))


def raw_profile(raw: DataFrame, status_col: str = "loan_status", date_col: str = "issue_d") -> DataFrame:
    """Raw-layer profile in one aggregation pass.

    One row per raw status (blank -> ``__NULL__``) with its count, plus the
    table totals (rows, date range, distinct statuses) computed by windows
    over those few aggregated rows.
    """
    per_status = raw.groupBy(raw_status(raw, status_col).alias("loan_status")).agg(
        n_rows().alias("loans"),
        F.min(month_year(date_col)).alias("_first"),
        F.max(month_year(date_col)).alias("_last"),
    )
    everything = Window.partitionBy()
    return per_status.select(
        "loan_status",
        "loans",
        F.sum("loans").over(everything).cast("long").alias("row_count"),
        F.min("_first").over(everything).alias("first_issue_date"),
        F.max("_last").over(everything).alias("last_issue_date"),
        F.count(F.lit(1)).over(everything).alias("distinct_loan_statuses"),
    )


def status_distribution(df: DataFrame, key: str = "status_group") -> DataFrame:
    """(key, loans) by count descending, ties broken by the key."""
    return df.groupBy(key).agg(n_rows().alias("loans")).orderBy(F.desc("loans"), F.asc_nulls_last(key))


def distribution_map(dist: DataFrame, key: str, count: str = "loans") -> DataFrame:
    """A (key, count) table folded into one ``map<key, count>`` row.

    Only for distributions of a bounded key (statuses, groups).
    """
    return dist.agg(
        F.map_from_entries(F.collect_list(F.struct(F.coalesce(F.col(key), F.lit(NULL_STATUS)), F.col(count))))
        .alias("distribution")
    )


def distribution_reconcile(raw: DataFrame, typed: DataFrame) -> DataFrame:
    """Raw status counts against typed status counts, per status.

    Rows present only in the raw layer are the rejects (blank status,
    unparseable dates); ``difference = raw_loans - typed_loans``.
    """
    r = raw.groupBy(raw_status(raw).alias("loan_status")).agg(n_rows().alias("raw_loans"))
    t = typed.groupBy("loan_status").agg(n_rows().alias("typed_loans"))
    j = r.join(t, "loan_status", "full_outer")
    return j.select(
        "loan_status",
        F.coalesce("raw_loans", F.lit(0)).alias("raw_loans"),
        F.coalesce("typed_loans", F.lit(0)).alias("typed_loans"),
        (F.coalesce("raw_loans", F.lit(0)) - F.coalesce("typed_loans", F.lit(0))).alias("difference"),
    )


def layer_reconcile(raw: DataFrame, typed: DataFrame) -> DataFrame:
    """Rows per layer and rejects per reason, with the balance (must be 0).

    Long form (measure, rows): raw, typed, each reject reason that occurs,
    and ``unexplained = raw - typed - rejects``. One conditional aggregate
    per layer; the two one-row results are combined on a constant key.
    """
    reason = reject_reason(raw).select("reason")
    r = reason.agg(
        n_rows().alias("raw"),
        n_where(F.col("reason") == "bad_date").alias("rejected_bad_date"),
        n_where(F.col("reason") == "blank_status").alias("rejected_blank_status"),
    )
    t = typed.agg(n_rows().alias("typed"))
    both = r.withColumn("_one", F.lit(1)).join(t.withColumn("_one", F.lit(1)), "_one").drop("_one")
    unexplained = F.col("raw") - F.col("typed") - F.col("rejected_bad_date") - F.col("rejected_blank_status")
    rows = F.array(
        F.struct(F.lit("raw").alias("measure"), F.col("raw").alias("rows")),
        F.struct(F.lit("typed").alias("measure"), F.col("typed").alias("rows")),
        F.struct(F.lit("rejected_bad_date").alias("measure"), F.col("rejected_bad_date").alias("rows")),
        F.struct(F.lit("rejected_blank_status").alias("measure"), F.col("rejected_blank_status").alias("rows")),
        F.struct(F.lit("unexplained").alias("measure"), unexplained.alias("rows")),
    )
    out = both.select(F.explode(rows).alias("x")).select("x.measure", F.col("x.rows").cast("long").alias("rows"))
    # a reason with no rejected rows is not reported (as a grouped count would not)
    return out.where(~F.col("measure").startswith("rejected_") | (F.col("rows") > 0))


def maturity(typed: DataFrame) -> DataFrame:
    """Resolved share by origination year and term (why the cohort is mature)."""
    return typed.groupBy("issue_year", "term_months").agg(
        n_rows().alias("loans"),
        n_where(F.col("is_resolved")).alias("resolved_loans"),
        round_to(F.lit(100.0) * F.avg(F.col("is_resolved").cast("double")), 4).alias("resolved_share_pct"),
    )


def table_fingerprint(df: DataFrame, hash_col: str = "record_hash") -> DataFrame:
    """Order-independent content digest: row count, XOR and sum of both 64-bit halves of each hash."""
    halves = {"high": F.substring(F.col(hash_col), 1, 16), "low": F.substring(F.col(hash_col), 17, 16)}
    xor = lambda h: F.lpad(F.lower(F.hex(F.bit_xor(F.conv(h, 16, -10).cast("long")))), 16, "0")
    return df.agg(
        n_rows().alias("rows"),
        *(xor(h).alias(f"xor_{k}") for k, h in halves.items()),
        *(F.sum(F.conv(h, 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)").alias(f"sum_{k}") for k, h in halves.items()),
    )


def schema_rows(df: DataFrame) -> list[tuple[str, str, bool]]:
    """(name, type, nullable) per column; a metadata read, no job runs."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]


def key_and_domain(df: DataFrame, key: str = "loan_id", flag: str = "default_flag",
                   domain: tuple[int, ...] = (0, 1)) -> DataFrame:
    """Uniqueness of the key and the flag's domain, as counts and a verdict.

    ``duplicate_keys = rows - distinct keys`` (NULL keys count as rows);
    ``out_of_domain`` counts flags outside ``domain`` including NULL.
    """
    counts = df.agg(
        n_rows().alias("rows"),
        F.count_distinct(key).alias("distinct_keys"),
        n_where(~F.col(flag).isin(*domain) | F.col(flag).isNull()).alias("out_of_domain"),
    )
    return counts.select(
        "rows", "distinct_keys",
        (F.col("rows") - F.col("distinct_keys")).alias("duplicate_keys"),
        "out_of_domain",
        ((F.col("rows") == F.col("distinct_keys")) & (F.col("out_of_domain") == 0)).alias("passed"),
    )


def manifest_check(digests: DataFrame, manifest: DataFrame, name: Column | None = None) -> DataFrame:
    """Files on disk against a manifest (file, size_bytes, sha256).

    ``name`` gives a file's name in the manifest from its ``path`` (default: its
    last part). Full outer join on the file name (both sides are file lists): reports
    missing files, unexpected files, size and digest mismatches.
    """
    on_disk = digests.select(
        (F.element_at(F.split("path", "/"), -1) if name is None else name).alias("file"),
        F.col("size_bytes").alias("disk_size"),
        F.col("sha256").alias("disk_sha256"),
    )
    j = manifest.join(on_disk, "file", "full_outer")
    return j.select(
        "file",
        F.when(F.col("disk_size").isNull(), "missing")
        .when(F.col("size_bytes").isNull(), "unexpected")
        .when(F.col("size_bytes") != F.col("disk_size"), "size_mismatch")
        .when(F.col("sha256") != F.col("disk_sha256"), "digest_mismatch")
        .otherwise("ok")
        .alias("status"),
    )


def compare_metrics(actual: DataFrame, expected: DataFrame, tolerances: dict[str, float],
                    default_tolerance: float = 0.0) -> DataFrame:
    """Align two one-row metric frames by metric name and apply tolerances.

    Long form (metric, actual, expected, tolerance, passed); a metric present
    on one side only fails. Both inputs are one row, so the unpivoted sides
    hold one row per metric.
    """
    def long(df: DataFrame, name: str) -> DataFrame:
        cols = [c for c, t in df.dtypes if t in ("double", "float", "int", "bigint", "smallint", "decimal")
                or t.startswith("decimal")]
        return df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias(name)) for c in cols
        ])).alias("m")).select("m.*")

    tol = F.coalesce(
        F.element_at(F.create_map(*[x for k, v in tolerances.items() for x in (F.lit(k), F.lit(float(v)))]),
                     F.col("metric")) if tolerances else F.lit(None).cast("double"),
        F.lit(float(default_tolerance)),
    )
    j = long(actual, "actual").join(long(expected, "expected"), "metric", "full_outer")
    return j.select(
        "metric", "actual", "expected", tol.alias("tolerance"),
        F.coalesce(F.abs(F.col("actual") - F.col("expected")) <= tol, F.lit(False)).alias("passed"),
    )
