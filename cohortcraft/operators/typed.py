"""Raw text -> typed contract layer (the silver build), and its rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortcraft.functions.classify import LOW_GRADES, TAXONOMY, StatusTaxonomy, in_set_or_false
from cohortcraft.functions.parse import (
    blank_to_null,
    first_int_short,
    month_year,
    ordinal_years,
    percent,
    quarter_label,
    plain_number,
    row_fingerprint,
    to_double,
    to_int,
    years_between,
)

# Typed-layer column order (schema version 1.0.0).
TYPED_COLUMNS = (
    "loan_id", "record_hash", "loan_amount", "funded_amount", "term_months",
    "interest_rate_pct", "installment", "grade", "sub_grade", "is_grade_de",
    "employment_length_raw", "employment_length_years_lower_bound", "home_ownership",
    "annual_income", "verification_status", "issue_date", "issue_year", "issue_quarter",
    "loan_status", "status_group", "default_flag", "is_resolved", "is_current",
    "is_delinquent", "purpose", "state", "debt_to_income_ratio", "delinquencies_2y",
    "earliest_credit_line_date", "credit_history_years", "open_accounts", "public_records",
    "revolving_balance", "revolving_utilization_pct", "total_accounts", "initial_list_status",
    "application_type", "mortgage_accounts", "public_record_bankruptcies", "fico_range_low",
    "fico_range_high", "fico_score_avg",
)


def _parsed(raw: DataFrame) -> DataFrame:
    """Column-by-column typing of the 30 consumed raw columns."""
    return raw.select(
        blank_to_null("id").alias("loan_id"),
        to_double("loan_amnt").alias("loan_amount"),
        to_double("funded_amnt").alias("funded_amount"),
        first_int_short("term").alias("term_months"),
        percent("int_rate").alias("interest_rate_pct"),
        to_double("installment").alias("installment"),
        blank_to_null("grade").alias("grade"),
        blank_to_null("sub_grade").alias("sub_grade"),
        blank_to_null("emp_length").alias("employment_length_raw"),
        ordinal_years("emp_length").alias("employment_length_years_lower_bound"),
        blank_to_null("home_ownership").alias("home_ownership"),
        to_double("annual_inc").alias("annual_income"),
        blank_to_null("verification_status").alias("verification_status"),
        month_year("issue_d").alias("issue_date"),
        blank_to_null("loan_status").alias("loan_status"),
        blank_to_null("purpose").alias("purpose"),
        blank_to_null("addr_state").alias("state"),
        to_double("dti").alias("debt_to_income_ratio"),
        to_int("delinq_2yrs").alias("delinquencies_2y"),
        month_year("earliest_cr_line").alias("earliest_credit_line_date"),
        to_int("open_acc").alias("open_accounts"),
        to_int("pub_rec").alias("public_records"),
        to_double("revol_bal").alias("revolving_balance"),
        percent("revol_util").alias("revolving_utilization_pct"),
        to_int("total_acc").alias("total_accounts"),
        blank_to_null("initial_list_status").alias("initial_list_status"),
        blank_to_null("application_type").alias("application_type"),
        to_int("mort_acc").alias("mortgage_accounts"),
        to_int("pub_rec_bankruptcies").alias("public_record_bankruptcies"),
        to_double("fico_range_low").alias("fico_range_low"),
        to_double("fico_range_high").alias("fico_range_high"),
    )


def typed_contracts(raw: DataFrame, taxonomy: StatusTaxonomy = TAXONOMY) -> DataFrame:
    """Typed contract layer: rows with a parseable issue date and a status.

    The parse runs once; the accept filter reads the parsed columns.
    """
    p = _parsed(raw).where(F.col("issue_date").isNotNull() & F.col("loan_status").isNotNull())
    status = F.col("loan_status")
    derived = {
        "record_hash": row_fingerprint("loan_id", "issue_date", plain_number("loan_amount"), "grade", "sub_grade", "loan_status"),
        "is_grade_de": in_set_or_false("grade", LOW_GRADES),
        "issue_year": F.year("issue_date"),
        "issue_quarter": quarter_label("issue_date"),
        **taxonomy.columns(status),
        "credit_history_years": years_between("earliest_credit_line_date", "issue_date"),
        "fico_score_avg": (F.col("fico_range_low") + F.col("fico_range_high")) / 2.0,
    }
    return p.withColumns(derived).select(*TYPED_COLUMNS)


def reject_reason(raw: DataFrame) -> DataFrame:
    """Every raw row with its fate: ``accepted``, ``bad_date`` or ``blank_status``.

    A row failing both rules is reported once, as ``bad_date``.
    """
    date_ok = month_year("issue_d").isNotNull()
    status_ok = blank_to_null("loan_status").isNotNull()
    return raw.select(
        F.when(~date_ok, "bad_date").when(~status_ok, "blank_status").otherwise("accepted").alias("reason")
    )
