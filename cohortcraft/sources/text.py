"""Delimited-text readers for the raw layer.

The raw file is read with every column as text (no inference), quoted
fields may hold doubled quotes and newlines. ``mode`` decides what happens
to malformed records: ``DROPMALFORMED`` skips them (lenient profile scan),
``FAILFAST`` raises (strict typed build), ``PERMISSIVE`` pads/truncates.
Compression is chosen from the file extension (``.gz`` etc.).

Scale note: gzip and multi-line records are not splittable, so one task
decodes each file. Land the text as Parquet right after the scan (the typed
layer does this) and prefer many input files over one large one.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BOM = "﻿"


def read_text(
    spark: SparkSession,
    path: str | list[str],
    columns: Iterable[str] | None = None,
    mode: str = "FAILFAST",
    multiline: bool = True,
) -> DataFrame:
    """All-text scan with a header. ``columns`` fixes the schema (no sampling)."""
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", mode)
        .option("enforceSchema", False)  # a file whose header has another order fails instead of shifting columns
    )
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    df = reader.csv(path)
    first = df.columns[0]
    if first.startswith(BOM):
        df = df.withColumnRenamed(first, first[len(BOM):])
    return df


def read_typed_text(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Typed CSV scan: an explicit schema when given, inference otherwise."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line, tolerant of a UTF-8 byte-order mark.

    Only the schema is resolved; no rows are scanned.
    """
    return read_text(spark, path, mode="PERMISSIVE", multiline=False).columns


def missing_columns(available: Iterable[str], required: Iterable[str]) -> list[str]:
    """Required columns absent from ``available`` (sorted)."""
    return sorted(set(required) - set(available))


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Fail fast, before any scan, when the column contract is broken."""
    missing = missing_columns(df.columns, required)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


# The raw-layer column contract (16 columns checked by a test).
REQUIRED_RAW_COLUMNS = (
    "id",
    "loan_amnt",
    "funded_amnt",
    "term",
    "int_rate",
    "grade",
    "sub_grade",
    "emp_length",
    "home_ownership",
    "annual_inc",
    "verification_status",
    "issue_d",
    "loan_status",
    "purpose",
    "addr_state",
    "dti",
)
