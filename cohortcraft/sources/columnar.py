"""Columnar and document readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_columnar(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; an explicit schema skips footer-based schema merging."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    paths = [path] if isinstance(path, str) else path
    return reader.parquet(*paths)


def read_document(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Whole-file JSON document(s) as rows (one row per document)."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
