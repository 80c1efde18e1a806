"""Writers for tables, extracts and documents, and per-file digests.

* Tables: Parquet with zstd; rows of a partition value are gathered first (and a
  hot value is split again), so files do not multiply with tasks; ``partition_by`` lets later scans prune
  (e.g. the typed layer by ``issue_year``); ``max_records_per_file`` bounds
  file size. Parquet row groups are sized in bytes (``parquet.block.size``).
* Extracts: CSV with a header; only aggregate-sized results are coalesced
  to one file, row-level extracts stay one file per task.
* Documents: one-row nested DataFrames, pretty-printed JSON (indent 2,
  non-ASCII kept, trailing newline). The single row is result-sized.
* Writes overwrite (rerun-safe); never write over a path being read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from datetime import date, datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_columnar(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    compression: str = "zstd",
    max_records_per_file: int | None = None,
    block_size_bytes: int | None = None,
) -> str:
    dealt = df.hint("rebalance", *partition_by) if partition_by else df
    writer = dealt.write.mode("overwrite").option("compression", compression)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if block_size_bytes:
        writer = writer.option("parquet.block.size", block_size_bytes)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_extract(df: DataFrame, path: str, single_file: bool = False) -> str:
    """CSV with a header. ``single_file`` is for aggregate-sized frames only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def _json_default(v):
    if isinstance(v, (date, datetime)):
        return v.isoformat()
    raise TypeError(type(v))


def _order_counts(value):
    """Maps of counts (all int values) are listed largest first, ties by key.

    Spark maps carry no entry order to Python, so distributions are ordered
    here, on the single document row.
    """
    if isinstance(value, dict):
        items = {k: _order_counts(v) for k, v in value.items()}
        if items and all(isinstance(v, int) and not isinstance(v, bool) for v in items.values()):
            return dict(sorted(items.items(), key=lambda kv: (-kv[1], str(kv[0]))))
        return items
    if isinstance(value, list):
        return [_order_counts(v) for v in value]
    return value


def document_text(doc: DataFrame) -> str:
    """Pretty JSON of a one-row document frame."""
    rows = doc.take(2)
    if len(rows) != 1:
        raise ValueError(f"a document frame must hold exactly one row, got {len(rows)}")
    body = _order_counts(rows[0].asDict(recursive=True))
    return json.dumps(body, indent=2, ensure_ascii=False, default=_json_default) + "\n"


def with_generated_at(doc: DataFrame) -> DataFrame:
    """Prepend ``generated_at_utc`` (ISO-8601, UTC) to a document row."""
    stamp = F.date_format(F.to_utc_timestamp(F.current_timestamp(), "UTC"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return doc.select(stamp.alias("generated_at_utc"), *doc.columns)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of any URI that Spark can write."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> str:
    """Write a small text to any URI; without ``overwrite`` an existing file is an error (atomic create)."""
    fs, target = file_system(spark, path)
    out = fs.create(target, overwrite)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return path


def write_document(doc: DataFrame, path: str) -> str:
    """Write a one-row document as pretty JSON to any URI (the row is tiny)."""
    return write_text(doc.sparkSession, path, document_text(doc))


DIGEST_CHUNK = 8 << 20
DIGEST_TASK_BYTES = 1 << 30


def _digest_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs as arrow_fs

    for batch in batches:
        digests = []
        for path in batch["path"]:
            uri = "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path
            store, name = arrow_fs.FileSystem.from_uri(uri)
            digest = hashlib.sha256()
            with store.open_input_stream(name) as stream:
                while chunk := stream.read(DIGEST_CHUNK):
                    digest.update(chunk)
            digests.append(digest.hexdigest())
        yield batch.assign(sha256=digests)


def file_digests(spark: SparkSession, path_glob: str | list[str], recursive: bool = False) -> DataFrame:
    """(path, size_bytes, sha256) per file; ``recursive`` takes all files below the folders.

    Files are listed by their metadata and dealt to tasks of about
    ``DIGEST_TASK_BYTES`` each; a task reads its files in chunks, so a file may
    have any size and no row holds content.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path_glob).select("path", F.col("length").alias("size_bytes"))
    size = files.agg(F.count("*").alias("n"), F.sum("size_bytes").alias("b")).first()
    tasks = max(1, min(size["n"], -(-(size["b"] or 0) // DIGEST_TASK_BYTES) * 4))
    return files.repartition(tasks, "path").mapInPandas(_digest_files, "path string, size_bytes bigint, sha256 string")
