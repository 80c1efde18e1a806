"""Raw extracts dropped in a folder -> typed contract layer, incrementally.

``readStream`` over the landing folder with the fixed all-text schema (no
inference), the same ``typed_contracts`` transform as the batch build, and
the Parquet file sink partitioned by ``issue_year``. The file sink's commit
log makes the output exactly-once; the checkpoint lives under the shared
``spark.checkpoint.dir`` unless a location is given, so a restarted driver
or lost executors resume where the last committed batch ended.
A malformed record or a file with another header fails the batch, as in the
batch build; nothing is dropped silently. ``available_now`` processes everything present and stops (a scheduled
batch); otherwise the query keeps running with ``processing_time``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cohortcraft.operators.typed import typed_contracts
from cohortcraft.session import checkpoint_dir


def land_raw_files(
    spark: SparkSession,
    landing_dir: str,
    columns: list[str],
    out_path: str,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    processing_time: str = "1 minute",
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    typed = typed_contracts(reader.csv(landing_dir))
    # a stable name (not Python's per-process salted hash) so a restarted driver resumes
    digest = hashlib.sha1(out_path.encode()).hexdigest()[:16]
    location = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/landing/{digest}"
    writer = (
        typed.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", location)
        .partitionBy("issue_year")
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
