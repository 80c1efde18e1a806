"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults every job relies on: UTC dates, adaptive execution (runtime
# coalescing, skew-join splitting, broadcast conversion from real sizes).
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "cohortcraft",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; the
    caller's ``conf`` wins over the defaults.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is used as is (and
    must be set). Only in local mode, when it is unset (tests), a private
    folder is created and set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        # a machine-local folder would be a different folder on every executor
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. HDFS or object storage) on a cluster")
    local = tempfile.mkdtemp(prefix="cohortcraft-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    try:
        spark.conf.set("spark.checkpoint.dir", local)
    except Exception:  # a static setting on some deployments; the context still knows it
        pass
    spark.sparkContext.setCheckpointDir(local)
    return local
