"""Makes this package importable in Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per application (Spark's own file distribution)."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix=f"{package.name}-")) / f"{package.name}_sources.zip"
    with zipfile.ZipFile(target, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent).as_posix())
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)
