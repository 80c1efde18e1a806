"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``.

A written table cuts lineage: a lost executor repeats at most the stage that
reads it, never an iteration before it. ``drop`` deletes a table as soon as
what was made from it is written, so an operator holds the tables it still
reads and no others.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from cohortcraft.session import checkpoint_dir

RELEASE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
"""Settings under which a job's shuffle files go when it ends, not when the driver happens to collect its garbage."""

_PLACES: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def folder(spark: SparkSession, name: str) -> str:
    """A new folder name (nothing is created) under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet (with the writer's ``options``) and read it back."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.options(**options or {}).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _PLACES[table] = path
    return table


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself where ``written`` gave it, else written."""
    return df if df in _PLACES else written(df, name)


def drop(*tables: DataFrame) -> None:
    """Delete tables that ``written`` gave; no plan that is still to run may read them."""
    for table in tables:
        session = table.sparkSession
        place = session._jvm.org.apache.hadoop.fs.Path(_PLACES.pop(table))
        place.getFileSystem(session._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings are ``values`` inside, and what they were after it."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
