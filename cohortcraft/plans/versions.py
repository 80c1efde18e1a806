"""The outputs of a build as one versioned set.

A run writes all its outputs under a folder of its own, lists every file with
size and SHA-256, checks the files against that list and then publishes the
folder by creating one numbered pointer file. Creating a file that is there
fails, so of concurrent publishers each gets its own number; the highest number
is the current set. A build that stops midway publishes nothing. Published
folders are never written again: readers that opened an older set keep it until
``retire`` removes it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortcraft.operators import quality
from cohortcraft.plans import jobs
from cohortcraft.sources.columnar import read_columnar
from cohortcraft.sources.sinks import file_digests, file_system, write_columnar, write_text

MANIFEST = "manifest"


class NothingPublished(LookupError):
    """No set has been published under the root yet."""


def _pointers(root: str) -> str:
    return f"{root.rstrip('/')}/published"


def published(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(number, folder) of every published set, oldest first."""
    fs, place = file_system(spark, _pointers(root))
    if not fs.exists(place):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(place) if not s.getPath().getName().startswith((".", "_")))
    out = []
    for name in names:
        stream = fs.open(file_system(spark, f"{_pointers(root)}/{name}")[1])
        try:
            text = bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()
        if text:  # an empty pointer is one whose writer stopped between creating and filling it
            out.append((int(name), text))
    return out


def current(spark: SparkSession, root: str) -> str:
    """Folder of the set published last."""
    found = published(spark, root)
    if not found:
        raise NothingPublished(root)
    return found[-1][1]


def _inside(folder: str):
    """A file's path below the run's folder, whose last part is unique."""
    return F.element_at(F.split("path", f"/{folder.rstrip('/').rsplit('/', 1)[-1]}/"), -1)


def files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size_bytes, sha256) of a run's files at any depth, without the manifest."""
    return file_digests(spark, folder, recursive=True).where(~_inside(folder).startswith(f"{MANIFEST}/"))


def publish(spark: SparkSession, root: str, folder: str) -> int:
    """Check the folder's files against its manifest and create the next pointer; returns its number."""
    stored = read_columnar(spark, f"{folder}/{MANIFEST}")
    checked = quality.manifest_check(files(spark, folder), stored, _inside(folder))
    jobs.require(checked.withColumn("passed", F.col("status") == "ok"), "files against the manifest")
    number = max((n for n, _ in published(spark, root)), default=0)
    while True:
        number += 1
        try:
            write_text(spark, f"{_pointers(root)}/{number:012d}", folder, overwrite=False)
            return number
        except Py4JJavaError:
            fs, place = file_system(spark, f"{_pointers(root)}/{number:012d}")
            if not fs.exists(place):  # another failure than a number that is taken
                raise


def run_versioned(spark: SparkSession, raw: DataFrame, root: str, build: Callable[..., dict] | None = None) -> str:
    """Build every output in a new folder and publish it; returns the folder."""
    folder = f"{root.rstrip('/')}/runs/{uuid.uuid4().hex}"
    (build or jobs.run_all)(spark, raw, folder)
    listed = files(spark, folder).select(_inside(folder).alias("file"), "size_bytes", "sha256")
    write_columnar(listed, f"{folder}/{MANIFEST}")
    publish(spark, root, folder)
    return folder


def retire(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Remove all but the ``keep`` newest sets, pointer first; returns the removed folders."""
    if keep < 1:
        raise ValueError("the current set stays")
    gone = []
    for number, folder in published(spark, root)[:-keep]:
        for path in (f"{_pointers(root)}/{number:012d}", folder):
            fs, place = file_system(spark, path)
            fs.delete(place, True)
        gone.append(folder)
    return gone
