"""What the engine needs from a Spark session."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Settings that change results, not only speed.  Timestamps are instants, so
#: dates must be cut in UTC; a value that does not fit its type must fail the
#: table, which is what ANSI mode does.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


class SessionError(RuntimeError):
    """The session's settings would change results."""


def _unmet(spark: SparkSession) -> dict[str, str]:
    unmet = {}
    for name, wanted in REQUIRED.items():
        found = spark.conf.get(name)
        same = found.lower() == wanted.lower()
        if name.endswith("timeZone"):
            same = found in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00")
        if not same:
            unmet[name] = found
    return unmet


def require_session(spark: SparkSession) -> None:
    """Fail early when the session's settings would change results."""
    unmet = _unmet(spark)
    if unmet:
        wanted = ", ".join(f"{k}={REQUIRED[k]} (found {v})" for k, v in unmet.items())
        raise SessionError(f"set {wanted}")


def engine_session(spark: SparkSession) -> SparkSession:
    """The session itself if it fits, else a sibling of it that does.

    The sibling shares the Spark context and the catalog, so the caller's own
    settings stay as they are.
    """
    unmet = _unmet(spark)
    if not unmet:
        return spark
    sibling = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if sibling.conf.isModifiable(name):
            sibling.conf.set(name, value)
    for name in unmet:
        sibling.conf.set(name, REQUIRED[name])
    return sibling


@contextmanager
def timestamps_with_statistics(spark: SparkSession) -> Iterator[None]:
    """Write timestamps in the parquet type that has min and max per row group.

    Spark's default type has none, so no file could be skipped by a time.
    """
    name = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder in whatever store Spark reaches it by."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def list_folders(spark: SparkSession, folder: str) -> list[str]:
    """The folders in a folder, in whatever store it is; none if it is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(path):
        return []
    return sorted(s.getPath().toString() for s in store.listStatus(path) if s.isDirectory())


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``.

    A local master may go without the setting and gets a new temporary folder;
    on a cluster a machine-local folder would lose data, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="run-", dir="/tmp")
    raise SessionError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate rows; it goes when the application ends."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder
