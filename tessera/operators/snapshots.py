"""Versioned tables on plain files: a log of versions, optimistic commits,
readers that pin a version.

``<base>/data/<version>-<writer>`` holds a version's rows, ``<base>/_log/<version>``
names that folder.  A log entry is created only if it does not exist, which the
file system decides, so of two writers that started from one version exactly one
commits; the other gets ``SnapshotConflict`` and may start again (``change``).  An
entry counts once its line is complete.  A reader keeps the version it opened:
files of a version are never changed.  (An object store has to offer creation
without overwriting, as HDFS and local file systems do.)
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class SnapshotConflict(RuntimeError):
    """Another writer has committed the version that this one prepared."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _entry(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/_log/{version:012d}"


def _folder(spark: SparkSession, base: str, version: int) -> str | None:
    """The data folder of a version, None if it is not committed."""
    fs, p = _fs(spark, _entry(base, version))
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        line = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return f"{base.rstrip('/')}/data/{line[:-1]}" if line.endswith("\n") else None


def current(spark: SparkSession, base: str) -> int:
    """The newest committed version, 0 for a table without any."""
    fs, p = _fs(spark, f"{base.rstrip('/')}/_log")
    if not fs.exists(p):
        return 0
    found = sorted((int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit()), reverse=True)
    return next((v for v in found if _folder(spark, base, v)), 0)


def read(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The rows of a version (the newest by default)."""
    version = current(spark, base) if version is None else version
    folder = _folder(spark, base, version) if version else None
    if folder is None:
        raise LookupError(f"no version {version} of {base}")
    return spark.read.parquet(folder)


def commit(df: DataFrame, base: str, expected: int, partition_by: tuple[str, ...] = ()) -> int:
    """Write ``df`` as the version after ``expected``; raises ``SnapshotConflict`` if that is taken."""
    spark, version = df.sparkSession, expected + 1
    name = f"{version:012d}-{uuid.uuid4().hex[:12]}"
    folder = f"{base.rstrip('/')}/data/{name}"
    df.write.partitionBy(*partition_by).parquet(folder)
    fs, p = _fs(spark, _entry(base, version))
    try:
        stream = fs.create(p, False)
    except Py4JJavaError as exc:
        if "AlreadyExists" not in exc.java_exception.getClass().getName() and not fs.exists(p):
            raise
        data_fs, data = _fs(spark, folder)
        data_fs.delete(data, True)  # rows that no version names
        raise SnapshotConflict(f"version {version} of {base} was committed by another writer") from None
    stream.write(bytearray(f"{name}\n".encode()))
    stream.close()
    return version


def change(spark: SparkSession, base: str, how: Callable[[DataFrame], DataFrame], attempts: int = 5, partition_by: tuple[str, ...] = ()) -> int:
    """Commit ``how(newest rows)``, starting again from the newer version after a conflict."""
    for last in range(attempts - 1, -1, -1):
        version = current(spark, base)
        try:
            return commit(how(read(spark, base, version)), base, version, partition_by)
        except SnapshotConflict:
            if not last:
                raise
    raise ValueError("attempts must be positive")
