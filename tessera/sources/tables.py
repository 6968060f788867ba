"""Parquet sources: the driver tables and a payload ("bronze") builder.

Only ``spark.read.parquet`` — Catalyst prunes columns and pushes filters
into the scan, so callers just ``select``/``where`` what they need.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Id list text file: one integer per line, blank and ``#`` lines
    skipped, unique (A3).  A line that is no integer is an error when the
    ids are read; ``bad_id_lines`` lists such lines."""
    v = F.trim(F.col("value"))
    lines = _id_lines(spark, path)
    wrong = F.raise_error(F.concat(F.lit("not an integer id: "), F.col("value")))
    return lines.select(F.coalesce(v.try_cast("long"), wrong.cast("long")).alias("id")).distinct()


def bad_id_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of an id list that are no integers."""
    return _id_lines(spark, path).where(F.trim(F.col("value")).try_cast("long").isNull())


def _id_lines(spark: SparkSession, path: str) -> DataFrame:
    v = F.trim(F.col("value"))
    return spark.read.text(path).where((v != "") & ~F.col("value").startswith("#"))


def binary_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """Blob store as a table: path, modificationTime, length, content.

    ``recursive``: the files of all folders below, whatever their names (no partition columns).  The folders that
    ``path`` matches are listed by one task each, so a store of many small folders is best given as some large ones."""
    r = spark.read.format("binaryFile")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


FOLDER_FILES, FOLDERS = 1_024, 16_384  # files in a folder of a blob store, about; folders at most


def write_texts(df: DataFrame, path: str, key: str, text: str) -> dict[int, int]:
    """Blob store of a table: one file for each value of an integer key, each of its rows a line (a null is an empty one), as
    ``shard=S/key=K.txt`` or, where Spark writes, ``shard=S/key=K/part-….txt``.  Returns the number of files by shard.

    On a file system mounted everywhere (``file:``) the tasks create the files themselves: Hadoop's local file system starts a process
    (``chmod``) for each file, checksum file and folder, which takes longer than all else.  A file gets its name when it is
    whole, and a repeated attempt replaces it by one of the same lines.  Texts are shuffled only where ``_gathers`` says so."""
    spark = df.sparkSession
    gathers, rows = _gathers(df.select(key), key)
    folders = min(FOLDERS, max(2 * spark.sparkContext.defaultParallelism, -(-rows // FOLDER_FILES)))
    shard = F.pmod(F.xxhash64(key), F.lit(folders)).cast("int").alias("shard")
    dealt = df.select(shard, F.col(key), F.col(text).alias("_text"))
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri()
    if at.getScheme() == "file":
        if gathers:
            dealt = dealt.repartitionById(folders, "shard").sortWithinPartitions(key)
        lines = dealt.select("shard", F.col(key).cast("string"), F.col("_text").cast("binary"))
        files = lines.mapInArrow(_texts(at.getPath(), key), "shard int, files long").groupBy("shard").agg(F.sum("files").alias("files"))
    else:  # tasks put the files in place themselves (committer version 2), which the driver would do one by one
        dealt.repartitionById(folders, "shard").write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("shard", key).text(path)
        files = df.select(shard, key).distinct().groupBy("shard").agg(F.count(F.lit(1)).alias("files"))
    return {r.shard: r.files for r in files.collect()}


def _gathers(keys: DataFrame, key: str) -> tuple[bool, int]:
    """Whether rows must be dealt out by their key (a key has several of them, or a split more than twice a core's share),
    and the number of rows."""
    n = F.count(F.lit(1)).alias("n")
    most, rows = keys.groupBy(F.spark_partition_id()).agg(n).agg(F.max("n"), F.coalesce(F.sum("n"), F.lit(0))).first()
    uneven = rows > 0 and most * keys.sparkSession.sparkContext.defaultParallelism > 2 * rows
    return uneven or not keys.groupBy(key).agg(n).where("n > 1").isEmpty(), rows


def _texts(folder: str, key: str):
    """The task of ``write_texts``: rows of (shard, key, text), those of a key in one task and one after the other."""
    def run(batches):
        import pyarrow as pa

        files: Counter = Counter()
        rows = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True))
        for (shard, value), lines in groupby(rows, lambda r: r[:2]):
            into = f"{folder}/shard={shard}"
            if shard not in files:
                os.makedirs(into, exist_ok=True)
            new = f"{into}/.{uuid.uuid4().hex}"  # readers pass over such names
            try:
                with open(new, "wb") as f:
                    for _, _, line in lines:
                        if line.is_valid:
                            f.write(line.as_buffer())
                        f.write(b"\n")
                os.replace(new, f"{into}/{key}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}.txt")
            except BaseException:
                if os.path.exists(new):
                    os.unlink(new)
                raise
            files[shard] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(files), pa.int32()), pa.array(list(files.values()), pa.int64())], ["shard", "files"])

    return run


def write_parts(df: DataFrame, path: str, by: tuple[str, ...] = ("run_id",)) -> str:
    """Store a table by run (or kind and run): a scan of one run then reads only its folder.  Rows are
    gathered by the partition columns and a salt first, so that a run is neither thousands of small
    files nor one task."""
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(8))
    df.repartition(*by, salt).write.partitionBy(*by).parquet(path)
    return path
