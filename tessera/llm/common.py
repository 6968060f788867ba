"""Shared helpers of the training-data operators."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ship_package, work_dir

# a word is a run of bytes other than ASCII white space; ``bytes.split()``
# without arguments cuts at exactly these six bytes
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(rb"[^\x20\x09-\x0d]+")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table, with this package importable in Python workers."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def utf8(column: pa.Array) -> list[bytes]:
    """Texts of one Arrow column as bytes; null becomes empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def stored(df: DataFrame, name: str, compression: str = "lz4_raw") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage so that later jobs, and tasks repeated after a lost
    executor, read files instead of computing the stage again."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text) -> F.Column:
    """Number of words of a text column (null: 0), without a Python stage."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sample_by_hash(df: DataFrame, key: str, n: int) -> DataFrame:
    """A bounded sample to fit a model on: about ``n`` rows, those with the smallest hashes of
    ``key``, and never more than 2 ``n`` (all rows, if there are no more than ``n``).

    A threshold on the hash, not a sort: each task passes on its few rows only."""
    total = df.count()
    if total <= n:
        return df
    return df.where(F.shiftrightunsigned(F.xxhash64(key), 1) < F.lit(int(n / total * (1 << 63)))).limit(2 * n)


def whole_rows(docs: DataFrame) -> DataFrame:
    """``docs`` as one struct column ``row``: columns of any name travel along without meeting an operator's own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def docs_column(row: str, name: str) -> F.Column:
    """A column of the rows in ``row``."""
    return F.col(row).getField(name)
