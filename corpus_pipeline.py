"""Corpus pipeline: five stages over ``documents``, each one of the library's operators.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``.  ``run`` writes each
stage to the shared folder as Parquet and reads it again for the next one.

1. quality rules: documents that the rules reject go;
2. line dedup: boilerplate lines go (on 5 sources; lines of over 50 words on 2),
   and documents that held nothing else;
3. SimHash near-dedup: of each group the document with the smallest id stays;
4. mixing: every document as often as the target mix takes it (0 to 2 times);
5. BPE encoding and decoding: one row per document of the mix with its ids and the hash
   of the text that they decode to.

Nulls in any column, empty and very long texts, ties, repeated rows, empty tables
and further columns have the results that the operators' docstrings define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, linededup, mixing, quality, simhash
from tessera.llm.common import stored
from tessera.llm.queries import MIX_WEIGHTS, WORD_BPE
from tessera.session import ship_package


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality.keep(docs, quality.references(docs, distinct=True))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = linededup.dedup(docs, long_sites=linededup.LONG_SITES)
    if "n_chars" in docs.columns:  # of the text as it is now
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash.one_of_each(docs, shingle=4, distance=4)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.select_documents(docs, MIX_WEIGHTS, share=1.5, repetitions=2)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return bpe.encode(docs, WORD_BPE, digest=True)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", simhash_stage),
    ("mixing sources", mixing_stage),
    ("BPE encoding and decoding", encoding_stage),
]

# SQL has no SimHash, no seeded selection by these hashes and no byte-pair merges;
# tests hold every stage against a brute-force version instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: doc_id, ids and decoded_sha256 of every document of the mix."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{k}", "zstd")
    return docs
