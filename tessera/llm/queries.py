"""Registered queries of the training-data operators and their oracles.

Each query applies its operator, with its production parameters, to the whole
table; ``ORACLES`` holds DuckDB SQL where SQL can state the result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import ann, bpe, linededup, merkle, mixing, ngramjoin, ppm, quality, sharding, simhash, tokenstore, toxicity, turntrie
from tessera.llm.common import documents
from tessera.session import ship_package, work_dir

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
MIX_WEIGHTS = [5.0, 2.0, 1.0]


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), WORD_BPE)


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "token-store")
    tokenstore.write(documents(spark, sf_dir), folder, BYTE_BPE, end_id=0)
    return tokenstore.read_checksums(spark, folder)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.measure(docs, quality.references(docs, distinct=True))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir), MIX_WEIGHTS, share=1.5, repetitions=2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(documents(spark, sf_dir), sharding.even_tree(8))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=4, distance=4)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.report(documents(spark, sf_dir))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ann.search(vectors, F.pmod(vectors["vec_id"], F.lit(100)) == 0, k=10)


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 2
    return ppm.score(docs, held_out)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.near_duplicates(documents(spark, sf_dir))


def op12_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return turntrie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    altered, hit = merkle.tampered(docs)
    return merkle.manifest(docs, altered, hit)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op9_token_output": op9_token_output,
    "op10_quality": op10_quality,
    "op4_mixing": op4_mixing,
    "op5_sharding": op5_sharding,
    "op3_simhash": op3_simhash,
    "op8_line_dedup": op8_line_dedup,
    "op7_ann": op7_ann,
    "op2_lm_score": op2_lm_score,
    "op6_toxicity": op6_toxicity,
    "op11_ngram_join": op11_ngram_join,
    "op12_turn_trie": op12_turn_trie,
    "op13_merkle": op13_merkle,
}
ORACLES: dict[str, str] = {
    "op8_line_dedup": linededup.REPORT_SQL,
}
