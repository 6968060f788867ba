"""Ids beyond 2^53 beside null ones, through every stage that runs in Python (or once did):
search (both paths), trees, texts, encoding, pairing, routing.

Where a result holds null ids its ids are shown as text, because a reader that
takes it to pandas would round them for the same reason."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import embed as E
from tessera.operators import evaluate as EV
from tessera.operators import extract as X
from tessera.operators import hierarchy as H
from tessera.operators.search import knn
from tessera.plans import fragments as Q
from tessera.plans.embed_eval_plans import HASH_SQL, _summary
from tessera.plans.hierarchy_plans import TREE_ELEMENTS_SQL
from tessera.plans.registry import register
from tessera.sources import standins
from tessera.sources.tables import table

K = 5
BASE = 1 << 60
LOST = 3  # the remainder (modulo 7) of the values whose rows have lost their id


def large(key: F.Column, value: F.Column) -> F.Column:
    """An odd id above 2^60, null where ``value`` says so."""
    return F.when(F.pmod(value, F.lit(7)) != LOST, F.lit(BASE) + key * 2 + 1)


def large_sql(key: str, value: str) -> str:
    return f"CASE WHEN {value} % 7 <> {LOST} THEN {BASE} + CAST({key} AS BIGINT) * 2 + 1 END"


KNN_SQL = f"""
WITH v AS (SELECT {large_sql('vec_id', 'label')} AS id, embedding::DOUBLE[] AS v FROM embeddings),
q AS (SELECT {large_sql('min(vec_id)', '(label + 1)')} AS query_id, arg_min(embedding, vec_id)::DOUBLE[] AS v FROM embeddings GROUP BY label),
d AS (SELECT q.query_id, v.id, {Q.dist('l2', 'q.v', 'v.v')} AS distance FROM q, v WHERE q.query_id IS NOT NULL AND v.id IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM d)
SELECT query_id, id, CAST(rank AS BIGINT) AS rank, round(distance, 6) AS distance FROM r WHERE rank <= {K}"""


def _knn(spark, sf_dir, strategy) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    vectors = e.select(large(F.col("vec_id"), F.col("label")).alias("id"), F.col("embedding").alias("vector"))
    firsts = e.groupBy("label").agg(F.min("vec_id").alias("first"), F.min_by("embedding", "vec_id").alias("query_vector"))
    queries = firsts.select(large(F.col("first"), F.col("label") + 1).alias("query_id"), "query_vector")
    return knn(queries, vectors, K, "l2", strategy=strategy)


@register("knn_large_ids_broadcast", KNN_SQL)
def knn_large_ids_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan path: rows without an id are no hits, the other ids come back as they are."""
    return _knn(spark, sf_dir, "broadcast")


@register("knn_large_ids_blocked", KNN_SQL)
def knn_large_ids_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Co-grouped path on the same rows."""
    return _knn(spark, sf_dir, "blocked")


def _trees(spark, sf_dir) -> DataFrame:
    key = F.col("screen_id")
    return standins.tree(spark, sf_dir).select(large(key, key).alias("screen_id"), "hierarchy_json")


@register("tree_large_ids", f"""
WITH {TREE_ELEMENTS_SQL}
SELECT CAST({large_sql('screen_id', 'screen_id')} AS VARCHAR) AS screen_id, pos, element_type, text, y1 FROM elements""")
def tree_large_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements of trees; those of a tree without an id stay, without one."""
    return H.elements(_trees(spark, sf_dir)).select(F.col("screen_id").cast("string").alias("screen_id"), "pos", "element_type", "text", "y1")


@register("tree_text_large_ids", f"""
WITH {TREE_ELEMENTS_SQL}
SELECT CAST({large_sql('screen_id', 'screen_id')} AS VARCHAR) AS screen_id, count(*) FILTER (WHERE text <> '') AS n_elements,
       coalesce(string_agg(text, ' ' ORDER BY y1, x1, pos) FILTER (WHERE text <> ''), '') AS text_rep
FROM elements GROUP BY elements.screen_id""")
def tree_text_large_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading-order texts of the same trees."""
    return H.screen_texts(_trees(spark, sf_dir)).select(F.col("screen_id").cast("string").alias("screen_id"), "n_elements", "text_rep")


@register("embed_large_ids", f"""
WITH {HASH_SQL.format(key='doc_id', text='text', table='documents')}
SELECT CAST({large_sql('d.doc_id', 'd.n_chars')} AS VARCHAR) AS doc_id, CAST(384 AS BIGINT) AS dims, count(x.bucket) AS nnz,
       round(coalesce(sum(x.x::DOUBLE * (x.bucket + 1)), 0.0), 6) AS checksum
FROM documents d LEFT JOIN x ON x.id = d.doc_id GROUP BY d.doc_id, d.n_chars""")
def embed_large_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plugged-in encoder (of token lists) keeps every key beside its vector."""
    docs = table(spark, sf_dir, "documents")
    keyed = docs.select(large(F.col("doc_id"), F.col("n_chars")).alias("doc_id"), E.tokens(F.col("text")).alias("tokens"))

    def make():
        return E.Buckets(E.TEXT_DIMS).counted

    return E.embed_with(keyed, "tokens", make, key="doc_id").select(F.col("doc_id").cast("string").alias("doc_id"), *_summary(F.col("vector")))


@register("pairs_large_ids", f"""
WITH k AS (SELECT DISTINCT {large_sql('doc_id', 'n_chars')} AS id FROM documents)
SELECT id, coalesce(lead(id) OVER (ORDER BY id), min(id) OVER ()) AS next_id FROM k WHERE id IS NOT NULL""")
def pairs_large_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each id and the next one in order; rows without an id have none."""
    docs = table(spark, sf_dir, "documents")
    return EV.next_in_order(docs.select(large(F.col("doc_id"), F.col("n_chars")).alias("id")), "id")


@register("extract_large_ids", f"""
WITH {Q.RESP}, {Q.ROUTED}
SELECT CAST({large_sql('screen_id', 'screen_id')} AS VARCHAR) AS screen_id, run_id, route, CASE WHEN route = 'valid' THEN conf END AS confidence, source_fingerprint FROM routed""")
def extract_large_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routing carries ids of any size, and rows without one."""
    key = F.col("screen_id")
    rows = standins.resp(spark, sf_dir).withColumn("screen_id", large(key, key))
    return X.classify(rows).select(F.col("screen_id").cast("string").alias("screen_id"), "run_id", "route", "confidence", "source_fingerprint")
