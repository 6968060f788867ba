"""Vector search queries: single/centroid search per metric, batch kNN,
retriever comparison, both modalities in one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.pruned import PruneLimits, knn_pruned
from tessera.operators.search import knn, reciprocal_rank_fusion, search, top1_side_by_side
from tessera.plans import fragments as Q
from tessera.plans.registry import register
from tessera.sources import standins
from tessera.sources.tables import table

K = 5


def vectors_of(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return (standins.emb(spark, sf_dir).where(F.col("embedding_kind") == kind)
            .select("screen_id", "vector"))


def label_centroids(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """One query per label: the mean vector of that label's rows.

    posexplode → (label, pos) partial/final avg → one bounded collect per
    label (its size is the dimension, not the row count)."""
    e = table(spark, sf_dir, "embeddings").select("label", "embedding")
    vec = F.col("embedding") if kind == "text" else standins.image_vector()
    parts = e.select("label", F.posexplode(vec).alias("pos", "x"))
    means = parts.groupBy("label", "pos").agg(F.avg("x").alias("x"))
    return (means.groupBy("label")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("s"))
            .select(F.col("label").cast("long").alias("query_id"),
                    F.transform("s", lambda t: t["x"]).alias("query_vector")))


def _search_with_meta(spark, sf_dir, kind, metric):
    meta = standins.meta(spark, sf_dir).select("screen_id", "app_package", "category")
    hits = search(label_centroids(spark, sf_dir, kind), vectors_of(spark, sf_dir, kind), K, metric, metadata=meta)
    return hits.select("query_id", "rank", "screen_id", "distance", "app_package", "category")


def _oracle_search_with_meta(kind: str, metric: str) -> str:
    return f"""
WITH {Q.centroids(kind)}, {Q.META}, {Q.EMB},
v AS (SELECT screen_id, vector FROM emb WHERE embedding_kind = '{kind}'
      AND screen_id IN (SELECT screen_id FROM meta)),
d AS (SELECT cent.query_id, v.screen_id, {Q.dist(metric, 'cent.qv', 'v.vector::DOUBLE[]')} AS distance
      FROM cent, v),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, screen_id) AS rank FROM d)
SELECT r.query_id, CAST(r.rank AS BIGINT) AS rank, r.screen_id, round(r.distance, 6) AS distance, meta.app_package, meta.category
FROM r JOIN meta USING (screen_id) WHERE r.rank <= {K}"""


@register("vector_search_cosine", _oracle_search_with_meta("text", "cosine"))
def vector_search_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text-space search (cosine), top-5 per label centroid, joined to metadata."""
    return _search_with_meta(spark, sf_dir, "text", "cosine")


@register("vector_search_l2", _oracle_search_with_meta("image", "l2"))
def vector_search_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image-space search (Euclidean), top-5 per label centroid, joined to metadata."""
    return _search_with_meta(spark, sf_dir, "image", "l2")


@register("vector_search_ip", f"""
WITH {Q.centroids('text')}, {Q.EMB},
d AS (SELECT cent.query_id, e.screen_id, {Q.dist('ip', 'cent.qv', 'e.vector::DOUBLE[]')} AS distance
      FROM cent, emb e WHERE e.embedding_kind = 'text'),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, screen_id) AS rank FROM d)
SELECT query_id, CAST(rank AS BIGINT) AS rank, screen_id, round(distance, 6) AS distance FROM r WHERE rank <= {K}""")
def vector_search_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negative inner product search over the whole text table."""
    hits = knn(label_centroids(spark, sf_dir, "text"), vectors_of(spark, sf_dir, "text"), K, "ip",
               vec_id="screen_id")
    return hits.select("query_id", "rank", F.col("id").alias("screen_id"), "distance")


@register("knn_batch", f"""
WITH {Q.EMB},
t AS (SELECT screen_id, vector::DOUBLE[] AS v FROM emb WHERE embedding_kind = 'text'),
d AS (SELECT q.screen_id AS query_id, t.screen_id, {Q.dist('cosine', 'q.v', 't.v')} AS distance FROM t q, t),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, screen_id) AS rank FROM d)
SELECT query_id, CAST(rank AS BIGINT) AS rank, screen_id, round(distance, 6) AS distance FROM r WHERE rank <= {K}""")
def knn_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text vector queries the whole text table (cosine, k = 5)."""
    v = vectors_of(spark, sf_dir, "text")
    qs = v.select(F.col("screen_id").alias("query_id"), F.col("vector").alias("query_vector"))
    hits = knn(qs, v, K, "cosine", vec_id="screen_id")
    return hits.select("query_id", "rank", F.col("id").alias("screen_id"), "distance")


@register("knn_pruned", f"""
WITH {Q.EMB},
t AS (SELECT screen_id, vector::DOUBLE[] AS v FROM emb WHERE embedding_kind = 'text'),
d AS (SELECT q.screen_id AS query_id, t.screen_id, {Q.dist('cosine', 'q.v', 't.v')} AS distance FROM t q, t),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, screen_id) AS rank FROM d)
SELECT query_id, CAST(rank AS BIGINT) AS rank, screen_id, round(distance, 6) AS distance FROM r WHERE rank <= {K}""")
def knn_pruned_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as ``knn_batch`` by blocks that pivot bounds may skip."""
    v = vectors_of(spark, sf_dir, "text")
    qs = v.select(F.col("screen_id").alias("query_id"), F.col("vector").alias("query_vector"))
    hits, _ = knn_pruned(qs, v, K, "cosine", vec_id="screen_id")
    return hits.select("query_id", "rank", F.col("id").alias("screen_id"), "distance")


@register("knn_pruned_clustered", f"""
WITH v AS (SELECT vec_id AS id, list_transform(embedding::DOUBLE[], lambda x, i: x * 0.05 + CASE WHEN i = label % 32 + 1 THEN 1.0 ELSE 0.0 END) AS v FROM embeddings),
d AS (SELECT q.id AS query_id, v.id, {Q.dist('l2', 'q.v', 'v.v')} AS distance FROM v q, v),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM d)
SELECT query_id, id, CAST(rank AS BIGINT) AS rank, round(distance, 6) AS distance FROM r WHERE rank <= {K}""")
def knn_pruned_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors gathered around one centre a label: most blocks are skipped (Euclidean)."""
    e = table(spark, sf_dir, "embeddings")
    moved = F.transform("embedding", lambda x, i: x.cast("double") * F.lit(0.05) + F.when(i == F.col("label") % 32, 1.0).otherwise(0.0))
    v = e.select(F.col("vec_id").alias("id"), moved.alias("vector"))
    hits, _ = knn_pruned(v.select(F.col("id").alias("query_id"), F.col("vector").alias("query_vector")), v, K, "l2",
                         limits=PruneLimits(block_rows=256))
    return hits


@register("retriever_compare", f"""
WITH {Q.EMB},
{Q.centroids('text', 'ct')}, {Q.centroids('image', 'ci')},
dt AS (SELECT ct.query_id, e.screen_id, {Q.dist('cosine', 'ct.qv', 'e.vector::DOUBLE[]')} AS distance
       FROM ct, emb e WHERE e.embedding_kind = 'text'),
di AS (SELECT ci.query_id, e.screen_id, {Q.dist('cosine', 'ci.qv', 'e.vector::DOUBLE[]')} AS distance
       FROM ci, emb e WHERE e.embedding_kind = 'image'),
t1 AS (SELECT query_id, screen_id AS text_id, round(distance, 6) AS text_distance FROM
       (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, screen_id) AS rn FROM dt) WHERE rn = 1),
i1 AS (SELECT query_id, screen_id AS image_id, round(distance, 6) AS image_distance FROM
       (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, screen_id) AS rn FROM di) WHERE rn = 1)
SELECT coalesce(t1.query_id, i1.query_id) AS query_id, text_id, text_distance, image_id, image_distance,
       coalesce(text_id = image_id, false) AS agree
FROM t1 FULL OUTER JOIN i1 ON t1.query_id = i1.query_id""")
def retriever_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-1 of the text retriever and of the image retriever, side by side."""
    t = knn(label_centroids(spark, sf_dir, "text"), vectors_of(spark, sf_dir, "text"), 1, "cosine",
            vec_id="screen_id")
    i = knn(label_centroids(spark, sf_dir, "image"), vectors_of(spark, sf_dir, "image"), 1, "cosine",
            vec_id="screen_id")
    return top1_side_by_side(t, i, "text", "image")


@register("multimodal_union", f"""
WITH {Q.EMB}
SELECT screen_id, embedding_kind, model_name, model_version, CAST(len(vector) AS BIGINT) AS dims,
       run_id, source_fingerprint FROM emb""")
def multimodal_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both encoder outputs in one table with a discriminator column."""
    return standins.emb(spark, sf_dir).select(
        "screen_id", "embedding_kind", "model_name", "model_version", F.size("vector").cast("long").alias("dims"),
        "run_id", "source_fingerprint")


@register("retriever_fusion", f"""
WITH {Q.EMB},
{Q.centroids('text', 'ct')}, {Q.centroids('image', 'ci')},
dt AS (SELECT ct.query_id, e.screen_id, {Q.dist('cosine', 'ct.qv', 'e.vector::DOUBLE[]')} AS distance
       FROM ct, emb e WHERE e.embedding_kind = 'text'),
di AS (SELECT ci.query_id, e.screen_id, {Q.dist('cosine', 'ci.qv', 'e.vector::DOUBLE[]')} AS distance
       FROM ci, emb e WHERE e.embedding_kind = 'image'),
rt AS (SELECT * FROM (SELECT query_id, screen_id,
         row_number() OVER (PARTITION BY query_id ORDER BY distance, screen_id) AS rank FROM dt) WHERE rank <= {K}),
ri AS (SELECT * FROM (SELECT query_id, screen_id,
         row_number() OVER (PARTITION BY query_id ORDER BY distance, screen_id) AS rank FROM di) WHERE rank <= {K}),
f AS (SELECT query_id, screen_id, sum(1.0::DOUBLE / (60 + rank)) AS score
      FROM (SELECT * FROM rt UNION ALL SELECT * FROM ri) GROUP BY query_id, screen_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, screen_id) AS rank FROM f)
SELECT query_id, screen_id, round(score, 9) AS score, CAST(rank AS BIGINT) AS rank FROM r WHERE rank <= {K}""")
def retriever_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extension: reciprocal-rank fusion of the text and image retrievers'
    top-5 lists per label centroid."""
    t = knn(label_centroids(spark, sf_dir, "text"), vectors_of(spark, sf_dir, "text"), K, "cosine",
            vec_id="screen_id")
    i = knn(label_centroids(spark, sf_dir, "image"), vectors_of(spark, sf_dir, "image"), K, "cosine",
            vec_id="screen_id")
    return reciprocal_rank_fusion([t, i], K).select("query_id", F.col("id").alias("screen_id"), "score", "rank")


# Near copies (first component moved by k · 1e-5) and tiny vectors (scaled by 1e-8): neighbours that
# any rounding of the distance before ranking would mix up.
NEAR_SQL = f"""
b AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
t AS (SELECT vec_id AS screen_id, v FROM b
      UNION ALL
      SELECT vec_id + 10000000, list_transform(v, lambda x, i: CASE WHEN i = 1 THEN x + (vec_id % 7 + 1) * 1e-5::DOUBLE ELSE x END) FROM b
      UNION ALL
      SELECT vec_id + 20000000,
             list_transform(v, lambda x, i: CASE WHEN i = 1 THEN (x + (vec_id % 5 + 1) * 2.7e-5::DOUBLE) * 1e-8::DOUBLE ELSE x * 1e-8::DOUBLE END) FROM b),
f AS (SELECT label, min(vec_id) AS vec_id FROM b GROUP BY label),
q AS (SELECT CAST(b.label AS BIGINT) AS query_id, b.v FROM b JOIN f USING (vec_id)
      UNION ALL
      SELECT 100 + b.label, list_transform(b.v, lambda x: x * 1e-8::DOUBLE) FROM b JOIN f USING (vec_id))"""


def _near_oracle(metrics) -> str:
    each = " UNION ALL ".join(
        f"""SELECT '{m}' AS metric, query_id, CAST(rank AS BIGINT) AS rank, screen_id FROM
  (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, screen_id) AS rank
   FROM (SELECT q.query_id, t.screen_id, {Q.dist(m, 'q.v', 't.v')} AS d FROM q, t)) WHERE rank <= {K}""" for m in metrics)
    return f"WITH {NEAR_SQL}\n{each}"


def _near(spark, sf_dir, metrics, strategy) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    tiny = F.transform("v", lambda x: x * F.lit(1e-8))
    moved = F.transform("v", lambda x, i: F.when(i == 0, x + (F.col("vec_id") % 7 + 1) * F.lit(1e-5)).otherwise(x))
    tiny_moved = F.transform("v", lambda x, i: F.when(i == 0, (x + (F.col("vec_id") % 5 + 1) * F.lit(2.7e-5)) * F.lit(1e-8)).otherwise(x * F.lit(1e-8)))
    vectors = (e.select(F.col("vec_id").alias("id"), F.col("v").alias("vector"))
               .unionByName(e.select((F.col("vec_id") + 10000000).alias("id"), moved.alias("vector")))
               .unionByName(e.select((F.col("vec_id") + 20000000).alias("id"), tiny_moved.alias("vector"))))
    firsts = e.groupBy("label").agg(F.min_by("v", "vec_id").alias("v"))       # one vector per label
    queries = (firsts.select(F.col("label").cast("long").alias("query_id"), F.col("v").alias("query_vector"))
               .unionByName(firsts.select((F.col("label") + 100).cast("long").alias("query_id"), tiny.alias("query_vector"))))
    out = None
    for m in metrics:
        part = knn(queries, vectors, K, m, strategy=strategy).select(
            F.lit(m).alias("metric"), "query_id", "rank", F.col("id").alias("screen_id"))
        out = part if out is None else out.unionByName(part)
    return out


@register("knn_near_broadcast", _near_oracle(("l2", "cosine", "ip")))
def knn_near_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies and tiny vectors under all three metrics, scan path."""
    return _near(spark, sf_dir, ("l2", "cosine", "ip"), "broadcast")


@register("knn_near_blocked", _near_oracle(("l2", "cosine", "ip")))
def knn_near_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search with queries and vectors co-grouped in blocks."""
    return _near(spark, sf_dir, ("l2", "cosine", "ip"), "blocked")
