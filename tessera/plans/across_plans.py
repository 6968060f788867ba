"""Text → image space: a map learned from screens with both vectors lets texts
search the image index.  The oracles solve the same least squares in SQL, by
Gauss-Jordan elimination in a recursive query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.vectors import l2_normalize
from tessera.operators import align
from tessera.operators import embed as E
from tessera.plans import fragments as Q
from tessera.plans.registry import register
from tessera.session import materialize
from tessera.sources import standins
from tessera.sources.tables import table

DIM, RIDGE, K = 16, 1.0, 3

MAP_SQL = rf"""
images AS (SELECT vec_id AS screen_id, list_transform(v, lambda x: (x / nrm)::FLOAT) AS y
           FROM (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS nrm
                 FROM (SELECT vec_id, list_concat(embedding, embedding[1:16])::DOUBLE[] AS v FROM embeddings))),
tok AS (SELECT doc_id AS id, unnest(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+')) AS t FROM documents),
bc AS (SELECT id, ('0x' || substr(md5(t), 1, 8))::BIGINT % {DIM} AS b, count(*) AS c FROM tok WHERE t <> '' GROUP BY id, b),
bn AS (SELECT id, sqrt(sum(c * c)) AS nrm FROM bc GROUP BY id),
texts AS (SELECT d.doc_id AS screen_id, list(coalesce(bc.c / bn.nrm, 0.0)::FLOAT::DOUBLE ORDER BY r.b) AS x
          FROM documents d CROSS JOIN (SELECT unnest(range({DIM})) AS b) r
          LEFT JOIN bc ON bc.id = d.doc_id AND bc.b = r.b LEFT JOIN bn ON bn.id = d.doc_id GROUP BY d.doc_id),
pairs AS (SELECT x, list_concat(x, y::DOUBLE[]) AS z, y::DOUBLE[] AS y FROM texts JOIN images USING (screen_id)),
sums AS (SELECT i, j, sum(x[i] * z[j]) + CASE WHEN i = j THEN {RIDGE} ELSE 0 END AS s
         FROM pairs, (SELECT unnest(range(1, {DIM + 1})) AS i), (SELECT unnest(range(1, {DIM + 81})) AS j) GROUP BY i, j),
steps AS (
  SELECT 0 AS k, list(r ORDER BY i) AS a FROM (SELECT i, list(s ORDER BY j) AS r FROM sums GROUP BY i)
  UNION ALL
  SELECT k + 1, list_transform(a, lambda r, i: CASE WHEN i = k + 1 THEN list_transform(r, lambda x: x / r[k + 1])
                  ELSE list_transform(r, lambda x, j: x - r[k + 1] * a[k + 1][j] / a[k + 1][k + 1]) END)
  FROM steps WHERE k < {DIM}),
w AS (SELECT list_transform(a, lambda r: r[{DIM + 1}:]) AS w FROM steps WHERE k = {DIM})"""


def image_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(screen_id, vector): image vectors of unit length."""
    images = standins.emb(spark, sf_dir).where(F.col("embedding_kind") == "image")
    return images.select("screen_id", l2_normalize("vector").alias("vector"))


def text_to_image(spark: SparkSession, sf_dir: str) -> align.LinearMap:
    """The map learned from the screens with a text and an image vector."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("screen_id"), "text")
    shown = docs.join(image_index(spark, sf_dir), "screen_id")
    texts = E.with_hash_vectors(shown, "text", "text_vector", DIM).select("text_vector", "vector")
    return align.fit(texts, "text_vector", "vector", RIDGE)


@register("text_image_fit", f"""
WITH RECURSIVE {MAP_SQL},
f AS (SELECT y, list_transform(range(1, 81), lambda j: list_sum(list_transform(range(1, {DIM + 1}), lambda i: x[i] * w[i][j]))) AS p FROM pairs, w)
SELECT count(*) AS pairs, round(sum(list_sum(list_transform(y, lambda v: v * v))), 4) AS squares,
       round(sum(list_sum(list_transform(list_zip(y, p), lambda t: (t[1] - t[2]) * (t[1] - t[2])))), 4) AS residual FROM f""")
def text_image_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of the image vectors the map explains on the pairs it was learned from."""
    found = text_to_image(spark, sf_dir)
    return spark.createDataFrame([(found.pairs, round(found.squares, 4), round(found.residual, 4))], "pairs long, squares double, residual double")


@register("text_image_search", f"""
WITH RECURSIVE {MAP_SQL}, {Q.META},
m AS (SELECT screen_id AS query_id, list_transform(range(1, 81), lambda j: list_sum(list_transform(range(1, {DIM + 1}), lambda i: x[i] * w[i][j]))) AS p
      FROM texts, w WHERE screen_id NOT IN (SELECT screen_id FROM images)),
q AS (SELECT query_id, CASE WHEN nrm > 0 THEN list_transform(p, lambda x: (x / nrm)::FLOAT::DOUBLE) ELSE p END AS v
      FROM (SELECT *, sqrt(list_sum(list_transform(p, lambda x: x * x))) AS nrm FROM m)),
d AS (SELECT query_id, screen_id, {Q.dist('l2', 'q.v', 'i.y::DOUBLE[]')} AS distance FROM q, images i WHERE screen_id IN (SELECT screen_id FROM meta)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, screen_id) AS rank FROM d)
SELECT r.query_id, CAST(r.rank AS BIGINT) AS rank, r.screen_id, round(r.distance, 6) AS distance, meta.app_package, meta.category, meta.png_path
FROM r JOIN meta USING (screen_id) WHERE r.rank <= {K}""")
def text_image_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without an image of its own searches the image index through the map (Euclidean
    on unit vectors), its top 3 joined to metadata with the path of the picture."""
    index = materialize(image_index(spark, sf_dir), "image-index")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("screen_id"), "text")
    asked = docs.join(index.select("screen_id"), "screen_id", "left_anti").select(F.col("screen_id").alias("query_id"), E.tokens(F.col("text")).alias("tokens"))
    meta = standins.meta(spark, sf_dir).select("screen_id", "app_package", "category", "png_path")
    hits = align.search_across(materialize(asked, "asked"), "tokens", align.hashing_encoder(DIM), text_to_image(spark, sf_dir), index, K, metadata=meta)
    return hits.select("query_id", "rank", "screen_id", "distance", "app_package", "category", "png_path")
