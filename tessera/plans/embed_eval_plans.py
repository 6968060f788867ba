"""Encoder, normalisation, text-query search, recall evaluation and
streaming-ingest queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions import vectors as V
from tessera.operators import embed as E
from tessera.operators import evaluate as EV
from tessera.operators.search import knn
from tessera.plans import fragments as Q
from tessera.plans.registry import register
from tessera.session import work_dir
from tessera.sources import standins
from tessera.sources.tables import table
from tessera.streaming.ingest import run_dedup_ingest

K_SEARCH = 3
K_RECALL = 5
STREAM_SPLIT = ("2024-01-20 00:00:00", "2024-01-15 00:00:00")  # part 1 before, part 2 from (overlap)


def _summary(vec: F.Column):
    """Comparable scalars of a vector: dims, non-zeros, index-weighted sum."""
    return (F.size(vec).cast("long").alias("dims"),
            F.size(F.filter(vec, lambda x: x != 0)).cast("long").alias("nnz"),
            F.round(F.aggregate(F.transform(vec, lambda x, i: x.cast("double") * (i + 1)),
                                F.lit(0.0).cast("double"), lambda a, x: a + x), 6).alias("checksum"))


HASH_SQL = r"""
tok AS (SELECT {key} AS id, unnest(regexp_split_to_array(lower({text}), '[^\p{{L}}\p{{N}}]+')) AS t FROM {table}),
b AS (SELECT id, ('0x' || substr(md5(t), 1, 8))::BIGINT % 384 AS bucket, count(*) AS c
      FROM tok WHERE t <> '' GROUP BY id, bucket),
n AS (SELECT id, sqrt(sum(c * c)) AS nrm FROM b GROUP BY id),
x AS (SELECT id, bucket, (c / nrm)::FLOAT AS x FROM b JOIN n USING (id))"""


@register("embed_text_hash", f"""
WITH {HASH_SQL.format(key='doc_id', text='text', table='documents')}
SELECT d.doc_id, CAST(384 AS BIGINT) AS dims, count(x.bucket) AS nnz,
       round(coalesce(sum(x.x::DOUBLE * (x.bucket + 1)), 0.0), 6) AS checksum, sha256(d.text) AS source_fingerprint
FROM documents d LEFT JOIN x ON x.id = d.doc_id GROUP BY d.doc_id, d.text""")
def embed_text_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text → 384-d unit vector (hashing encoder) with text fingerprint."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    e = E.embed_text(d, "text", "run-embed", key="doc_id")
    return e.select(F.col("screen_id").alias("doc_id"), *_summary(F.col("vector")), "source_fingerprint")


@register("embed_binary_hist", r"""
WITH h AS (SELECT page_id, html, regexp_replace(hex(html), '(.)(.)', '\2', 'g') AS low FROM pages),
c AS (SELECT page_id, html, list_transform(range(16), lambda d: length(low)
        - length(replace(low, substr('0123456789ABCDEF', CAST(d + 1 AS INTEGER), 1), ''))) AS cnt FROM h),
n AS (SELECT page_id, html, cnt, sqrt(list_sum(list_transform(cnt, lambda x: x::DOUBLE * x))) AS nrm FROM c),
v AS (SELECT page_id, html, list_transform(cnt, lambda x: (x / nrm)::FLOAT) AS vec FROM n)
SELECT page_id, CAST(len(vec) AS BIGINT) AS dims, CAST(len(list_filter(vec, lambda x: x <> 0)) AS BIGINT) AS nnz,
       round(list_sum(list_transform(vec, lambda x, i: x::DOUBLE * i)), 6) AS checksum,
       sha256(html) AS source_fingerprint FROM v""")
def embed_binary_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes → 16-d unit vector (low-nibble histogram) with byte fingerprint."""
    p = table(spark, sf_dir, "pages").select("page_id", F.encode("html", "UTF-8").alias("payload"))
    e = E.embed_binary(p, "payload", "run-embed", key="page_id")
    return e.select(F.col("screen_id").alias("page_id"), *_summary(F.col("vector")), "source_fingerprint")


@register("text_query_search", f"""
WITH {HASH_SQL.format(key='doc_id', text='text', table='documents')},
qtok AS (SELECT item_id AS id, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) AS t FROM benchmark),
qb AS (SELECT id, ('0x' || substr(md5(t), 1, 8))::BIGINT % 384 AS bucket, count(*) AS c
       FROM qtok WHERE t <> '' GROUP BY id, bucket),
qn AS (SELECT id, sqrt(sum(c * c)) AS nrm FROM qb GROUP BY id),
qx AS (SELECT id, bucket, (c / nrm)::FLOAT AS x FROM qb JOIN qn USING (id)),
dnorm AS (SELECT id, sqrt(sum(x::DOUBLE * x::DOUBLE ORDER BY bucket)) AS nrm FROM x GROUP BY id),
qnorm AS (SELECT id, sqrt(sum(x::DOUBLE * x::DOUBLE ORDER BY bucket)) AS nrm FROM qx GROUP BY id),
dots AS (SELECT qx.id AS qid, x.id AS did, sum(qx.x::DOUBLE * x.x::DOUBLE ORDER BY bucket) AS dot
         FROM qx JOIN x USING (bucket) GROUP BY qx.id, x.id),
pairs AS (SELECT b.item_id AS query_id, d.doc_id,
                 1 - coalesce(dots.dot, 0.0) / (qnorm.nrm * dnorm.nrm) AS distance
          FROM benchmark b CROSS JOIN documents d
          JOIN qnorm ON qnorm.id = b.item_id JOIN dnorm ON dnorm.id = d.doc_id
          LEFT JOIN dots ON dots.qid = b.item_id AND dots.did = d.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) AS rank FROM pairs)
SELECT r.query_id, CAST(r.rank AS BIGINT) AS rank, r.doc_id, round(r.distance, 6) AS distance, d.source, d.lang
FROM r JOIN documents d USING (doc_id) WHERE r.rank <= {K_SEARCH}""")
def text_query_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages encoded with the same encoder as the documents,
    top-3 documents per passage (cosine), joined to document metadata."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    dv = E.with_hash_vectors(docs.select("doc_id", "text"), "text", "vector").select("doc_id", "vector")
    qv = E.with_hash_vectors(table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text"),
                             "text", "query_vector").select("query_id", "query_vector")
    hits = knn(qv, dv, K_SEARCH, "cosine", vec_id="doc_id").withColumnRenamed("id", "doc_id")
    return hits.join(docs.select("doc_id", "source", "lang"), "doc_id").select(
        "query_id", "rank", "doc_id", "distance", "source", "lang")


@register("l2_normalize", """
WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * (label + 1)) AS v FROM embeddings),
n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS nrm FROM s),
u AS (SELECT vec_id, nrm, CASE WHEN nrm > 0 THEN list_transform(v, lambda x: (x / nrm)::FLOAT)
                               ELSE list_transform(v, lambda x: x::FLOAT) END AS u FROM n)
SELECT vec_id AS screen_id, round(nrm, 6) AS norm_before,
       round(sqrt(list_sum(list_transform(u, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm_after,
       round(u[1]::DOUBLE, 6) AS first_after FROM u""")
def l2_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors scaled by (label + 1), then L2-normalised (zero stays zero)."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    scaled = F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 1))
    u = V.l2_normalize(scaled)
    return e.select(F.col("vec_id").alias("screen_id"), F.round(V.norm(scaled), 6).alias("norm_before"),
                    F.round(V.norm(u), 6).alias("norm_after"),
                    F.round(F.try_element_at(u, F.lit(1)).cast("double"), 6).alias("first_after"))


def _text_vectors(spark, sf_dir):
    return (standins.emb(spark, sf_dir).where(F.col("embedding_kind") == "text")
            .select("screen_id", "vector"))


def _holdout_queries(spark, sf_dir):
    v = _text_vectors(spark, sf_dir)
    pairs = EV.next_in_order(v, "screen_id")
    return pairs.join(v.select(F.col("screen_id").alias("next_screen_id"), F.col("vector").alias("query_vector")),
                      "next_screen_id").select(F.col("screen_id").alias("query_id"),
                                               F.col("screen_id").alias("expected_id"), "query_vector")


TEXT_VECS_SQL = f"""{Q.EMB},
t AS (SELECT screen_id, vector::DOUBLE[] AS v FROM emb WHERE embedding_kind = 'text')"""
HOLDOUT_SQL = f"""{TEXT_VECS_SQL},
o AS (SELECT screen_id, coalesce(lead(screen_id) OVER (ORDER BY screen_id), min(screen_id) OVER ()) AS nxt FROM t),
q AS (SELECT o.screen_id AS query_id, t.v FROM o JOIN t ON t.screen_id = o.nxt)"""


def _ranked_sql(k: int) -> str:
    return f"""
d AS (SELECT q.query_id, t.screen_id, {Q.dist('cosine', 'q.v', 't.v')} AS distance FROM q, t),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, screen_id) AS rn FROM d),
h AS (SELECT query_id, coalesce(bool_or(screen_id = query_id), false) AS hit,
             string_agg(CAST(screen_id AS VARCHAR), ',' ORDER BY rn) AS ranked_ids
      FROM r WHERE rn <= {k} GROUP BY query_id)"""


SELF_TEST_SQL = f"""{TEXT_VECS_SQL},
q AS (SELECT t.screen_id AS query_id, t.v FROM t JOIN documents d ON d.doc_id = t.screen_id
      WHERE regexp_replace(d.text, '^\\s+|\\s+$', '', 'g') <> ''),
{_ranked_sql(K_RECALL)},
res AS (SELECT coalesce(avg(CASE WHEN hit THEN 1.0 ELSE 0.0 END), 0.0) AS recall, count(*) AS tested,
               CAST(count_if(hit) AS BIGINT) AS hits FROM h)"""


def _self_test(spark: SparkSession, sf_dir: str, pruned: bool = False) -> DataFrame:
    v = _text_vectors(spark, sf_dir)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("screen_id"), "text")
    q = (v.join(docs, "screen_id").where(~T.is_blank("text"))
         .select(F.col("screen_id").alias("query_id"), F.col("screen_id").alias("expected_id"),
                 F.col("vector").alias("query_vector")))
    return EV.recall(EV.hits(q, v, K_RECALL, pruned=pruned))


@register("recall_self_test", f"""
WITH {SELF_TEST_SQL}
SELECT recall, tested, hits FROM res""")
def recall_self_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """recall@5: every screen with non-blank text queries the whole text
    index with its own vector; denominator = screens tested."""
    return _self_test(spark, sf_dir)


@register("recall_self_test_pruned", f"""
WITH {SELF_TEST_SQL}
SELECT recall, tested, hits FROM res""")
def recall_self_test_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same self-test with the search that skips blocks by pivot bounds."""
    return _self_test(spark, sf_dir, pruned=True)


INDEX_KEY = ["embedding_kind", "model_name", "model_version"]


@register("recall_by_model", f"""
WITH {Q.EMB},
t AS (SELECT embedding_kind, model_name, model_version, screen_id, vector::DOUBLE[] AS v FROM emb),
q AS (SELECT t.* FROM t JOIN documents d ON d.doc_id = t.screen_id
      WHERE regexp_replace(d.text, '^\\s+|\\s+$', '', 'g') <> ''),
d AS (SELECT q.embedding_kind, q.model_name, q.model_version, q.screen_id AS query_id, t.screen_id,
             {Q.dist('cosine', 'q.v', 't.v')} AS distance
      FROM q JOIN t USING (embedding_kind, model_name, model_version)),
r AS (SELECT *, row_number() OVER (PARTITION BY embedding_kind, model_name, model_version, query_id
                                   ORDER BY distance, screen_id) AS rn FROM d),
h AS (SELECT embedding_kind, model_name, model_version, query_id, coalesce(bool_or(screen_id = query_id), false) AS hit
      FROM r WHERE rn <= {K_RECALL} GROUP BY embedding_kind, model_name, model_version, query_id)
SELECT embedding_kind, model_name, model_version, coalesce(avg(CASE WHEN hit THEN 1.0 ELSE 0.0 END), 0.0) AS recall,
       count(*) AS tested, CAST(count_if(hit) AS BIGINT) AS hits
FROM h GROUP BY embedding_kind, model_name, model_version""")
def recall_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """recall@5 self-test of every index — (kind, model, version) of the
    embedding table, 64-d text and 80-d image — in one plan: each vector
    searches only its own index; one result row per index."""
    e = standins.emb(spark, sf_dir).select(*INDEX_KEY, "screen_id", "vector")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("screen_id"), "text")
    q = (e.join(docs, "screen_id").where(~T.is_blank("text"))
         .select(*INDEX_KEY, F.col("screen_id").alias("query_id"), F.col("screen_id").alias("expected_id"),
                 F.col("vector").alias("query_vector")))
    return EV.recall(EV.hits(q, e, K_RECALL, group=INDEX_KEY), by=INDEX_KEY)


EVAL_RUN = "run-eval"


@register("eval_metrics", f"""
WITH {SELF_TEST_SQL}
SELECT '{EVAL_RUN}' AS run_id, 'eval_recall_at_{K_RECALL}' AS metric_name, CAST(recall AS DOUBLE) AS metric_value,
       '{standins.TEXT_MODEL[0]}' AS model_name, '{standins.TEXT_MODEL[1]}' AS model_version FROM res
UNION ALL
SELECT '{EVAL_RUN}', 'eval_screens_tested', CAST(tested AS DOUBLE), '{standins.TEXT_MODEL[0]}',
       '{standins.TEXT_MODEL[1]}' FROM res""")
def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The self-test's two metric rows (recall@5, screens tested) as appended
    to the metrics log, tagged with the index's model and version."""
    return EV.eval_metric_rows(_self_test(spark, sf_dir), EVAL_RUN, K_RECALL, standins.TEXT_MODEL)


@register("recall_holdout", f"""
WITH {HOLDOUT_SQL}, {_ranked_sql(1)}
SELECT coalesce(avg(CASE WHEN hit THEN 1.0 ELSE 0.0 END), 0.0) AS recall, count(*) AS tested,
       CAST(count_if(hit) AS BIGINT) AS hits FROM h""")
def recall_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disjoint holdout, k = 1: screen i is queried with the vector of the
    next screen in id order ((i + 1) mod n)."""
    v = _text_vectors(spark, sf_dir)
    return EV.recall(EV.hits(_holdout_queries(spark, sf_dir), v, 1))


@register("recall_detail", f"""
WITH {HOLDOUT_SQL}, {_ranked_sql(K_RECALL)}
SELECT query_id, query_id AS expected_id, hit, ranked_ids FROM h""")
def recall_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-query detail of recall@5 on the holdout set: hit flag and the
    ranked ids."""
    v = _text_vectors(spark, sf_dir)
    return EV.hits(_holdout_queries(spark, sf_dir), v, K_RECALL)


@register("stream_ingest_dedup", """
SELECT event_id, user_id, event_type, value FROM events""")
def stream_ingest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental ingest: events arrive as two overlapping file drops; a
    Structured Streaming query (availableNow, restarted between drops)
    de-duplicates on the key and appends each key exactly once."""
    base = work_dir(spark, "stream")
    src, target, ckpt = f"{base}/source", f"{base}/target", f"{base}/checkpoint"
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    cut1, cut2 = STREAM_SPLIT
    ev.where(F.col("ts") < F.lit(cut1).cast("timestamp_ntz")).write.mode("append").parquet(src)
    run_dedup_ingest(spark, src, ev.schema, ["event_id"], target, ckpt)
    ev.where(F.col("ts") >= F.lit(cut2).cast("timestamp_ntz")).write.mode("append").parquet(src)
    run_dedup_ingest(spark, src, ev.schema, ["event_id"], target, ckpt)
    return spark.read.parquet(target).select("event_id", "user_id", "event_type", "value")
