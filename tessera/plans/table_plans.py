"""Sources, sinks and keyed-table queries: bounded scan, id-list semi join,
bronze ingest, object listing, payload join, run scan, insert-if-absent
(single and composite key), strict-insert conflicts, cascade delete, and
the scalar text helpers (fingerprint, sizes, preview)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import ingest as I
from tessera.operators import tables as TB
from tessera.plans import fragments as Q
from tessera.plans.extract_plans import review_frame
from tessera.plans.registry import register
from tessera.session import work_dir
from tessera.sources import standins
from tessera.sources.tables import read_id_list, table

SCAN_LIMIT = 50
RETENTION_CUTOFF = "2024-01-01 01:00:00"


@register("scan_limit", f"""
WITH {Q.META}
SELECT screen_id, app_package, category, run_id FROM meta ORDER BY screen_id LIMIT {SCAN_LIMIT}""")
def scan_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounded source read: the first N rows by key (a plain ``limit`` would
    not be deterministic); planned as a top-k, not a full sort."""
    m = standins.meta(spark, sf_dir)
    return m.select("screen_id", "app_package", "category", "run_id").orderBy("screen_id").limit(SCAN_LIMIT)


@register("id_list_semi_join", """
SELECT doc_id, source, lang FROM documents WHERE doc_id IN (SELECT item_id FROM benchmark)""")
def id_list_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id list file (comment and blank lines, repeats) → unique ids → semi
    join.  The list is derived from ``benchmark`` and written to the shared
    work folder first, then read back as a text source."""
    path = work_dir(spark, "id-list")
    ids = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("value"))
    header = spark.createDataFrame([("# chosen ids",), ("",)], "value string")
    header.unionByName(ids).unionByName(ids.select(F.concat(F.lit(" "), "value").alias("value"))) \
        .write.mode("errorifexists").text(path)
    wanted = read_id_list(spark, path)
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return docs.join(wanted.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("screenId"), F.col("source").alias("app_package_name"),
        F.col("lang").alias("category"), F.col("text").alias("image"))
    return I.to_bronze(src, "run-ingest")


@register("ingest_bronze", """
SELECT doc_id AS screen_id, source AS app_package, lang AS category,
       'screens/' || doc_id || '.png' AS png_path, 'screens/' || doc_id || '.json' AS hierarchy_json_path,
       '{}' AS hierarchy_json, CAST(strlen(text) AS BIGINT) AS payload_bytes, sha256(text) AS source_fingerprint,
       'run-ingest' AS run_id
FROM documents""")
def ingest_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source rows → bronze: defaults only for absent attributes, derived
    object keys, SHA-256 of the payload bytes, run lineage."""
    b = _bronze(spark, sf_dir)
    return b.select("screen_id", "app_package", "category", "png_path", "hierarchy_json_path", "hierarchy_json",
                    F.octet_length("payload").cast("long").alias("payload_bytes"), "source_fingerprint", "run_id")


@register("object_listing", """
SELECT 'pages/' || page_id || '.html' AS object_key, CAST(strlen(html) AS BIGINT) AS size_bytes,
       (SELECT count(*) FROM pages) AS n_objects
FROM pages ORDER BY object_key""")
def object_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted listing of stored objects with sizes and the object count."""
    p = table(spark, sf_dir, "pages").select("page_id", "html")
    listing = p.select(F.concat(F.lit("pages/"), F.col("page_id").cast("string"), F.lit(".html")).alias("object_key"),
                       F.octet_length("html").cast("long").alias("size_bytes"))
    n = p.agg(F.count(F.lit(1))).scalar()
    return listing.withColumn("n_objects", n).orderBy("object_key")


@register("bronze_payload_join", f"""
WITH {Q.META}
SELECT m.screen_id, CAST(strlen(d.text) AS BIGINT) AS payload_bytes, sha256(d.text) = m.source_fingerprint AS fingerprint_ok
FROM meta m JOIN documents d ON m.hierarchy_json_path = 'screens/' || d.doc_id || '.json'""")
def bronze_payload_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blob read by key as one join of metadata to the payload table (not
    one request per row); fingerprints re-checked."""
    meta = standins.meta(spark, sf_dir).select("screen_id", "hierarchy_json_path", "source_fingerprint")
    b = _bronze(spark, sf_dir).select(F.col("hierarchy_json_path").alias("key"), "payload")
    j = meta.join(b, meta.hierarchy_json_path == b.key)
    return j.select("screen_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
                    (T.fingerprint("payload") == F.col("source_fingerprint")).alias("fingerprint_ok"))


@register("run_scan", f"""
WITH {Q.META}
SELECT screen_id, hierarchy_json_path, source_fingerprint FROM meta WHERE run_id = 'run1'""")
def run_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projection + run filter (partition pruning when stored by run)."""
    m = standins.meta(spark, sf_dir)
    return m.where(F.col("run_id") == "run1").select("screen_id", "hierarchy_json_path", "source_fingerprint")


def _labelled(spark, sf_dir):
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("screen_id"))


@register("insert_if_absent", f"""
WITH {Q.META}
SELECT screen_id, app_package, 'new1' AS run_id FROM meta WHERE screen_id NOT IN (SELECT doc_id FROM labels)""")
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ON CONFLICT DO NOTHING: target = labelled screens; source = every
    screen twice (arrivals 1 and 2).  Result = the inserted delta: each new
    key once, first arrival wins, existing keys untouched."""
    meta = standins.meta(spark, sf_dir).select("screen_id", "app_package", "run_id")
    target = meta.join(_labelled(spark, sf_dir), "screen_id", "left_semi")
    src = (meta.withColumn("run_id", F.lit("new1")).withColumn("arrival", F.lit(1))
           .unionByName(meta.withColumn("run_id", F.lit("new2")).withColumn("arrival", F.lit(2))))
    _, delta = TB.insert_if_absent(target, src, ["screen_id"], order_col="arrival")
    return delta.select("screen_id", "app_package", "run_id")


def _emb_v2(spark, sf_dir):
    e = standins.emb(spark, sf_dir)
    return e.unionByName(e.where(F.col("embedding_kind") == "image").withColumn("model_version", F.lit("v2")))


@register("insert_if_absent_composite", f"""
WITH {Q.EMB},
src AS (SELECT * FROM emb UNION ALL SELECT screen_id, model_name, 'v2', embedding_kind, vector, run_id,
        source_fingerprint FROM emb WHERE embedding_kind = 'image')
SELECT screen_id, model_name, model_version, embedding_kind, run_id FROM src
WHERE embedding_kind <> 'text'""")
def insert_if_absent_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composite key (screen, model, version, kind): target = text rows;
    source = both kinds plus a second image model version."""
    e = standins.emb(spark, sf_dir)
    target = e.where(F.col("embedding_kind") == "text")
    _, delta = TB.insert_if_absent(target, _emb_v2(spark, sf_dir), ["screen_id", "model_name", "model_version",
                                                                    "embedding_kind"])
    return delta.select("screen_id", "model_name", "model_version", "embedding_kind", "run_id")


@register("insert_conflicts", f"""
WITH {Q.EMB}
SELECT screen_id, model_name, model_version, embedding_kind FROM emb
WHERE screen_id IN (SELECT doc_id FROM labels)""")
def insert_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys a strict insert would fail on: a re-encode of the labelled
    screens (conflicting) plus new-version rows (not conflicting)."""
    e = standins.emb(spark, sf_dir)
    again = e.join(_labelled(spark, sf_dir), "screen_id", "left_semi")
    new_version = e.withColumn("model_version", F.lit("v2"))
    c = TB.conflicts(e, again.unionByName(new_version), ["screen_id", "model_name", "model_version",
                                                         "embedding_kind"])
    return c.select("screen_id", "model_name", "model_version", "embedding_kind")


@register("cascade_delete", f"""
WITH {Q.META}, {Q.EMB}, {Q.RUNS}, {Q.RESP}, {Q.ROUTED},
gone AS (SELECT run_id FROM runs WHERE started_at < TIMESTAMP '{RETENTION_CUTOFF}')
SELECT 'screens_metadata' AS "table", count(*) AS rows_before,
       count(*) FILTER (WHERE run_id NOT IN (SELECT run_id FROM gone)) AS rows_after FROM meta
UNION ALL SELECT 'screens_embeddings', count(*), count(*) FILTER (WHERE run_id NOT IN (SELECT run_id FROM gone)) FROM emb
UNION ALL SELECT 'screens_review_queue', count(*), count(*) FILTER (WHERE run_id NOT IN (SELECT run_id FROM gone)) FROM review
UNION ALL SELECT 'pipeline_runs', count(*), count(*) FILTER (WHERE run_id NOT IN (SELECT run_id FROM gone)) FROM runs""")
def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention: delete runs started before a cutoff and, by cascade, every
    child row of those runs.  ``TB.cascade_delete`` gives the remaining
    tables (anti-joins); this report counts before / after in one pass per
    table."""
    runs = standins.runs(spark, sf_dir)
    gone = runs.where(F.col("started_at") < F.lit(RETENTION_CUTOFF).cast("timestamp_ntz")).select("run_id")
    before = {"screens_metadata": standins.meta(spark, sf_dir), "screens_embeddings": standins.emb(spark, sf_dir),
              "screens_review_queue": review_frame(spark, sf_dir), "pipeline_runs": runs}
    return TB.cascade_report(before, gone)


@register("fingerprint", """
SELECT doc_id, sha256(text) AS text_sha256, sha256(encode(text)) AS bytes_sha256 FROM documents""")
def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SHA-256 hex of text (UTF-8) and of the same bytes as binary."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", T.fingerprint("text").alias("text_sha256"),
                    T.fingerprint(F.encode("text", "UTF-8")).alias("bytes_sha256"))


@register("payload_stats", """
SELECT doc_id, CAST(strlen(text) AS BIGINT) AS n_bytes, CAST(length(text) AS BIGINT) AS n_chars,
       n_chars AS declared_chars FROM documents""")
def payload_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte and character lengths per payload."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return d.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                    F.length("text").cast("long").alias("n_chars"), F.col("n_chars").alias("declared_chars"))


@register("text_preview", """
SELECT doc_id,
       CASE WHEN length(text) <= 80 THEN text ELSE left(text, 77) || '...' END AS preview,
       left(sha256(text), 16) AS fingerprint_prefix,
       left(text, 2000) AS raw_cut,
       CASE WHEN length(text) > 1500 THEN left(text, 1500) || chr(10) || '... (truncated)' ELSE text END
         AS message_cut
FROM documents""")
def text_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display truncations: 80-char preview with dots, 16-char fingerprint
    prefix, 2000-char raw-output cut, 1500-char message cut with a marker."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", T.preview("text").alias("preview"),
                    T.cut(T.fingerprint("text"), T.FINGERPRINT_PREFIX).alias("fingerprint_prefix"),
                    T.cut("text", 2000).alias("raw_cut"),
                    T.cut("text", T.DETAILS_CHARS, T.TRUNCATED_MARKER).alias("message_cut"))


@register("upsert_latest", f"""
WITH {Q.META}
SELECT screen_id, upper(category) AS category, 'rerun' AS run_id FROM meta
WHERE screen_id IN (SELECT doc_id FROM labels)
UNION ALL
SELECT screen_id, category, run_id FROM meta WHERE screen_id NOT IN (SELECT doc_id FROM labels)""")
def upsert_latest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extension — ON CONFLICT DO UPDATE: re-ingested labelled screens (two
    arrivals, the later one wins) replace their rows; the rest stay."""
    meta = standins.meta(spark, sf_dir).select("screen_id", "category", "run_id")
    again = meta.join(_labelled(spark, sf_dir), "screen_id", "left_semi")
    src = (again.withColumn("category", F.lower("category")).withColumn("run_id", F.lit("early"))
           .withColumn("arrival", F.lit(1))
           .unionByName(again.withColumn("category", F.upper("category")).withColumn("run_id", F.lit("rerun"))
                        .withColumn("arrival", F.lit(2))))
    table_, _ = TB.upsert_latest(meta, src, ["screen_id"], order_col="arrival")
    return table_
