"""Run lifecycle queries: duration lookup, status ladder, the 12 metrics in
long format, newest metric per key, and the run summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import quality as QL
from tessera.operators import runs as R
from tessera.operators import state as ST
from tessera.plans import fragments as Q
from tessera.plans.extract_plans import review_frame
from tessera.plans.quality_plans import pct_sql
from tessera.plans.registry import register
from tessera.sources import standins
from tessera.sources.tables import table

SUMMARY_FORMAT = ST.SUMMARY_FORMAT


def run_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ST.run_state(standins.runs(spark, sf_dir), standins.meta(spark, sf_dir), standins.emb(spark, sf_dir),
                        review_frame(spark, sf_dir))


STATE_SQL = f"""{Q.META}, {Q.EMB}, {Q.RUNS}, {Q.RESP}, {Q.ROUTED},
u AS (SELECT run_id, 1 AS meta, 0 AS image, 0 AS text, 0 AS review,
             CASE WHEN extraction_payload IS NOT NULL THEN 1 ELSE 0 END AS extracted FROM meta
      UNION ALL SELECT run_id, 0, CASE WHEN embedding_kind = 'image' THEN 1 ELSE 0 END,
             CASE WHEN embedding_kind = 'text' THEN 1 ELSE 0 END, 0, 0 FROM emb
      UNION ALL SELECT run_id, 0, 0, 0, 1, 0 FROM review),
per AS (SELECT run_id, sum(meta) AS meta_count, sum(image) AS image_count, sum(text) AS text_count,
               sum(review) AS review_count, sum(extracted) AS extracted_count FROM u GROUP BY run_id),
tot AS (SELECT sum(meta) AS total_meta, sum(image) AS total_image, sum(text) AS total_text FROM u),
mq AS (SELECT run_id, count(extraction_payload) AS payload_count, count_if(confidence >= 0.5) AS confident_count,
              count(DISTINCT app_package) AS distinct_app_package_count,
              count(DISTINCT category) AS distinct_category_count FROM meta GROUP BY run_id),
eq AS (SELECT run_id, count(*) AS emb_count,
              coalesce(avg(CASE WHEN embedding_kind = 'image' THEN len(vector) END), 0.0) AS image_vector_dims,
              coalesce(avg(CASE WHEN embedding_kind = 'text' THEN len(vector) END), 0.0) AS text_vector_dims,
              count_if(list_dot_product(vector, vector) = 0) AS zero_count FROM emb GROUP BY run_id),
w0 AS (SELECT r.run_id, r.started_at, r.ended_at, r.limit_param,
              coalesce(per.meta_count, 0) AS meta_count, coalesce(per.image_count, 0) AS image_count,
              coalesce(per.text_count, 0) AS text_count, coalesce(per.review_count, 0) AS review_count,
              coalesce(per.extracted_count, 0) AS extracted_count,
              coalesce(mq.payload_count, 0) AS payload_count, coalesce(mq.confident_count, 0) AS confident_count,
              coalesce(mq.distinct_app_package_count, 0) AS distinct_app_package_count,
              coalesce(mq.distinct_category_count, 0) AS distinct_category_count,
              coalesce(eq.emb_count, 0) AS emb_count, coalesce(eq.zero_count, 0) AS zero_count,
              coalesce(eq.image_vector_dims, 0.0) AS image_vector_dims,
              coalesce(eq.text_vector_dims, 0.0) AS text_vector_dims,
              tot.total_meta, tot.total_image, tot.total_text
       FROM runs r LEFT JOIN per USING (run_id) LEFT JOIN mq USING (run_id) LEFT JOIN eq USING (run_id), tot),
w AS (SELECT *,
        CASE WHEN meta_count = 0 AND total_meta >= limit_param THEN 'success'
             WHEN meta_count = 0 THEN 'failed'
             WHEN image_count = 0 AND total_image = 0 THEN 'failed'
             WHEN text_count = 0 AND total_text = 0 THEN 'failed'
             ELSE 'success' END AS status,
        CASE WHEN meta_count = 0 AND total_meta >= limit_param
                  THEN 'idempotent re-run — 0 new rows, ' || CAST(total_meta AS BIGINT) || ' existing'
             WHEN meta_count = 0 THEN 'no metadata rows found'
             WHEN image_count = 0 AND total_image = 0 THEN 'no image embeddings found'
             WHEN text_count = 0 AND total_text = 0 THEN 'no text embeddings found'
             ELSE 'all checks passed' END AS reason,
        (epoch_us(ended_at) - epoch_us(started_at)) / 1000000.0::DOUBLE AS total_run_duration_seconds
      FROM w0)"""


@register("run_duration", f"""
WITH {Q.META}, {Q.META_RERUNS}, {Q.RUNS},
ids AS (SELECT run_id FROM runs UNION SELECT run_id FROM meta_r)
SELECT ids.run_id, r.run_id IS NOT NULL AS found,
       CASE WHEN r.started_at IS NULL THEN 0.0
            ELSE (epoch_us(r.ended_at) - epoch_us(r.started_at)) / 1000000.0::DOUBLE END AS duration_seconds
FROM ids LEFT JOIN runs r USING (run_id)""")
def run_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run lookup by id for every run and every child row's run (absent →
    not found, 0.0 s); elapsed seconds, naive timestamps as UTC."""
    runs = standins.runs(spark, sf_dir)
    ids = runs.select("run_id").unionByName(standins.meta_with_reruns(spark, sf_dir).select("run_id")).distinct()
    found = runs.withColumn("found", F.lit(True))
    j = R.lookup_runs(ids, found)
    return j.select("run_id", F.coalesce(F.col("found"), F.lit(False)).alias("found"),
                    R.duration(j).alias("duration_seconds"))


@register("run_status", f"""
WITH {STATE_SQL}
SELECT run_id, CAST(meta_count AS BIGINT) AS meta_count, CAST(image_count AS BIGINT) AS image_count,
       CAST(text_count AS BIGINT) AS text_count, status, reason,
       CASE WHEN status = 'success' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS final_run_status FROM w""")
def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load step's decision ladder for every run."""
    s = run_state(spark, sf_dir)
    return s.select("run_id", "meta_count", "image_count", "text_count", "status", "reason", "final_run_status")


def _unpivot_sql() -> str:
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in QL.METRIC_NAMES)
    return f"""
m AS (SELECT run_id,
        total_run_duration_seconds,
        CASE WHEN status = 'success' THEN 1.0 ELSE 0.0 END AS final_run_status,
        meta_count AS metadata_row_count,
        {pct_sql('payload_count', 'meta_count')} AS extraction_payload_non_null_pct,
        {pct_sql('confident_count', 'meta_count')} AS confidence_above_threshold_pct,
        {pct_sql('review_count', 'meta_count')} AS review_queue_pct,
        emb_count AS embeddings_row_count, image_vector_dims, text_vector_dims,
        {pct_sql('zero_count', 'emb_count')} AS zero_norm_vector_pct,
        distinct_app_package_count, distinct_category_count FROM w),
md AS (SELECT run_id, {cols} FROM m)"""


@register("metrics_long", f"""
WITH {STATE_SQL}, {_unpivot_sql()}
SELECT run_id, metric_name, metric_value FROM (
  UNPIVOT md ON {', '.join(QL.METRIC_NAMES)} INTO NAME metric_name VALUE metric_value)""")
def metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 12 run metrics as (run_id, metric_name, metric_value) rows."""
    return QL.to_long(run_state(spark, sf_dir), QL.METRIC_NAMES)


@register("metrics_latest", """
SELECT 'run' || user_id AS run_id, event_type AS metric_name, value AS metric_value, ts AS recorded_at
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn = 1""")
def metrics_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest value per (run, metric) of an append-only metric log (events:
    run = user, metric = event type, value, recorded at ts)."""
    ev = table(spark, sf_dir, "events")
    log = ev.select(F.concat(F.lit("run"), F.col("user_id").cast("string")).alias("run_id"),
                    F.col("event_type").alias("metric_name"), F.col("value").alias("metric_value"),
                    F.col("ts").alias("recorded_at"), "event_id")
    return QL.latest_per_key(log, ["run_id", "metric_name"], "metric_value", "recorded_at", tie="event_id")


@register("run_summary", f"""
WITH {STATE_SQL}
SELECT run_id, status,
       CASE status WHEN 'success' THEN ':white_check_mark:' WHEN 'failed' THEN ':x:'
                   WHEN 'audit_failed' THEN ':rotating_light:' ELSE ':question:' END AS symbol,
       printf('%.1fs', round(total_run_duration_seconds, 1)) AS duration,
       printf('{SUMMARY_FORMAT}', meta_count, image_count, text_count, extracted_count, review_count,
              total_meta, total_image, total_text) AS summary,
       CASE WHEN image_vector_dims = 512 THEN '✓' ELSE '✗' END AS image_check,
       CASE WHEN text_vector_dims = 384 THEN '✓' ELSE '✗' END AS text_check,
       emb_count = 2 * meta_count AS emb_ratio_ok
FROM w""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary record per run: symbol, duration text, count line, dims
    checks, and the README's "embeddings = 2 × metadata" expectation."""
    return ST.summary(run_state(spark, sf_dir))


def _report_sql() -> str:
    fmt = R.REPORT_FORMAT.replace("'", "''")
    dims = "CASE WHEN {c} = {n} THEN '{y}' ELSE '{x}' END"
    return f"""
SELECT w.run_id,
       printf('{R.STARTED_FORMAT}', w.run_id, w.limit_param, 'manual') AS started_message,
       printf('{R.FINISHED_FORMAT}',
              CASE w.status WHEN 'success' THEN ':white_check_mark:' WHEN 'failed' THEN ':x:'
                            WHEN 'audit_failed' THEN ':rotating_light:' ELSE ':question:' END,
              w.run_id, w.status, round(w.total_run_duration_seconds, 1),
              printf('{SUMMARY_FORMAT}', w.meta_count, w.image_count, w.text_count, w.extracted_count,
                     w.review_count, w.total_meta, w.total_image, w.total_text)) AS finished_message,
       printf('{fmt}', w.run_id, CASE WHEN m.final_run_status = 1.0 THEN 'success' ELSE 'failed' END,
              round(m.total_run_duration_seconds, 1), CAST(m.metadata_row_count AS BIGINT),
              m.extraction_payload_non_null_pct, m.confidence_above_threshold_pct, m.review_queue_pct,
              CAST(m.embeddings_row_count AS BIGINT),
              CAST(trunc(m.image_vector_dims) AS BIGINT),
              {dims.format(c='m.image_vector_dims', n=QL.EXPECTED_IMAGE_DIMS, y=R.CHECK_YES, x=R.CHECK_NO)},
              CAST(trunc(m.text_vector_dims) AS BIGINT),
              {dims.format(c='m.text_vector_dims', n=QL.EXPECTED_TEXT_DIMS, y=R.CHECK_YES, x=R.CHECK_NO)},
              m.zero_norm_vector_pct, CAST(m.distinct_app_package_count AS BIGINT),
              CAST(m.distinct_category_count AS BIGINT)) AS summary_block
FROM w JOIN m USING (run_id)"""


@register("run_report", f"""
WITH {STATE_SQL}, {_unpivot_sql()}
{_report_sql()}""")
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per run, the texts a notifier would send (started / finished
    messages) and the metrics summary block — built with ``format_string``
    on the JVM side; delivery itself is out of scope.  Durations are
    rounded half-up to 1 decimal before formatting (both engines agree)."""
    return ST.report(run_state(spark, sf_dir))
