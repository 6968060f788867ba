"""Quality, audit and constraint queries."""

from __future__ import annotations

import contextlib
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import vectors as V
from tessera.operators import quality as QL
from tessera.plans import fragments as Q
from tessera.plans.extract_plans import review_frame
from tessera.plans.registry import register
from tessera.session import work_dir
from tessera.sources import standins

ZERO_LABEL = 0
PCT = "CASE WHEN {d} > 0 THEN round(100.0::DOUBLE * {n} / {d}, 1) ELSE 0.0::DOUBLE END"


def pct_sql(n: str, d: str) -> str:
    return PCT.format(n=n, d=d)


@register("kind_counts", f"""
WITH {Q.EMB}
SELECT embedding_kind, count(*) AS n, CAST(round(avg(len(vector))) AS BIGINT) AS dims
FROM emb GROUP BY embedding_kind""")
def kind_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and mean dimension per modality (the store's int cast rounds)."""
    e = standins.emb(spark, sf_dir)
    return e.groupBy("embedding_kind").agg(F.count(F.lit(1)).alias("n"),
                                           F.round(F.avg(V.dims("vector"))).cast("long").alias("dims"))


@register("load_counts", f"""
WITH {Q.META}, {Q.EMB}, {Q.RESP}, {Q.ROUTED},
u AS (SELECT run_id, 1 AS meta, CASE WHEN extraction_payload IS NOT NULL THEN 1 ELSE 0 END AS extracted,
             0 AS image, 0 AS text, 0 AS review FROM meta
      UNION ALL SELECT run_id, 0, 0, CASE WHEN embedding_kind = 'image' THEN 1 ELSE 0 END,
             CASE WHEN embedding_kind = 'text' THEN 1 ELSE 0 END, 0 FROM emb
      UNION ALL SELECT run_id, 0, 0, 0, 0, 1 FROM review)
SELECT run_id, CAST(sum(meta) AS BIGINT) AS meta_count, CAST(sum(image) AS BIGINT) AS image_count,
       CAST(sum(text) AS BIGINT) AS text_count, CAST(sum(review) AS BIGINT) AS review_count,
       CAST(sum(extracted) AS BIGINT) AS extracted_count, grouping(run_id) = 1 AS is_total
FROM u GROUP BY ROLLUP (run_id)""")
def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-run counts of every table plus whole-table totals (one rollup)."""
    r = QL.run_counts(standins.meta(spark, sf_dir), standins.emb(spark, sf_dir), review_frame(spark, sf_dir))
    return r.withColumn("is_total", F.col("is_total") == 1)


@register("extraction_quality", f"""
WITH {Q.META}, {Q.RESP}, {Q.ROUTED},
m AS (SELECT run_id, count(*) AS meta_count, count(extraction_payload) AS payload_count,
             count_if(confidence >= 0.5) AS confident_count FROM meta GROUP BY run_id),
r AS (SELECT run_id, count(*) AS review_count FROM review GROUP BY run_id)
SELECT m.run_id, m.meta_count,
       {pct_sql('m.payload_count', 'm.meta_count')} AS extraction_payload_non_null_pct,
       {pct_sql('m.confident_count', 'm.meta_count')} AS confidence_above_threshold_pct,
       {pct_sql('coalesce(r.review_count, 0)', 'm.meta_count')} AS review_queue_pct
FROM m LEFT JOIN r USING (run_id)""")
def extraction_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload present %, confidence ≥ 0.5 %, review rows % of metadata rows."""
    m = QL.meta_quality(standins.meta(spark, sf_dir))
    r = review_frame(spark, sf_dir).groupBy("run_id").agg(F.count(F.lit(1)).alias("review_count"))
    j = m.join(r, "run_id", "left")
    n = F.col("meta_count")
    return j.select("run_id", "meta_count",
                    QL.pct(F.col("payload_count"), n).alias("extraction_payload_non_null_pct"),
                    QL.pct(F.col("confident_count"), n).alias("confidence_above_threshold_pct"),
                    QL.pct(F.coalesce(F.col("review_count"), F.lit(0)), n).alias("review_queue_pct"))


@register("zero_norm_pct", f"""
WITH {Q.emb_zero(ZERO_LABEL)}
SELECT run_id, count(*) AS emb_count, CAST(count_if(list_dot_product(vector, vector) = 0) AS BIGINT) AS zero_count,
       {pct_sql("count_if(list_dot_product(vector, vector) = 0)", "count(*)")} AS zero_norm_vector_pct
FROM emb GROUP BY run_id""")
def zero_norm_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of vectors whose inner product with themselves is 0."""
    e = QL.emb_quality(standins.emb(spark, sf_dir, zero_image_label=ZERO_LABEL))
    return e.select("run_id", "emb_count", "zero_count",
                    QL.pct(F.col("zero_count"), F.col("emb_count")).alias("zero_norm_vector_pct"))


@register("distinct_counts", f"""
WITH {Q.META}
SELECT run_id, count(DISTINCT app_package) AS distinct_app_package_count,
       count(DISTINCT category) AS distinct_category_count FROM meta GROUP BY run_id""")
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct apps / categories per run (nulls ignored)."""
    return QL.meta_quality(standins.meta(spark, sf_dir)).select(
        "run_id", "distinct_app_package_count", "distinct_category_count")


@register("vector_dims", f"""
WITH {Q.EMB}
SELECT run_id,
       coalesce(avg(CASE WHEN embedding_kind = 'image' THEN len(vector) END), 0.0) AS image_vector_dims,
       coalesce(avg(CASE WHEN embedding_kind = 'text' THEN len(vector) END), 0.0) AS text_vector_dims,
       coalesce(avg(CASE WHEN embedding_kind = 'image' THEN len(vector) END), 0.0) = 512 AS image_dims_ok,
       coalesce(avg(CASE WHEN embedding_kind = 'text' THEN len(vector) END), 0.0) = 384 AS text_dims_ok
FROM emb GROUP BY run_id""")
def vector_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean dimension per modality (0.0 when absent) and the expected-dims flag."""
    e = QL.emb_quality(standins.emb(spark, sf_dir))
    return e.select("run_id", "image_vector_dims", "text_vector_dims",
                    (F.col("image_vector_dims") == QL.EXPECTED_IMAGE_DIMS).alias("image_dims_ok"),
                    (F.col("text_vector_dims") == QL.EXPECTED_TEXT_DIMS).alias("text_dims_ok"))


def _dup_meta(spark, sf_dir):
    return QL.duplicate_keys(standins.meta_with_reruns(spark, sf_dir), QL.METADATA_KEY, "screens_metadata")


def _dup_emb(spark, sf_dir):
    return QL.duplicate_keys(standins.emb_with_reruns(spark, sf_dir), QL.EMBEDDING_KEY, "screens_embeddings")


DUP_META_SQL = f"""{Q.META}, {Q.META_RERUNS},
dm AS (SELECT 'screens_metadata' AS "table", screen_id, count(*) AS count FROM meta_r
       GROUP BY screen_id HAVING count(*) > 1)"""
DUP_EMB_SQL = f"""{Q.EMB}, {Q.EMB_RERUNS},
de AS (SELECT 'screens_embeddings' AS "table", screen_id, model_name, model_version, embedding_kind,
              count(*) AS count FROM emb_r
       GROUP BY screen_id, model_name, model_version, embedding_kind HAVING count(*) > 1)"""
FINDINGS_SQL = f"""{DUP_META_SQL}, {DUP_EMB_SQL},
f AS (SELECT "table", screen_id, NULL::VARCHAR AS model_name, NULL::VARCHAR AS model_version,
             NULL::VARCHAR AS embedding_kind, count FROM dm
      UNION ALL SELECT "table", screen_id, model_name, model_version, embedding_kind, count FROM de)"""


@register("audit_dup_metadata", f"WITH {DUP_META_SQL} SELECT * FROM dm")
def audit_dup_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single-key duplicates (GROUP BY key HAVING count > 1)."""
    return _dup_meta(spark, sf_dir).select("table", "screen_id", "count")


@register("audit_dup_embeddings", f"WITH {DUP_EMB_SQL} SELECT * FROM de")
def audit_dup_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composite-key duplicates over (screen, model, version, kind)."""
    return _dup_emb(spark, sf_dir).select("table", *QL.EMBEDDING_KEY, "count")


def audit_findings_frame(spark, sf_dir):
    return QL.findings(_dup_emb(spark, sf_dir), _dup_meta(spark, sf_dir)).select(
        "table", *QL.EMBEDDING_KEY, "count")


@register("audit_findings", f"WITH {FINDINGS_SQL} SELECT * FROM f")
def audit_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of both tables in one frame, tagged by table."""
    return audit_findings_frame(spark, sf_dir)


@register("audit_result_row", f"""
WITH {FINDINGS_SQL}
SELECT 'duplicate_key_check' AS audit_name, count(*) = 0 AS passed, count(*) AS n_findings FROM f""")
def audit_result_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit's result row: flag and exact count."""
    return QL.audit_result(audit_findings_frame(spark, sf_dir)).select("audit_name", "passed", "n_findings")


@register("audit_details", f"""
WITH {FINDINGS_SQL}
SELECT 'duplicate_key_check' AS audit_name,
       '{{"table":"' || "table" || '","screen_id":' || screen_id
       || coalesce(',"model_name":"' || model_name || '","model_version":"' || model_version || '","embedding_kind":"' || embedding_kind || '"', '')
       || ',"count":' || count || '}}' AS details FROM f""")
def audit_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every finding of the audit as a JSON row, none left out."""
    return QL.audit_details(audit_findings_frame(spark, sf_dir)).select("audit_name", "details")


@register("audit_failure_stored", f"""
WITH {FINDINGS_SQL}
SELECT 'duplicate_key_check' AS audit_name, 'run-audit' AS run_id, false AS passed, count(*) AS n_findings,
       count(*) AS n_details, TIMESTAMP '2024-01-01 00:00:00' AS checked_at FROM f HAVING count(*) > 0""")
def audit_failure_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A failing audit stops the run, and its row and findings are in the log."""
    log = work_dir(spark, "audit-log")
    with contextlib.suppress(QL.AuditFailed):
        QL.run_audit(audit_findings_frame(spark, sf_dir), log, "run-audit", datetime(2024, 1, 1))
    results, details = spark.read.parquet(f"{log}/results"), spark.read.parquet(f"{log}/details")
    n = details.groupBy("run_id", "audit_name").agg(F.count(F.lit(1)).alias("n_details"))
    return results.where(~F.col("passed")).join(n, ["run_id", "audit_name"]).select(
        "audit_name", "run_id", "passed", "n_findings", "n_details", "checked_at")


@register("failed_audits", f"""
WITH {FINDINGS_SQL}, {Q.RUNS}
SELECT run_id, 'duplicate_key_check' AS audit_name, (SELECT count(*) FROM f) = 0 AS passed,
       (SELECT count(*) FROM f) AS n_findings, ended_at AS checked_at
FROM runs WHERE NOT ((SELECT count(*) FROM f) = 0)""")
def failed_audits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit log (one whole-table audit per run) filtered to failures, newest first."""
    n = audit_findings_frame(spark, sf_dir).agg(F.count(F.lit(1))).scalar()
    log = standins.runs(spark, sf_dir).select(
        "run_id", F.lit(QL.AUDIT_NAME).alias("audit_name"), (n == 0).alias("passed"), n.alias("n_findings"),
        F.col("ended_at").alias("checked_at"))
    return log.where(~F.col("passed")).orderBy(F.col("checked_at").desc())


@register("check_violations", f"""
WITH {Q.EMB},
bad AS (SELECT * FROM emb UNION ALL
        SELECT vec_id, 'hash-audio', 'v1', 'audio', embedding, 'run' || (vec_id % 3), sha256('audio:' || vec_id)
        FROM embeddings WHERE label = 9),
rl AS (SELECT 'run' || user_id AS run_id FROM events GROUP BY user_id, event_type)
SELECT 'embedding_kind_allowed' AS check_name, embedding_kind AS value, count(*) AS n FROM bad
WHERE embedding_kind NOT IN ('image', 'text') OR embedding_kind IS NULL GROUP BY embedding_kind
UNION ALL
SELECT 'run_id_unique', run_id, count(*) FROM rl GROUP BY run_id HAVING count(*) > 1""")
def check_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CHECK (kind in image/text) and UNIQUE (run id) as queries."""
    kinds = QL.disallowed_values(standins.emb_with_bad_kinds(spark, sf_dir), "embedding_kind", QL.EMBEDDING_KINDS,
                                 "embedding_kind_allowed")
    dup_runs = (QL.duplicate_keys(standins.runs_log(spark, sf_dir), ["run_id"], "pipeline_runs")
                .select(F.lit("run_id_unique").alias("check_name"), F.col("run_id").alias("value"),
                        F.col("count").alias("n")))
    return kinds.select("check_name", "value", "n").unionByName(dup_runs)


META_REQUIRED = ("png_path", "hierarchy_json_path", "run_id", "source_fingerprint")
EMB_REQUIRED = ("screen_id", "model_name", "model_version", "embedding_kind", "vector", "run_id",
                "source_fingerprint")


def _nulls_sql(cte: str, table: str, cols) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count "
        f"FROM {cte}"
        for c in cols)


@register("null_violations", f"""
WITH {Q.META}, {Q.EMB}
{_nulls_sql('meta', 'screens_metadata', META_REQUIRED)} UNION ALL {_nulls_sql('emb', 'screens_embeddings', EMB_REQUIRED)}""")
def null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NOT NULL constraints: one scan per table, one row per column."""
    m = QL.null_counts(standins.meta(spark, sf_dir), META_REQUIRED, "screens_metadata")
    e = QL.null_counts(standins.emb(spark, sf_dir), EMB_REQUIRED, "screens_embeddings")
    return m.unionByName(e).select("table", "column_name", "null_count")


@register("fk_orphans", f"""
WITH {Q.META}, {Q.EMB}, {Q.RUNS}, {Q.RESP}, {Q.ROUTED}
SELECT 'screens_metadata.run_id' AS fk, count(*) FILTER (WHERE run_id NOT IN (SELECT run_id FROM runs)) AS n_orphans FROM meta
UNION ALL SELECT 'screens_embeddings.run_id', count(*) FILTER (WHERE run_id NOT IN (SELECT run_id FROM runs)) FROM emb
UNION ALL SELECT 'screens_review_queue.run_id', count(*) FILTER (WHERE run_id NOT IN (SELECT run_id FROM runs)) FROM review
UNION ALL SELECT 'screens_embeddings.screen_id', count(*) FILTER (WHERE screen_id NOT IN (SELECT screen_id FROM meta)) FROM emb""")
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Referential checks: child rows without a parent (anti-joins)."""
    runs = standins.runs(spark, sf_dir)
    meta = standins.meta(spark, sf_dir)
    emb = standins.emb(spark, sf_dir)
    rev = review_frame(spark, sf_dir)

    def n(name, orphan_df):
        return orphan_df.agg(F.count(F.lit(1)).alias("n_orphans")).select(F.lit(name).alias("fk"), "n_orphans")

    return (n("screens_metadata.run_id", QL.orphans(meta, runs, "run_id"))
            .unionByName(n("screens_embeddings.run_id", QL.orphans(emb, runs, "run_id")))
            .unionByName(n("screens_review_queue.run_id", QL.orphans(rev, runs, "run_id")))
            .unionByName(n("screens_embeddings.screen_id", QL.orphans(emb, meta, "screen_id"))))
