"""State of runs from their tables: counts, totals, quality, duration and
status in one wide row per run, and the texts and metric rows made of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import quality as QL
from tessera.operators import runs as R

# Fixed value (must equal the reference's).
SUMMARY_FORMAT = ("this_run: meta=%d img=%d txt=%d extracted=%d review=%d | "
                  "total: meta=%d img=%d txt=%d")


def run_state(runs: DataFrame, meta: DataFrame, emb: DataFrame, review: DataFrame) -> DataFrame:
    """One wide row per run: counts, totals, quality, duration, status.

    One aggregate per child table (partial + final, grouped by run); the
    whole-table totals are scalar subqueries over those per-run aggregates
    (a handful of rows), so no table is scanned twice for them.  Store the
    result where several consumers read it."""
    mq = QL.meta_quality(meta)
    eq = QL.emb_quality(emb)
    rq = review.groupBy("run_id").agg(F.count(F.lit(1)).alias("review_count"))
    t_meta = mq.agg(F.sum("meta_count")).scalar()
    t_emb = eq.agg(F.struct(F.sum("image_count").alias("i"), F.sum("text_count").alias("t"))).scalar()
    t_img, t_txt = t_emb["i"], t_emb["t"]
    w = runs.join(mq, "run_id", "left").join(eq, "run_id", "left").join(rq, "run_id", "left")
    zero_cols = ["meta_count", "image_count", "text_count", "review_count", "payload_count",
                 "confident_count", "distinct_app_package_count", "distinct_category_count", "emb_count",
                 "zero_count"]
    for c in zero_cols:
        w = w.withColumn(c, F.coalesce(F.col(c), F.lit(0)).cast("long"))
    for c in ("image_vector_dims", "text_vector_dims"):
        w = w.withColumn(c, F.coalesce(F.col(c), F.lit(0.0)))
    w = w.withColumn("extracted_count", F.col("payload_count"))
    status, reason = R.status_ladder(F.col("meta_count"), F.col("image_count"), F.col("text_count"),
                                     t_meta, t_img, t_txt, F.col("limit_param"))
    n = F.col("meta_count")
    return (w.withColumn("total_meta", t_meta.cast("long")).withColumn("total_image", t_img.cast("long"))
            .withColumn("total_text", t_txt.cast("long"))
            .withColumn("status", status).withColumn("reason", reason)
            .withColumn("total_run_duration_seconds", R.elapsed_seconds(F.col("started_at"), F.col("ended_at")))
            .withColumn("final_run_status", R.status_flag(F.col("status")))
            .withColumn("metadata_row_count", n)
            .withColumn("extraction_payload_non_null_pct", QL.pct(F.col("payload_count"), n))
            .withColumn("confidence_above_threshold_pct", QL.pct(F.col("confident_count"), n))
            .withColumn("review_queue_pct", QL.pct(F.col("review_count"), n))
            .withColumn("embeddings_row_count", F.col("emb_count"))
            .withColumn("zero_norm_vector_pct", QL.pct(F.col("zero_count"), F.col("emb_count"))))


def metric_rows(state: DataFrame, recorded_at) -> DataFrame:
    """The runs' metrics as log rows: ``run_id, metric_name, metric_value, recorded_at``."""
    return QL.to_long(state, QL.METRIC_NAMES).withColumn("recorded_at", F.lit(recorded_at).cast("timestamp_ntz"))


# what the summary texts need beside the metrics, logged like them
COUNT_NAMES = ("meta_count", "image_count", "text_count", "extracted_count", "review_count", "total_meta", "total_image", "total_text", "emb_count")


def log_rows(state: DataFrame, recorded_at) -> DataFrame:
    """Metrics and counts of each run as log rows, enough to write the summary from the log alone."""
    rows = QL.to_long(state, QL.METRIC_NAMES + COUNT_NAMES)
    return rows.withColumn("recorded_at", F.lit(recorded_at).cast("timestamp_ntz"))


def from_log(log: DataFrame) -> DataFrame:
    """The state that ``summary`` reads, from the newest value of each logged name: one row a run."""
    newest = QL.latest_per_key(log, ["run_id", "metric_name"], "metric_value", "recorded_at")
    wide = newest.groupBy("run_id").pivot("metric_name", list(QL.METRIC_NAMES + COUNT_NAMES)).agg(F.first("metric_value"))
    flag = F.when(F.col("final_run_status") == 1.0, F.lit(R.STATUS_SUCCESS)).otherwise(F.lit(R.STATUS_FAILED))
    return wide.withColumns({c: F.col(c).cast("long") for c in COUNT_NAMES}).withColumn("status", flag)


def summary(s: DataFrame) -> DataFrame:
    """Summary record per run."""
    return s.select(
        "run_id", "status", R.status_symbol(F.col("status")).alias("symbol"),
        F.format_string("%.1fs", F.round("total_run_duration_seconds", 1)).alias("duration"),
        F.format_string(SUMMARY_FORMAT, "meta_count", "image_count", "text_count", "extracted_count",
                        "review_count", "total_meta", "total_image", "total_text").alias("summary"),
        F.when(F.col("image_vector_dims") == QL.EXPECTED_IMAGE_DIMS, F.lit(R.CHECK_YES))
        .otherwise(F.lit(R.CHECK_NO)).alias("image_check"),
        F.when(F.col("text_vector_dims") == QL.EXPECTED_TEXT_DIMS, F.lit(R.CHECK_YES))
        .otherwise(F.lit(R.CHECK_NO)).alias("text_check"),
        (F.col("emb_count") == 2 * F.col("meta_count")).alias("emb_ratio_ok"))


def report(s: DataFrame) -> DataFrame:
    """Started / finished messages and the metrics summary block per run."""
    dur = F.round("total_run_duration_seconds", 1)

    def check(c, n):
        return F.when(F.col(c) == n, F.lit(R.CHECK_YES)).otherwise(F.lit(R.CHECK_NO))

    line = F.format_string(SUMMARY_FORMAT, "meta_count", "image_count", "text_count", "extracted_count",
                           "review_count", "total_meta", "total_image", "total_text")
    flag = F.when(F.col("final_run_status") == 1.0, F.lit(R.STATUS_SUCCESS)).otherwise(F.lit(R.STATUS_FAILED))
    return s.select(
        "run_id",
        F.format_string(R.STARTED_FORMAT, "run_id", "limit_param", F.lit("manual")).alias("started_message"),
        F.format_string(R.FINISHED_FORMAT, R.status_symbol(F.col("status")), "run_id", "status", dur,
                        line).alias("finished_message"),
        F.format_string(R.REPORT_FORMAT, "run_id", flag, dur, F.col("metadata_row_count").cast("long"),
                        "extraction_payload_non_null_pct", "confidence_above_threshold_pct", "review_queue_pct",
                        F.col("embeddings_row_count").cast("long"), F.col("image_vector_dims").cast("long"),
                        check("image_vector_dims", QL.EXPECTED_IMAGE_DIMS),
                        F.col("text_vector_dims").cast("long"), check("text_vector_dims", QL.EXPECTED_TEXT_DIMS),
                        "zero_norm_vector_pct", F.col("distinct_app_package_count").cast("long"),
                        F.col("distinct_category_count").cast("long")).alias("summary_block"))
