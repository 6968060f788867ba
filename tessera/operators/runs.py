"""Run lifecycle: creating/closing run rows, elapsed time, the status
decision ladder and the run summary line."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values (must equal the reference's).
STATUS_SUCCESS = "success"
STATUS_FAILED = "failed"
STATUS_UNKNOWN = "unknown"
REASON_RERUN = "idempotent re-run — 0 new rows, {} existing"
REASON_NO_META = "no metadata rows found"
REASON_NO_IMAGE = "no image embeddings found"
REASON_NO_TEXT = "no text embeddings found"
REASON_OK = "all checks passed"
STATUS_SYMBOLS = {"success": ":white_check_mark:", "failed": ":x:", "audit_failed": ":rotating_light:"}
DEFAULT_SYMBOL = ":question:"
CHECK_YES = "✓"
CHECK_NO = "✗"
RULE_WIDTH = 51
STARTED_FORMAT = ":rocket: *Pipeline run started*\n  run_id: `%s`\n  LIMIT: %d\n  trigger: %s"
FINISHED_FORMAT = "%s *Pipeline run finished*\n  run_id: `%s`\n  status: *%s*\n  duration: %.1fs\n  summary: %s"
REPORT_FORMAT = (
    "\n" + "=" * RULE_WIDTH + "\n"
    "PIPELINE RUN SUMMARY  run_id=%s\n" + "=" * RULE_WIDTH + "\n"
    "STATUS          %s\n"
    "DURATION        %.1fs\n" + "-" * RULE_WIDTH + "\n"
    "DATA QUALITY\n"
    "  metadata rows        %d\n"
    "  extraction non-null  %.1f%%\n"
    "  confidence >= 0.5    %.1f%%\n"
    "  review queue         %.1f%%\n"
    "  embeddings rows      %d\n"
    "  image dims           %d  %s\n"
    "  text dims            %d  %s\n"
    "  zero-norm vectors    %.1f%%\n" + "-" * RULE_WIDTH + "\n"
    "SANITY\n"
    "  distinct apps        %d\n"
    "  distinct categories  %d\n" + "=" * RULE_WIDTH)

RUNS_SCHEMA = ("run_id string, dag_run_id string, started_at timestamp_ntz, ended_at timestamp_ntz, "
               "status string, limit_param int, git_sha string, clip_version string, sbert_version string, "
               "llm_version string, prompt_version string")


def new_run(spark: SparkSession, dag_run_id: str, limit_param: int, *, git_sha: str | None = None,
            clip_version: str | None = None, sbert_version: str | None = None, llm_version: str | None = None,
            prompt_version: str | None = None, run_id: str | None = None,
            started_at: dt.datetime | None = None) -> DataFrame:
    """One run row, values fixed once on the driver (never ``uuid()`` or
    ``now()`` inside a lazy plan: they would change on recomputation)."""
    rid = run_id or str(uuid.uuid4())
    start = started_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    row = (rid, dag_run_id, start, None, "running", int(limit_param), git_sha, clip_version, sbert_version,
           llm_version, prompt_version)
    return spark.createDataFrame([row], RUNS_SCHEMA)


def close_runs(runs: DataFrame, outcome: DataFrame) -> DataFrame:
    """Keyed update: status and end time from ``outcome(run_id, status,
    ended_at)``; runs without an outcome are kept unchanged."""
    o = outcome.select("run_id", F.col("status").alias("_status"), F.col("ended_at").alias("_ended"))
    j = runs.join(o, "run_id", "left")
    return (j.withColumn("status", F.coalesce("_status", "status"))
            .withColumn("ended_at", F.coalesce("_ended", "ended_at"))
            .drop("_status", "_ended"))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds between two naive (UTC) timestamps, microsecond exact."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1_000_000.0)


def duration(runs: DataFrame, now: dt.datetime | None = None) -> Column:
    """Elapsed seconds; an open run counts until ``now`` (fixed literal);
    no start → 0.0."""
    now_lit = F.lit(now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")
    return F.when(F.col("started_at").isNull(), F.lit(0.0)).otherwise(
        elapsed_seconds(F.col("started_at"), F.coalesce(F.col("ended_at"), now_lit)))


def lookup_runs(ids: DataFrame, runs: DataFrame, key: str = "run_id") -> DataFrame:
    """Scalar lookup of run rows by id; absent → status unknown."""
    out = ids.select(key).join(runs, key, "left")
    if "status" in runs.columns:
        out = out.withColumn("status", F.coalesce(F.col("status"), F.lit(STATUS_UNKNOWN)))
    return out


def status_ladder(meta: Column, image: Column, text: Column, total_meta: Column, total_image: Column,
                  total_text: Column, limit: Column) -> tuple[Column, Column]:
    """(status, reason) — the load step's decision ladder, first match wins.
    Totals cover the whole tables (a re-run inserts nothing but succeeds)."""
    rerun = (meta == 0) & (total_meta >= limit)
    status = (F.when(rerun, F.lit(STATUS_SUCCESS))
              .when(meta == 0, F.lit(STATUS_FAILED))
              .when((image == 0) & (total_image == 0), F.lit(STATUS_FAILED))
              .when((text == 0) & (total_text == 0), F.lit(STATUS_FAILED))
              .otherwise(F.lit(STATUS_SUCCESS)))
    pre, post = REASON_RERUN.split("{}")
    reason = (F.when(rerun, F.concat(F.lit(pre), total_meta.cast("string"), F.lit(post)))
              .when(meta == 0, F.lit(REASON_NO_META))
              .when((image == 0) & (total_image == 0), F.lit(REASON_NO_IMAGE))
              .when((text == 0) & (total_text == 0), F.lit(REASON_NO_TEXT))
              .otherwise(F.lit(REASON_OK)))
    return status, reason


def status_symbol(status: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in STATUS_SYMBOLS.items() for x in kv])
    return F.coalesce(F.try_element_at(m, status), F.lit(DEFAULT_SYMBOL))


def status_flag(status: Column) -> Column:
    return F.when(status == STATUS_SUCCESS, F.lit(1.0)).otherwise(F.lit(0.0))
