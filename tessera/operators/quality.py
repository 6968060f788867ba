"""Data-quality operators: duplicate-key audit (circuit breaker), constraint
checks, per-run counts, quality metrics and their long format.

Everything is a grouped aggregate (partial + final, so hot keys are
pre-aggregated before the shuffle) or an anti/semi join.  An audit's findings
are kept as rows, all of them; its result row holds their exact count.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import vectors as V
from tessera.operators.tables import append
from tessera.session import broadcast_if_small, materialize

# Fixed values (must equal the reference's).
AUDIT_NAME = "duplicate_key_check"
EXPECTED_IMAGE_DIMS = 512
EXPECTED_TEXT_DIMS = 384
CONFIDENCE_THRESHOLD = 0.5
METADATA_KEY = ("screen_id",)
EMBEDDING_KEY = ("screen_id", "model_name", "model_version", "embedding_kind")
EMBEDDING_KINDS = ("image", "text")
METRIC_NAMES = (
    "total_run_duration_seconds", "final_run_status", "metadata_row_count", "extraction_payload_non_null_pct",
    "confidence_above_threshold_pct", "review_queue_pct", "embeddings_row_count", "image_vector_dims",
    "text_vector_dims", "zero_norm_vector_pct", "distinct_app_package_count", "distinct_category_count",
)


class AuditFailed(RuntimeError):
    """Raised on the driver when the duplicate audit finds keys.  ``result``
    and ``details`` are the audit's row and its findings."""

    def __init__(self, message: str, result: DataFrame | None = None, details: DataFrame | None = None):
        super().__init__(message)
        self.result, self.details = result, details


def pct(num: Column, den: Column) -> Column:
    """100·num/den rounded to 1 decimal (half-up), 0.0 when den is 0."""
    return F.when(den > 0, F.round(F.lit(100.0) * num / den, 1)).otherwise(F.lit(0.0))


def duplicate_keys(df: DataFrame, keys, table_name: str) -> DataFrame:
    """Keys present more than once (GROUP BY … HAVING count > 1)."""
    keys = list(keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
            .where(F.col("count") > 1)
            .withColumn("table", F.lit(table_name)))


def findings(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _stamped(df: DataFrame, run_id: str | None, checked_at) -> DataFrame:
    return df.withColumn("run_id", F.lit(run_id).cast("string")).withColumn("checked_at", F.lit(checked_at).cast("timestamp_ntz"))


def audit_details(found: DataFrame, audit_name: str = AUDIT_NAME, run_id: str | None = None, checked_at=None,
                  pretty: bool = False) -> DataFrame:
    """Every finding as a row: ``audit_name, details`` (JSON) ``, run_id, checked_at``."""
    details = F.to_json(F.struct(*found.columns), {"pretty": "true"} if pretty else None)
    return _stamped(found.select(F.lit(audit_name).alias("audit_name"), details.alias("details")), run_id, checked_at)


def audit_result(found: DataFrame, audit_name: str = AUDIT_NAME, run_id: str | None = None, checked_at=None) -> DataFrame:
    """One row: ``audit_name, passed, n_findings, run_id, checked_at``."""
    n = found.agg(F.count(F.lit(1)).alias("n_findings"))
    return _stamped(n.select(F.lit(audit_name).alias("audit_name"), (F.col("n_findings") == 0).alias("passed"), "n_findings"), run_id, checked_at)


def run_audit(found: DataFrame, log: str | None = None, run_id: str | None = None, checked_at=None) -> DataFrame:
    """Circuit breaker.  The findings are computed once; the result row and
    all findings are appended to the tables ``results`` and ``details`` under
    ``log`` (when given) *before* a failure raises ``AuditFailed``, which
    carries both frames as well.  Returns the result row."""
    checked_at = checked_at or datetime.now(UTC).replace(tzinfo=None)
    kept = materialize(found, "findings")
    result, details = audit_result(kept, run_id=run_id, checked_at=checked_at), audit_details(kept, run_id=run_id, checked_at=checked_at)
    if log:
        append(result, f"{log}/results")
        append(details, f"{log}/details")
    n = result.first()["n_findings"]
    if n:
        raise AuditFailed(f"AUDIT FAILED: {n} duplicate key(s) detected — pipeline halted", result, details)
    return result


def disallowed_values(df: DataFrame, column: str, allowed, check_name: str) -> DataFrame:
    """Rows breaking an allowed-value CHECK, counted per offending value."""
    return (df.where(~F.col(column).isin(*allowed) | F.col(column).isNull())
            .groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("check_name", F.lit(check_name)))


def null_counts(df: DataFrame, required, table_name: str) -> DataFrame:
    """One scan: ``count_if(col IS NULL)`` per required column, as rows."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return (agg.unpivot([], list(required), "column_name", "null_count")
            .withColumn("table", F.lit(table_name)))


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None,
            max_broadcast_keys: int = 1_000_000) -> DataFrame:
    """Child rows whose key has no parent row (referential check).

    The parent key set (e.g. run ids) is broadcast when its size is checked
    small, so a child key holding a third of the rows is never sorted into
    one task; a large key set falls back to a shuffled anti join (AQE splits
    skewed partitions)."""
    pk = parent_key or key
    keys = parent.select(F.col(pk).alias(key)).distinct()
    return child.join(broadcast_if_small(keys, max_broadcast_keys), key, "left_anti")


def run_counts(meta: DataFrame, emb: DataFrame, review: DataFrame) -> DataFrame:
    """Per-run counts *and* whole-table totals in one aggregation.

    One union of narrow projections, one ``rollup(run_id)``: the row with
    a null run id holds the totals (the reference's "total" counts)."""
    zero = F.lit(0).cast("long")
    one = F.lit(1).cast("long")
    m = meta.select("run_id", one.alias("meta"), F.col("extraction_payload").isNotNull().cast("long").alias("extracted"),
                    zero.alias("image"), zero.alias("text"), zero.alias("review"))
    e = emb.select("run_id", zero.alias("meta"), zero.alias("extracted"),
                   (F.col("embedding_kind") == "image").cast("long").alias("image"),
                   (F.col("embedding_kind") == "text").cast("long").alias("text"), zero.alias("review"))
    r = review.select("run_id", zero.alias("meta"), zero.alias("extracted"), zero.alias("image"), zero.alias("text"),
                      one.alias("review"))
    u = m.unionByName(e).unionByName(r)
    return (u.rollup("run_id")
            .agg(*[F.sum(c).cast("long").alias(f"{c}_count") for c in ("meta", "image", "text", "review",
                                                                         "extracted")],
                 F.grouping("run_id").alias("is_total")))


def meta_quality(meta: DataFrame) -> DataFrame:
    """Per-run metadata counts: rows, payload present, confidence ≥ 0.5,
    distinct apps / categories (exact, nulls ignored)."""
    return meta.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("meta_count"),
        F.count_if(F.col("extraction_payload").isNotNull()).alias("payload_count"),
        F.count_if(F.col("confidence") >= CONFIDENCE_THRESHOLD).alias("confident_count"),
        F.count_distinct("app_package").alias("distinct_app_package_count"),
        F.count_distinct("category").alias("distinct_category_count"),
    )


SKETCH_BITS = 12  # 4,096 registers: a standard error of about 1.6 %


def distinct_sketches(df: DataFrame, columns, key: str = "run_id", bits: int = SKETCH_BITS) -> DataFrame:
    """Per ``key`` a HyperLogLog sketch of each column (``<column>_sketch``, opt-in): unlike exact
    counts, sketches of runs can be stored and united later."""
    return df.groupBy(key).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(bits)).alias(f"{c}_sketch") for c in columns])


def united_distinct(sketches: DataFrame, columns, by=()) -> DataFrame:
    """Approximate distinct counts (``<column>_distinct``) over the runs of each ``by`` (all runs without)."""
    return sketches.groupBy(*by).agg(*[F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(f"{c}_distinct") for c in columns])


def emb_quality(emb: DataFrame) -> DataFrame:
    """Per-run embedding counts, mean dims per kind (0.0 when none), zero
    vectors (inner product with itself is 0)."""
    kind = F.col("embedding_kind")
    return emb.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("emb_count"),
        F.count_if(kind == "image").alias("image_count"),
        F.count_if(kind == "text").alias("text_count"),
        F.coalesce(F.avg(F.when(kind == "image", V.dims("vector"))), F.lit(0.0)).alias("image_vector_dims"),
        F.coalesce(F.avg(F.when(kind == "text", V.dims("vector"))), F.lit(0.0)).alias("text_vector_dims"),
        F.count_if(V.is_zero_vector("vector")).alias("zero_count"),
    )


def to_long(wide: DataFrame, names, key: str = "run_id") -> DataFrame:
    """Wide metrics → ``(run_id, metric_name, metric_value double)``."""
    cols = [F.col(n).cast("double").alias(n) for n in names]
    return wide.select(key, *cols).unpivot([key], list(names), "metric_name", "metric_value")


def latest_per_key(log: DataFrame, keys, value: str, ts: str, tie: str | None = None) -> DataFrame:
    """Newest value per key (re-runs append; the last write wins).

    ``max_by`` is a plain aggregate: partial per task, no sort, no window."""
    # without a tie column, equal timestamps are broken by the value itself (deterministic on recomputation)
    order = F.struct(F.col(ts), F.col(tie)) if tie else F.struct(F.col(ts), F.col(value))
    return log.groupBy(*keys).agg(F.max_by(F.col(value), order).alias(value), F.max(ts).alias(ts))
