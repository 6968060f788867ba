"""Composite run jobs: the stages of one run, composed from the operators.

Each job takes and returns DataFrames (the caller decides where snapshots are
written, see ``tables.write_snapshot``), so a scheduler can call them in the
same order as the reference's stages: ingest → parse → {embed, extract} →
load → audit → metrics → evaluate.  Only the run id moves between stages.
``at`` is a stage's time, fixed once on the driver (now, unless given).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import fingerprint, is_blank
from tessera.operators import embed as E
from tessera.operators import evaluate as EV
from tessera.operators import extract as X
from tessera.operators import hierarchy as H
from tessera.operators import ingest as I
from tessera.operators import quality as QL
from tessera.operators import runs as R
from tessera.operators import state as ST
from tessera.operators import tables as TB
from tessera.session import materialize

Encoder = Callable[[], Callable[[list], np.ndarray]]


def _time(at: datetime | None):
    return F.lit(at or datetime.now(UTC).replace(tzinfo=None)).cast("timestamp_ntz")


def ingest(source: DataFrame, metadata: DataFrame, run_id: str, *, limit: int | None = None,
           id_col: str = "screenId", arrival_col: str | None = None, at: datetime | None = None):
    """Bounded source read (first ``limit`` by key) → bronze rows → insert
    into the metadata table if absent.  An id that arrives twice overwrites
    its bronze object (last arrival) but keeps its first metadata row.
    Returns (metadata, bronze, delta); ``delta.count()`` is 0 on a re-run
    (existing rows keep their run id)."""
    src = source.orderBy(id_col).limit(limit) if limit else source
    bronze = I.to_bronze(src, run_id, id_col=id_col, arrival_col=arrival_col)
    first = bronze if arrival_col is None else I.to_bronze(src, run_id, id_col=id_col, arrival_col=arrival_col, keep="first")
    rows = I.metadata_rows(first).withColumn("created_at", _time(at)).withColumn("updated_at", _time(at))
    new_meta, delta = TB.insert_if_absent(metadata, rows, ["screen_id"])
    return new_meta, bronze, delta


def parse(metadata: DataFrame, bronze: DataFrame, run_id: str, *, strict: bool = False, at: datetime | None = None):
    """The run's screens → their trees (one join on the object key) → text in
    reading order, in one pass; a screen without text gets ''.  Returns
    (texts, metadata with the run's rows touched, bad records); ``strict``
    stops at the first tree that cannot be parsed."""
    mine = metadata.where(F.col("run_id") == run_id).select("screen_id", "hierarchy_json_path", "source_fingerprint")
    trees = mine.join(bronze.select("hierarchy_json_path", "hierarchy_json"), "hierarchy_json_path")
    trees = trees.select("screen_id", "hierarchy_json")
    text = H.screen_texts(trees, strict=strict)
    texts = (mine.select("screen_id", "source_fingerprint").join(text, "screen_id", "left")
             .select("screen_id", F.lit(run_id).alias("run_id"),
                     F.coalesce("text_rep", F.lit("")).alias("text_rep"),
                     F.coalesce("n_elements", F.lit(0).cast("long")).alias("n_elements"), "source_fingerprint"))
    touched = metadata
    if "updated_at" in metadata.columns:
        touched = metadata.withColumn("updated_at", F.when(F.col("run_id") == run_id, _time(at)).otherwise(F.col("updated_at")))
    return texts, touched, H.bad_records(trees)


def _encoded(inputs: DataFrame, column: str, kind: str, model: tuple[str, str], run_id: str, encoder: Encoder | None) -> DataFrame:
    """Embedding rows of ``inputs`` (screen_id and one input column)."""
    if encoder is None:
        made = E.embed_text(inputs, column, run_id, model=model) if kind == "text" else E.embed_binary(inputs, column, run_id, model=model)
        return made.withColumn("embedding_kind", F.lit(kind))
    vectors = E.embed_with(inputs, column, encoder, key="screen_id")
    about = inputs.select("screen_id", fingerprint(column).alias("source_fingerprint"))
    return vectors.join(about, "screen_id").select(
        "screen_id", F.lit(model[0]).alias("model_name"), F.lit(model[1]).alias("model_version"), F.lit(kind).alias("embedding_kind"),
        "vector", F.lit(run_id).alias("run_id"), "source_fingerprint")


def embed(texts: DataFrame, bronze: DataFrame, embeddings: DataFrame, run_id: str, *,
          text_encoder: Encoder | None = None, text_model: tuple[str, str] = E.TEXT_MODEL,
          payload_encoder: Encoder | None = None, payload_model: tuple[str, str] = E.BYTES_MODEL, at: datetime | None = None):
    """Text vectors (fingerprint of the text) and payload vectors
    (fingerprint of the bytes) of the run's screens, inserted if absent on
    the composite key.  ``*_encoder`` is any batch encoder (see
    ``embed.embed_with``); without one the built-in encoders run.  Keys that
    exist already are removed *before* encoding, and the new rows are stored,
    so each is encoded once.  Returns (embeddings, delta)."""
    payloads = bronze.join(texts.select("screen_id"), "screen_id", "left_semi")
    parts = []
    for inputs, column, kind, model, encoder in ((texts, "text_rep", "text", text_model, text_encoder),
                                                 (payloads, "payload", "image", payload_model, payload_encoder)):
        have = embeddings.where((F.col("embedding_kind") == kind) & (F.col("model_name") == model[0]) & (F.col("model_version") == model[1]))
        new = inputs.select("screen_id", column).join(have.select("screen_id"), "screen_id", "left_anti")
        parts.append(_encoded(TB.one_per_key(new, ["screen_id"]), column, kind, model, run_id, encoder))
    delta = materialize(parts[0].unionByName(parts[1]).withColumn("created_at", _time(at)), "encoded")
    columns = [c for c in embeddings.columns if c in delta.columns]
    return embeddings.unionByName(delta.select(*columns), allowMissingColumns=True), delta


def extract(texts: DataFrame, metadata: DataFrame, template: str, model: Callable[[list[str]], list[str]],
            *, min_confidence: float | None = None, timeout_s: float | None = None, request_rows: int = 1, at: datetime | None = None):
    """Prompts → model (responses and routes stored) → keyed update of the
    valid rows, review rows for the rest, with their lineage and time.
    Returns (metadata, review, route counts)."""
    prompts = X.render_prompts(texts, template, "text_rep")
    valid, review, counts = X.extract_job(prompts, model, min_confidence=min_confidence, timeout_s=timeout_s, request_rows=request_rows)
    upd = valid.select("screen_id", "run_id", F.col("body").alias("extraction_payload"), "prompt_version",
                       "confidence", _time(at).alias("updated_at"))
    columns = [c for c in ("extraction_payload", "prompt_version", "confidence", "updated_at") if c in metadata.columns]
    new_meta = TB.update_by_key(metadata, upd, ["screen_id", "run_id"], columns).drop("updated")
    return new_meta, review.withColumn("created_at", _time(at)), counts


def load(metadata: DataFrame, embeddings: DataFrame, review: DataFrame, run_id: str, limit: int,
         started_at: datetime | None = None, at: datetime | None = None) -> DataFrame:
    """Verification of one run: its counts, whole-table totals, status and
    reason (the decision ladder), duration and summary line in one row."""
    c = QL.run_counts(metadata, embeddings, review)
    mine = c.where((F.col("is_total") == 0) & (F.col("run_id") == run_id))
    tot = c.where(F.col("is_total") == 1).select(
        F.struct(F.col("meta_count").alias("m"), F.col("image_count").alias("i"),
                 F.col("text_count").alias("t"))).scalar()
    one = metadata.sparkSession.range(1).select(F.lit(run_id).alias("run_id"))
    row = one.join(mine.drop("is_total"), "run_id", "left").fillna(0)
    status, reason = R.status_ladder(F.col("meta_count"), F.col("image_count"), F.col("text_count"),
                                     tot["m"], tot["i"], tot["t"], F.lit(limit))
    total = [F.coalesce(tot[k], F.lit(0)).cast("long") for k in "mit"]
    line = F.format_string(ST.SUMMARY_FORMAT, "meta_count", "image_count", "text_count", "extracted_count", "review_count", *total)
    took = R.elapsed_seconds(F.lit(started_at).cast("timestamp_ntz"), _time(at)) if started_at else F.lit(None).cast("double")
    return row.select("*", status.alias("status"), reason.alias("reason"), took.alias("duration_seconds"), line.alias("summary"))


def audit(metadata: DataFrame, embeddings: DataFrame, log: str | None = None, run_id: str | None = None,
          at: datetime | None = None) -> DataFrame:
    """Duplicate-key circuit breaker over the whole tables: the result row and
    every finding go to ``log``, then any repeated key raises ``AuditFailed``."""
    found = QL.findings(QL.duplicate_keys(embeddings, QL.EMBEDDING_KEY, "screens_embeddings"),
                        QL.duplicate_keys(metadata, QL.METADATA_KEY, "screens_metadata"))
    return QL.run_audit(found.select("table", *QL.EMBEDDING_KEY, "count"), log, run_id, at)


def metrics(runs: DataFrame, metadata: DataFrame, embeddings: DataFrame, review: DataFrame, run_ids: list[str] | None = None,
            at: datetime | None = None):
    """The runs' twelve metrics as rows for the metrics log (``recorded_at``),
    and their summary and report texts.  The state is computed once and stored.
    Returns (metric rows, summary, report)."""
    state = ST.run_state(runs, metadata, embeddings, review)
    if run_ids is not None:
        state = state.where(F.col("run_id").isin(run_ids))
    state = materialize(state, "run-state")
    recorded = at or datetime.now(UTC).replace(tzinfo=None)
    return ST.metric_rows(state, recorded), ST.summary(state), ST.report(state)


def close_run(runs: DataFrame, run_id: str, status: str, ended_at) -> DataFrame:
    """Close one run: status (the load step's, or ``audit_failed`` when the
    caller caught ``AuditFailed``) and end time, both fixed on the driver."""
    spark = runs.sparkSession
    outcome = spark.createDataFrame([(run_id, status, ended_at)], "run_id string, status string, ended_at timestamp_ntz")
    return R.close_runs(runs, outcome)


def delete_runs(tables: dict[str, DataFrame], gone: DataFrame) -> dict[str, DataFrame]:
    """Delete runs and, by cascade, their rows in every table that has a run
    id: metadata, embeddings, review queue, audit results, metrics, runs."""
    return TB.cascade_delete(tables, gone)


def evaluate(texts: DataFrame, embeddings: DataFrame, k: int = 5, dim: int = E.TEXT_DIMS, *, encoder: Encoder | None = None,
             model: tuple[str, str] | None = None, run_id: str | None = None, at: datetime | None = None):
    """recall@k self-test: each screen with non-blank text is encoded with
    the text encoder and searched (cosine) in the text index of ``model``
    (name, version; the whole text index when not given).  With ``run_id``
    returns (recall, rows for the metrics log), else recall alone."""
    asked = texts.where(~is_blank("text_rep"))
    if encoder is None:
        q = E.with_hash_vectors(asked, "text_rep", "query_vector", dim)
    else:
        q = E.embed_with(asked, "text_rep", encoder, key="screen_id").withColumnRenamed("vector", "query_vector")
    q = q.select(F.col("screen_id").alias("query_id"), F.col("screen_id").alias("expected_id"), "query_vector")
    index = embeddings.where(F.col("embedding_kind") == "text")
    if model is not None:
        index = index.where((F.col("model_name") == model[0]) & (F.col("model_version") == model[1]))
    found = EV.recall(EV.hits(q, index.select("screen_id", "vector"), k))
    if run_id is None:
        return found
    found = materialize(found, "recall")
    return found, EV.eval_metric_rows(found, run_id, k, model).withColumn("recorded_at", _time(at))
