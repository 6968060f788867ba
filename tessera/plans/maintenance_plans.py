"""Tables over their life: touch, delete-all, cascade over all six tables, versions,
run partitions, counts taken while writing, payload files, the stored metrics log,
distinct sketches, the model call, and gated / keyed streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import extract as X
from tessera.operators import quality as QL
from tessera.operators import snapshots as SN
from tessera.operators import state as ST
from tessera.operators import tables as TB
from tessera.plans import fragments as Q
from tessera.plans.extract_plans import classified, review_frame
from tessera.plans.registry import ORACLES, register
from tessera.plans.run_plans import run_state
from tessera.plans.table_plans import RETENTION_CUTOFF
from tessera.session import materialize, work_dir
from tessera.sources import standins
from tessera.sources.tables import binary_files, table, write_parts, write_texts
from tessera.streaming.gate import run_gate
from tessera.streaming.keyed import run_keyed_ingest

TOUCHED, BEFORE = "2024-03-01 12:00:00", "2024-01-01 00:00:00"
EARLY, LATE = "2024-02-01 00:00:00", "2024-02-02 00:00:00"


def _labels(spark, sf_dir):
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("screen_id"))


def _at(text: str) -> F.Column:
    return F.lit(text).cast("timestamp_ntz")


@register("touch_rows", f"""
WITH {Q.META}
SELECT screen_id, app_package, CASE WHEN screen_id IN (SELECT doc_id FROM labels) THEN TIMESTAMP '{TOUCHED}' ELSE TIMESTAMP '{BEFORE}' END AS updated_at FROM meta""")
def touch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the time stamp of the parsed (labelled) screens moves."""
    meta = standins.meta(spark, sf_dir).select("screen_id", "app_package").withColumn("updated_at", _at(BEFORE))
    return TB.touch(meta, _labels(spark, sf_dir), ["screen_id"], "updated_at", _at(TOUCHED))


@register("cascade_delete_all", f"""
WITH {Q.META}, {Q.EMB}, {Q.RUNS}, {Q.RESP}, {Q.ROUTED},
gone AS (SELECT run_id FROM runs WHERE started_at < TIMESTAMP '{RETENTION_CUTOFF}'),
metric AS ({ORACLES['metrics_long']}),
audit AS (SELECT run_id FROM meta GROUP BY run_id, app_package HAVING count(*) > 1),
every AS (SELECT 'screens_metadata' AS "table", run_id FROM meta UNION ALL SELECT 'screens_embeddings', run_id FROM emb
          UNION ALL SELECT 'screens_review_queue', run_id FROM review UNION ALL SELECT 'pipeline_runs', run_id FROM runs
          UNION ALL SELECT 'pipeline_metrics', run_id FROM metric UNION ALL SELECT 'audit_results', run_id FROM audit)
SELECT "table", count(*) AS rows_before, count(*) FILTER (WHERE run_id NOT IN (SELECT run_id FROM gone)) AS rows_after FROM every GROUP BY "table" """)
def cascade_delete_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention over all six tables that carry a run: also metrics and audit results (here one
    finding for each run and app with several screens)."""
    runs, meta = standins.runs(spark, sf_dir), standins.meta(spark, sf_dir)
    gone = runs.where(F.col("started_at") < _at(RETENTION_CUTOFF)).select("run_id")
    state = materialize(run_state(spark, sf_dir), "run-state")
    audits = QL.duplicate_keys(meta, ["run_id", "app_package"], "screens_metadata")
    tables = {"screens_metadata": meta, "screens_embeddings": standins.emb(spark, sf_dir), "screens_review_queue": review_frame(spark, sf_dir),
              "pipeline_runs": runs, "pipeline_metrics": QL.to_long(state, QL.METRIC_NAMES), "audit_results": audits}
    return TB.cascade_report(tables, gone)


@register("null_violations_found", """
SELECT 'responses' AS "table", c.column_name, c.null_count FROM (
  SELECT 'screen_id' AS column_name, count(*) FILTER (WHERE event_id IS NULL) AS null_count FROM events
  UNION ALL SELECT 'raw_output', count(*) FILTER (WHERE event_id % 8 = 4) FROM events
  UNION ALL SELECT 'error', count(*) FILTER (WHERE event_id % 8 <> 4) FROM events) c""")
def null_violations_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required values that are missing: failed calls have no output, others no error."""
    return QL.null_counts(standins.resp_hard(spark, sf_dir), ["screen_id", "raw_output", "error"], "responses").select("table", "column_name", "null_count")


@register("failed_audits_by_run", f"""
WITH {Q.META}, {Q.RUNS},
f AS (SELECT run_id, count(*) AS n FROM (SELECT run_id, app_package FROM meta GROUP BY run_id, app_package HAVING count(*) > 1) GROUP BY run_id)
SELECT runs.run_id, f.n AS n_findings, runs.ended_at AS checked_at FROM runs JOIN f USING (run_id)""")
def failed_audits_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each run's own audit: its findings counted, runs without any left out, newest first."""
    found = QL.duplicate_keys(standins.meta(spark, sf_dir), ["run_id", "app_package"], "screens_metadata")
    per = standins.runs(spark, sf_dir).join(found.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_findings")), "run_id", "left")
    log = per.select("run_id", F.coalesce("n_findings", F.lit(0)).alias("n_findings"), F.col("ended_at").alias("checked_at"))
    return log.where("n_findings > 0").orderBy(F.col("checked_at").desc())


# -- versions ------------------------------------------------------------------------------------


def _versions(spark, sf_dir) -> str:
    """A table with three versions: labelled screens; every screen; none (delete all)."""
    base = work_dir(spark, "versions")
    meta = standins.meta(spark, sf_dir).select("screen_id", "app_package", "run_id")
    v = SN.commit(meta.join(_labels(spark, sf_dir), "screen_id", "left_semi"), base, 0)
    v = SN.commit(TB.insert_if_absent(SN.read(spark, base, v), meta, ["screen_id"])[0], base, v)
    SN.commit(TB.truncate(SN.read(spark, base, v)), base, v)
    return base


@register("snapshot_older_version", f"""
WITH {Q.META}
SELECT screen_id, app_package, run_id FROM meta WHERE screen_id IN (SELECT doc_id FROM labels)""")
def snapshot_older_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader that pinned the first version still reads it after two more commits."""
    return SN.read(spark, _versions(spark, sf_dir), 1)


@register("delete_all_rows", """
SELECT 1 AS version, (SELECT count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) AS n
UNION ALL SELECT 2, (SELECT count(*) FROM documents) UNION ALL SELECT 3, 0""")
def delete_all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each version: the newest is empty (all rows deleted, schema kept), the older ones are whole."""
    base = _versions(spark, sf_dir)
    out = None
    for v in range(1, SN.current(spark, base) + 1):
        one = SN.read(spark, base, v).agg(F.count(F.lit(1)).alias("n")).select(F.lit(v).alias("version"), "n")
        out = one if out is None else out.unionByName(one)
    return out


# -- tables stored by run ------------------------------------------------------------------------


@register("run_scan_partitioned", f"""
WITH {Q.META}
SELECT screen_id, hierarchy_json_path, source_fingerprint FROM meta WHERE run_id = 'run1'""")
def run_scan_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run of a table stored by run: the scan reads that run's folder only."""
    path = write_parts(standins.meta(spark, sf_dir), work_dir(spark, "meta-by-run"))
    return spark.read.parquet(path).where(F.col("run_id") == "run1").select("screen_id", "hierarchy_json_path", "source_fingerprint")


@register("finished_runs_embeddings", f"""
WITH {Q.EMB}, {Q.RUNS}
SELECT e.run_id, embedding_kind, count(*) AS n, min(len(vector)) AS dims FROM emb e JOIN runs r USING (run_id)
WHERE embedding_kind = 'image' AND r.limit_param >= 15 GROUP BY e.run_id, embedding_kind""")
def finished_runs_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One kind, in the runs that a filter on the run table selects: static pruning by kind, dynamic by run."""
    path = write_parts(standins.emb(spark, sf_dir), work_dir(spark, "emb-by-kind"), ("embedding_kind", "run_id"))
    runs = standins.runs(spark, sf_dir).where(F.col("limit_param") >= 15).select("run_id")
    e = spark.read.parquet(path).where(F.col("embedding_kind") == "image")
    return e.join(F.broadcast(materialize(runs, "finished")), "run_id").groupBy("run_id", "embedding_kind").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.size("vector")).cast("long").alias("dims"))


# -- counts taken while writing ------------------------------------------------------------------


@register("inserted_counts", f"""
WITH {Q.META}, {Q.RESP}, {Q.ROUTED}
SELECT 'inserted' AS name, count(*) AS n FROM meta WHERE screen_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'routed', count(*) FROM routed UNION ALL SELECT 'extracted', count(*) FROM routed WHERE route = 'valid'
UNION ALL SELECT 'review', count(*) FROM routed WHERE route <> 'valid'""")
def inserted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserted and routed rows, counted by the writes themselves."""
    meta = standins.meta(spark, sf_dir)
    _, delta = TB.insert_if_absent(meta.join(_labels(spark, sf_dir), "screen_id", "left_semi"), meta, ["screen_id"])
    inserted = TB.write_counted(delta, work_dir(spark, "delta"))["rows"]
    routed = TB.write_counted(classified(spark, sf_dir), work_dir(spark, "routed"), extracted=F.count_if(F.col("route") == "valid"), review=F.count_if(F.col("route") != "valid"))
    rows = [("inserted", inserted), ("routed", routed["rows"]), ("extracted", routed["extracted"]), ("review", routed["review"])]
    return spark.createDataFrame(rows, "name string, n long")


# -- payload files -------------------------------------------------------------------------------


PAYLOADS_LISTED = 65_536  # files that the driver lists at a time


def _lots(files: dict[int, int], most: int) -> list[list[int]]:
    """Shards in lots of ``most`` files at most, a larger shard alone."""
    lots: list[list[int]] = []
    room = 0
    for shard, n in sorted(files.items()):
        if n > room:
            lots.append([])
            room = most
        lots[-1].append(shard)
        room -= n
    return lots


@register("binary_payloads", """
SELECT page_id, CAST(strlen(html) + 1 AS BIGINT) AS length, sha256(html || chr(10)) AS payload_sha256, url FROM pages""")
def binary_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload files read back as a blob source: glob, key taken from the path, joined to their rows.

    One file a page.  Creating them is the work, so all cores share it however few files hold the pages.  They are read back
    some shards at a time, because the driver lists every file, and in one task a shard, because Spark would make one for a few files."""
    pages = table(spark, sf_dir, "pages")
    folder, digests = work_dir(spark, "payloads"), work_dir(spark, "digests")
    for lot in _lots(write_texts(pages, folder, "page_id", "html"), PAYLOADS_LISTED):
        blobs = binary_files(spark, f"{folder}/shard={{{','.join(map(str, lot))}}}", "*.txt", recursive=True)
        keyed = blobs.select(F.regexp_extract("path", r"page_id=(\d+)[/.]", 1).cast("long").alias("page_id"), "length", F.sha2("content", 256).alias("payload_sha256"))
        keyed.coalesce(max(len(lot), 2 * spark.sparkContext.defaultParallelism)).write.mode("append").parquet(digests)
    return spark.read.parquet(digests).join(pages.select("page_id", "url"), "page_id").select("page_id", "length", "payload_sha256", "url")


# -- the metrics log -----------------------------------------------------------------------------


def _metrics_log(spark, sf_dir) -> DataFrame:
    """The appended log of two recordings: an early one (everything 0) and the one that counts."""
    path = work_dir(spark, "metrics-log")
    rows = ST.log_rows(run_state(spark, sf_dir), None)
    late = materialize(rows.drop("recorded_at"), "metric-rows")
    TB.append(late.withColumn("metric_value", F.lit(0.0)).withColumn("recorded_at", _at(EARLY)), path, partition_by=())
    TB.append(late.withColumn("recorded_at", _at(LATE)), path, partition_by=())
    return spark.read.parquet(path)


@register("metrics_latest_stored", f"""
SELECT run_id, metric_name, metric_value, TIMESTAMP '{LATE}' AS recorded_at FROM ({ORACLES['metrics_long']})""")
def metrics_latest_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest value per run and metric of the runs' own appended log."""
    log = _metrics_log(spark, sf_dir).where(F.col("metric_name").isin(*QL.METRIC_NAMES))
    return QL.latest_per_key(log, ["run_id", "metric_name"], "metric_value", "recorded_at")


@register("run_summary_stored", ORACLES["run_summary"])
def run_summary_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run summaries from the stored log alone, pivoted."""
    return ST.summary(ST.from_log(_metrics_log(spark, sf_dir)))


@register("distinct_sketched", f"""
WITH {Q.META}
SELECT category, count(DISTINCT source_fingerprint) AS exact, true AS within FROM meta GROUP BY category""")
def distinct_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct texts per category: sketches of each run and category are stored, then united over the
    runs; beside the exact count, and whether the estimate is within 7 % (four standard errors)."""
    meta = standins.meta(spark, sf_dir).select(F.concat_ws("/", "category", "run_id").alias("part"), "category", "source_fingerprint")
    sketches = materialize(QL.distinct_sketches(meta, ["source_fingerprint"], key="part"), "sketches")
    united = QL.united_distinct(sketches.withColumn("category", F.regexp_extract("part", "^(.*)/", 1)), ["source_fingerprint"], by=["category"])
    exact = meta.groupBy("category").agg(F.count_distinct("source_fingerprint").alias("exact"))
    off = F.abs(F.col("source_fingerprint_distinct") - F.col("exact"))
    return exact.join(united, "category").select("category", "exact", (off <= F.greatest(F.lit(1.0), F.col("exact") * 0.07)).alias("within"))


# -- the model call ------------------------------------------------------------------------------


@register("model_call", """
SELECT doc_id AS screen_id, CASE WHEN length(text) % 7 <> 0 THEN '{"title": "' || length(text) || '", "confidence": 0.9}' END AS raw_output,
       CASE WHEN length(text) % 7 = 0 THEN 'RuntimeError: no answer' END AS error,
       CASE WHEN length(text) % 7 = 0 THEN 'call_error' ELSE 'valid' END AS route FROM documents""")
def model_call(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model called in requests of eight prompts that refuses some: only the refused prompts are call
    errors, their neighbours in the request are answered."""
    def model(prompts: list[str]) -> list[str]:
        if any(len(p) % 7 == 0 for p in prompts):
            raise RuntimeError("no answer")
        return [f'{{"title": "{len(p)}", "confidence": 0.9}}' for p in prompts]

    prompts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("screen_id"), F.col("text").alias("prompt"))
    answers = materialize(X.call_model(prompts, model, key_cols=("screen_id",), request_rows=8), "answers")
    return X.classify(answers, error_col="error").select("screen_id", "raw_output", "error", "route")


# -- streams -------------------------------------------------------------------------------------

CUT_LOW, CUT_HIGH = "2024-01-15 00:00:00", "2024-01-20 00:00:00"


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


def _later(events: DataFrame, spread: bool) -> DataFrame:
    ts = F.col("ts")
    return events.where(ts >= _at(CUT_LOW)) if spread else events.where((ts >= _at(CUT_LOW)) & (ts < _at(CUT_HIGH)))


@register("stream_keyed_state", "SELECT event_id, user_id, event_type, value FROM events")
def stream_keyed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping drops, each row repeated inside its drop, the first drop again at the end, after the
    state of its keys has expired: every key once."""
    base = work_dir(spark, "keyed")
    events = _events(spark, sf_dir)
    first = events.where(F.col("ts") < _at(CUT_HIGH))
    for drop in (first.unionByName(first), _later(events, True), first):
        drop.write.mode("append").parquet(f"{base}/source")
        run_keyed_ingest(spark, f"{base}/source", events.schema, ["event_id"], f"{base}/target", f"{base}/checkpoint", ttl_s=0)
    return spark.read.parquet(f"{base}/target").select("event_id", "user_id", "event_type", "value")


@register("stream_gate", f"""
WITH late AS (SELECT * FROM events WHERE ts >= TIMESTAMP '{CUT_HIGH}'), early AS (SELECT * FROM events WHERE ts < TIMESTAMP '{CUT_HIGH}'),
again AS (SELECT * FROM events WHERE ts >= TIMESTAMP '{CUT_LOW}' AND ts < TIMESTAMP '{CUT_HIGH}'),
bought AS (SELECT * FROM events WHERE event_type = 'purchase')
SELECT 'target' AS place, CAST(NULL AS VARCHAR) AS reason, count(*) AS n, count(DISTINCT event_id) AS n_keys FROM events
UNION ALL SELECT 'quarantine', NULL, (SELECT count(*) FROM again) + 2 * (SELECT count(*) FROM bought),
                 (SELECT count(*) FROM (SELECT event_id FROM again UNION SELECT event_id FROM bought))
UNION ALL SELECT 'findings', 'in the target', (SELECT count(*) FROM again) + (SELECT count(*) FROM bought),
                 (SELECT count(*) FROM (SELECT event_id FROM again UNION SELECT event_id FROM bought))
UNION ALL SELECT 'findings', 'repeated in the batch', count(*), count(*) FROM bought""")
def stream_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four drops: clean, known keys again, clean, purchases twice.  The clean ones reach the target, the
    others the quarantine, and the findings say why."""
    base = work_dir(spark, "gate")
    events = _events(spark, sf_dir)
    bought = events.where(F.col("event_type") == "purchase")
    for drop in (events.where(F.col("ts") < _at(CUT_HIGH)), _later(events, False), events.where(F.col("ts") >= _at(CUT_HIGH)), bought.unionByName(bought)):
        drop.write.mode("append").parquet(f"{base}/source")
        folders = run_gate(spark, f"{base}/source", events.schema, ["event_id"], base)

    def rows(place):
        return spark.read.parquet(folders[place]).withColumn("place", F.lit(place))

    counted = [F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("n_keys")]
    kept = rows("target").select("place", "event_id").unionByName(rows("quarantine").select("place", "event_id"))
    found = rows("findings").groupBy("place", "reason").agg(*counted)
    return kept.groupBy("place").agg(*counted).withColumn("reason", F.lit(None).cast("string")).unionByName(found)
