import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import jobs as J
from tessera.operators import quality as QL
from tessera.session import work_dir
from tessera.sources import standins
from tests.conftest import SF_SMALL

META_SCHEMA = ("screen_id long, app_package string, category string, png_path string, hierarchy_json_path string, "
               "run_id string, source_fingerprint string")
EMB_SCHEMA = ("screen_id long, model_name string, model_version string, embedding_kind string, "
              "vector array<float>, run_id string, source_fingerprint string")


def test_full_run_and_idempotent_rerun(spark):
    trees = standins.tree(spark, SF_SMALL)
    source = trees.select(F.col("screen_id").alias("screenId"), F.lit("app").alias("app_package_name"),
                          F.col("hierarchy_json").alias("view_hierarchy"),
                          F.encode("hierarchy_json", "UTF-8").alias("image"))
    n = source.count()
    meta0 = spark.createDataFrame([], META_SCHEMA)
    meta, bronze, delta = J.ingest(source, meta0, "runA", limit=100)
    assert delta.count() == n and meta.where("category = ''").count() == n   # absent field -> default
    texts, meta, bad = J.parse(meta, bronze, "runA")
    texts = texts.cache()
    assert bad.count() == 0
    assert texts.count() == n and texts.where("text_rep = ''").count() == 0
    emb, emb_delta = J.embed(texts, bronze, spark.createDataFrame([], EMB_SCHEMA), "runA")
    assert emb_delta.count() == 2 * n

    def model(prompts):
        return [json.dumps({"title": "t", "elements": [], "confidence": 0.9}) if i % 2 == 0 else "oops"
                for i, _ in enumerate(prompts)]

    meta2 = meta.withColumn("extraction_payload", F.lit(None).cast("string")) \
        .withColumn("prompt_version", F.lit(None).cast("string")).withColumn("confidence", F.lit(None).cast("double"))
    meta3, review, counts = J.extract(texts, meta2, "Text: {hierarchy_text}", model)
    routes = {r.route: r.n for r in counts.collect()}
    assert sum(routes.values()) == n and meta3.where("extraction_payload IS NOT NULL").count() == routes["valid"]
    status = J.load(meta3, emb, review.select("screen_id", "run_id"), "runA", 100).collect()[0]
    assert (status.status, status.meta_count, status.image_count) == ("success", n, n)
    assert "meta=%d" % n in status.summary
    assert J.audit(meta3, emb).collect()[0].passed
    rec = J.evaluate(texts, emb).collect()[0]
    assert rec.tested == n and rec.recall == 1.0

    # re-run: nothing new, rows keep the old run id, the new run verifies as an idempotent re-run
    meta_b, _, delta_b = J.ingest(source, meta3, "runB", limit=100)
    assert delta_b.count() == 0
    st = J.load(meta_b, emb, review.select("screen_id", "run_id"), "runB", n).collect()[0]
    assert st.status == "success" and st.reason.startswith("idempotent re-run")
    # a duplicated key trips the breaker
    from tessera.operators import runs as R

    runs = R.new_run(spark, "dag-1", 100, run_id="runB", started_at=dt.datetime(2024, 1, 1))
    log = work_dir(spark, "audit-log")
    try:
        J.audit(meta_b.unionByName(meta_b.limit(1)), emb, log, "runB", dt.datetime(2024, 1, 1))
        raise AssertionError("expected AuditFailed")
    except QL.AuditFailed:
        stored = spark.read.parquet(f"{log}/results").collect()
        assert [(r.run_id, r.passed, r.n_findings, r.checked_at) for r in stored] == [("runB", False, 1, dt.datetime(2024, 1, 1))]
        assert spark.read.parquet(f"{log}/details").count() == 1
        runs = J.close_run(runs, "runB", "audit_failed", dt.datetime(2024, 1, 1, 0, 5))
    row = runs.select("status", R.status_symbol(F.col("status")).alias("sym"), "ended_at").collect()[0]
    assert (row.status, row.sym, row.ended_at) == ("audit_failed", ":rotating_light:", dt.datetime(2024, 1, 1, 0, 5))


def test_repeated_ids_keep_the_last_object_and_the_first_row(spark):
    rows = [(1, "first", b"a", 1), (1, "second", b"b", 2), (2, "only", b"c", 1)]
    source = spark.createDataFrame(rows, "screenId long, app_package_name string, image binary, arrival int")
    meta, bronze, delta = J.ingest(source, spark.createDataFrame([], META_SCHEMA + ", created_at timestamp_ntz"), "r", arrival_col="arrival")
    assert {r.screen_id: bytes(r.payload) for r in bronze.collect()} == {1: b"b", 2: b"c"}
    assert {r.screen_id: r.app_package for r in meta.collect()} == {1: "first", 2: "only"}
    assert meta.where("created_at IS NULL").count() == 0 and delta.count() == 2
    with pytest.raises(Exception, match="repeated key"):
        J.ingest(source, spark.createDataFrame([], META_SCHEMA), "r")[1].collect()


def test_encoders_plug_in_and_encode_each_new_row_once(spark):
    folder = work_dir(spark, "encodes")

    def make():
        import os
        import uuid

        import numpy as np
        os.makedirs(folder, exist_ok=True)

        def encode(batch):
            open(os.path.join(folder, uuid.uuid4().hex), "w").write(str(len(batch)))
            return np.array([[len(x), 1.0, 2.0] for x in batch])

        return encode

    texts = spark.createDataFrame([(i, "r", "word " * i, 1) for i in range(1, 9)], "screen_id long, run_id string, text_rep string, n_elements long")
    bronze = spark.createDataFrame([(i, bytes([i])) for i in range(1, 9)], "screen_id long, payload binary")
    have = spark.createDataFrame([(1, "m", "v", "text", [0.0, 0.0, 1.0], "old", "f")], EMB_SCHEMA)
    new, delta = J.embed(texts, bronze, have, "r", text_encoder=make, text_model=("m", "v"))
    assert new.count() == 1 + 7 + 8 and delta.count() == 15
    import os
    assert sum(int(open(os.path.join(folder, f)).read()) for f in os.listdir(folder)) == 7
    again, none = J.embed(texts, bronze, new, "r2", text_encoder=make, text_model=("m", "v"))
    assert none.count() == 0 and again.count() == new.count()
    found, rows = J.evaluate(texts, new, k=1, encoder=make, model=("m", "v"), run_id="r")
    assert found.first().tested == 8
    assert {r.metric_name for r in rows.collect()} == {"eval_recall_at_1", "eval_screens_tested"} and "recorded_at" in rows.columns


def test_extraction_sets_lineage_and_times(spark):
    at = dt.datetime(2024, 5, 1)
    texts = spark.createDataFrame([(1, "r", "a", "f1"), (2, "r", "b", "f2")], "screen_id long, run_id string, text_rep string, source_fingerprint string")
    meta = spark.createDataFrame([(1, "r", None, None, None, None), (2, "r", None, None, None, None)],
                                 "screen_id long, run_id string, extraction_payload string, prompt_version string, confidence double, updated_at timestamp_ntz")
    new, review, _ = J.extract(texts, meta, "{hierarchy_text}", lambda p: ['{"confidence": 1}' if p == ["a"] else "no"], at=at)
    assert {r.screen_id: r.updated_at for r in new.collect()} == {1: at, 2: None}
    row = review.collect()[0]
    assert (row.screen_id, row.source_fingerprint, row.created_at) == (2, "f2", at) and "JSONDecodeError" in row.detail


def test_metrics_of_user_tables_feed_the_latest_view(spark):
    from tessera.operators import runs as R

    runs = R.new_run(spark, "d", 2, run_id="r", started_at=dt.datetime(2024, 1, 1))
    runs = J.close_run(runs, "r", "success", dt.datetime(2024, 1, 1, 0, 1))
    meta = spark.createDataFrame([(1, "a", "c", "r", "{}", 0.9), (2, "b", "c", "r", None, None)],
                                 "screen_id long, app_package string, category string, run_id string, extraction_payload string, confidence double")
    emb = spark.createDataFrame([(1, "m", "v", k, [1.0, 0.0], "r", "f") for k in ("image", "text")], EMB_SCHEMA)
    review = spark.createDataFrame([(2, "r")], "screen_id long, run_id string")
    rows, summary, report = J.metrics(runs, meta, emb, review, ["r"], at=dt.datetime(2024, 1, 2))
    later, *_ = J.metrics(runs, meta, emb, review.limit(0), ["r"], at=dt.datetime(2024, 1, 3))
    latest = {r.metric_name: r.metric_value for r in QL.latest_per_key(rows.unionByName(later), ["run_id", "metric_name"], "metric_value", "recorded_at").collect()}
    assert set(latest) == set(QL.METRIC_NAMES)
    assert latest["metadata_row_count"] == 2 and latest["review_queue_pct"] == 0 and latest["total_run_duration_seconds"] == 60
    assert summary.first().status == "success" and report.count() == 1
    log = rows.withColumn("run_id", F.lit("r"))
    left = J.delete_runs({"pipeline_metrics": log, "audit_results": log, "runs": runs}, runs.select("run_id"))
    assert all(t.count() == 0 for t in left.values())
