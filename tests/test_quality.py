import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import quality as QL
from tessera.operators import runs as R


def test_pct_zero_guard_and_half_up(spark):
    df = spark.createDataFrame([(1, 16), (0, 0), (30, 10)], "n long, d long")
    got = [r.p for r in df.select(QL.pct(F.col("n"), F.col("d")).alias("p")).collect()]
    assert got == [6.3, 0.0, 300.0]   # 6.25 -> 6.3 (half-up, documented), guard, queue above 100 %


def test_audit_cases(spark):
    meta = spark.createDataFrame([(1,), (2,)], "screen_id long")
    assert QL.duplicate_keys(meta, ["screen_id"], "m").count() == 0
    res = QL.run_audit(QL.duplicate_keys(meta, ["screen_id"], "m"))
    assert res.collect()[0].passed
    dup = spark.createDataFrame([(i % 150,) for i in range(300)], "screen_id long")
    found = QL.duplicate_keys(dup, ["screen_id"], "m")
    row = QL.audit_result(found).collect()[0]
    assert (row.passed, row.n_findings) == (False, 150)
    with pytest.raises(QL.AuditFailed) as failed:
        QL.run_audit(found)
    assert failed.value.details.count() == 150 and not failed.value.result.first().passed


def test_composite_only_and_both(spark):
    emb = spark.createDataFrame([(1, "m", "v", "text"), (1, "m", "v", "text"), (1, "m", "v", "image")],
                                "screen_id long, model_name string, model_version string, embedding_kind string")
    meta = spark.createDataFrame([(1,), (2,)], "screen_id long")
    both = QL.findings(QL.duplicate_keys(emb, QL.EMBEDDING_KEY, "e"), QL.duplicate_keys(meta, ["screen_id"], "m"))
    assert both.count() == 1 and both.collect()[0].table == "e"


def test_null_counts_and_orphans(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "a long, b string")
    got = {r.column_name: r.null_count for r in QL.null_counts(df, ["a", "b"], "t").collect()}
    assert got == {"a": 1, "b": 1}
    parent = spark.createDataFrame([("r1",)], "run_id string")
    child = spark.createDataFrame([("r1",), ("r9",)], "run_id string")
    assert [r.run_id for r in QL.orphans(child, parent, "run_id").collect()] == ["r9"]


@pytest.mark.parametrize("meta,img,txt,tm,ti,tt,limit,status,reason", [
    (0, 0, 0, 10, 5, 5, 5, "success", "idempotent re-run — 0 new rows, 10 existing"),
    (0, 0, 0, 3, 5, 5, 5, "failed", "no metadata rows found"),
    (5, 0, 5, 5, 0, 5, 5, "failed", "no image embeddings found"),
    (5, 5, 0, 5, 5, 0, 5, "failed", "no text embeddings found"),
    (5, 0, 0, 5, 9, 9, 5, "success", "all checks passed"),   # missing here but present elsewhere
    (5, 5, 5, 5, 5, 5, 5, "success", "all checks passed"),
])
def test_status_ladder_branches(spark, meta, img, txt, tm, ti, tt, limit, status, reason):
    df = spark.createDataFrame([(meta, img, txt, tm, ti, tt, limit)],
                               "m long, i long, t long, tm long, ti long, tt long, lim int")
    s, r = R.status_ladder(*[F.col(c) for c in ("m", "i", "t", "tm", "ti", "tt", "lim")])
    row = df.select(s.alias("s"), r.alias("r"), R.status_symbol(s).alias("sym")).collect()[0]
    assert (row.s, row.r) == (status, reason)
    assert row.sym == R.STATUS_SYMBOLS[status]


def test_run_lifecycle(spark):
    start = dt.datetime(2024, 1, 1, 0, 0, 0)
    run = R.new_run(spark, "dag-1", 5, run_id="r1", started_at=start)
    closed = R.close_runs(run, spark.createDataFrame([("r1", "success", dt.datetime(2024, 1, 1, 0, 1, 30))],
                                                     "run_id string, status string, ended_at timestamp_ntz"))
    row = closed.select("status", R.duration(closed).alias("d")).collect()[0]
    assert row.status == "success" and row.d == 90.0
    unknown = R.lookup_runs(spark.createDataFrame([("zz",)], "run_id string"), closed).collect()[0]
    assert unknown.status == "unknown"
    assert spark.range(1).select(R.status_symbol(F.lit("weird")).alias("s")).collect()[0].s == R.DEFAULT_SYMBOL


def test_latest_per_key(spark):
    log = spark.createDataFrame([("r", "m", 1.0, dt.datetime(2024, 1, 1), 1),
                                 ("r", "m", 2.0, dt.datetime(2024, 1, 2), 2),
                                 ("r", "m", 3.0, dt.datetime(2024, 1, 2), 3)],
                                "run_id string, metric_name string, v double, ts timestamp_ntz, seq int")
    assert QL.latest_per_key(log, ["run_id", "metric_name"], "v", "ts", tie="seq").collect()[0].v == 3.0


def test_audit_details_json_pretty(spark):
    import json

    dup = spark.createDataFrame([(1,), (1,)], "screen_id long")
    found = QL.duplicate_keys(dup, ["screen_id"], "m")
    d = QL.audit_details(found, pretty=True).collect()[0].details
    assert "\n" in d and json.loads(d) == {"screen_id": 1, "count": 2, "table": "m"}
