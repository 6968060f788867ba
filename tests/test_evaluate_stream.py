import numpy as np

from tessera.operators import evaluate as EV
from tessera.session import work_dir
from tessera.streaming.ingest import run_dedup_ingest


def test_next_in_order_wraps_and_spans_partitions(spark):
    ids = spark.createDataFrame([(i,) for i in [5, 1, 9, 3, 7, 11, 2]], "k long")
    got = dict(EV.next_in_order(ids, "k", partitions=3).collect())
    order = sorted([5, 1, 9, 3, 7, 11, 2])
    assert got == {a: b for a, b in zip(order, order[1:] + order[:1])}
    one = dict(EV.next_in_order(spark.createDataFrame([(4,)], "k long"), "k", partitions=3).collect())
    assert one == {4: 4}     # n = 1 holdout: the query is itself


def test_recall_hits_and_empty(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.7, 0.7])],
                              "screen_id long, vector array<float>")
    q = spark.createDataFrame([(1, 1, [1.0, 0.1]), (2, 3, [0.0, 1.0])],
                              "query_id long, expected_id long, query_vector array<double>")
    per = {r.query_id: r for r in EV.hits(q, v, 1).collect()}
    assert per[1].hit and not per[2].hit and per[2].ranked_ids == "2"
    r = EV.recall(EV.hits(q, v, 1)).collect()[0]
    assert (r.recall, r.tested, r.hits) == (0.5, 2, 1)
    none = EV.recall(EV.hits(q.limit(0), v, 1)).collect()[0]
    assert (none.recall, none.tested) == (0.0, 0)


def test_stream_ingest_is_idempotent(spark):
    base = work_dir(spark, "stream-test")
    rows = [(i, float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "event_id long, value double")
    df.where("event_id < 30").write.mode("append").parquet(f"{base}/src")
    run_dedup_ingest(spark, f"{base}/src", df.schema, ["event_id"], f"{base}/t", f"{base}/ck")
    df.where("event_id >= 20").write.mode("append").parquet(f"{base}/src")   # overlap 20..29
    run_dedup_ingest(spark, f"{base}/src", df.schema, ["event_id"], f"{base}/t", f"{base}/ck")
    # a restart with no new files changes nothing
    run_dedup_ingest(spark, f"{base}/src", df.schema, ["event_id"], f"{base}/t", f"{base}/ck")
    out = spark.read.parquet(f"{base}/t")
    assert out.count() == 50 and out.select("event_id").distinct().count() == 50
    assert np.isclose(sum(r.value for r in out.collect()), sum(v for _, v in rows))


def test_stream_keeps_new_keys_however_late(spark):
    import datetime as dt

    base = work_dir(spark, "stream-late")
    t0 = dt.datetime(2024, 1, 1)
    schema = "event_id long, ts timestamp"
    spark.createDataFrame([(i % 20, t0 + dt.timedelta(minutes=i)) for i in range(40)], schema).write.parquet(f"{base}/src")
    df = spark.read.parquet(f"{base}/src")
    run_dedup_ingest(spark, f"{base}/src", df.schema, ["event_id"], f"{base}/t", f"{base}/ck")
    # a repeat and a new key, both days older than what has been seen
    spark.createDataFrame([(3, t0 - dt.timedelta(days=9)), (99, t0 - dt.timedelta(days=9))], schema).write.mode("append").parquet(f"{base}/src")
    run_dedup_ingest(spark, f"{base}/src", df.schema, ["event_id"], f"{base}/t", f"{base}/ck")
    out = [r.event_id for r in spark.read.parquet(f"{base}/t").collect()]
    assert sorted(out) == [*range(20), 99]


def test_eval_metric_rows_long_format(spark):
    res = spark.createDataFrame([(0.75, 4, 3)], "recall double, tested long, hits long")
    rows = {r.metric_name: r for r in EV.eval_metric_rows(res, "run-x", 5, ("m", "v2")).collect()}
    assert set(rows) == {"eval_recall_at_5", "eval_screens_tested"}
    assert rows["eval_recall_at_5"].metric_value == 0.75 and rows["eval_screens_tested"].metric_value == 4.0
    assert rows["eval_screens_tested"].model_version == "v2" and rows["eval_recall_at_5"].run_id == "run-x"
    plain = EV.eval_metric_rows(res, "run-x", 5)
    assert plain.columns == ["run_id", "metric_name", "metric_value"]


def test_stream_target_check_skips_keys_already_written(spark):
    base = work_dir(spark, "stream-check")
    df = spark.createDataFrame([(i, float(i)) for i in range(30)], "event_id long, value double")
    df.where("event_id < 20").write.mode("append").parquet(f"{base}/src")
    run_dedup_ingest(spark, f"{base}/src", df.schema, ["event_id"], f"{base}/t", f"{base}/ck")
    # a new query (fresh checkpoint, no dedup state) over an overlapping drop: the target check alone dedups
    df.where("event_id >= 10").write.mode("append").parquet(f"{base}/src2")
    run_dedup_ingest(spark, f"{base}/src2", df.schema, ["event_id"], f"{base}/t", f"{base}/ck2")
    out = spark.read.parquet(f"{base}/t")
    assert out.count() == 30 and out.select("event_id").distinct().count() == 30
