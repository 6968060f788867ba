from pyspark.sql import functions as F

from tessera.operators import ingest as I
from tessera.operators import tables as TB

SCHEMA = "screen_id long, v string, arrival int"


def df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_insert_if_absent_idempotent(spark):
    target = df(spark, [(1, "old", 0)]).drop("arrival")
    src = df(spark, [(1, "new", 1), (2, "a", 1), (2, "b", 2), (3, "c", 1)])
    new_table, delta = TB.insert_if_absent(target, src, ["screen_id"], order_col="arrival")
    got = {r.screen_id: r.v for r in new_table.collect()}
    assert got == {1: "old", 2: "a", 3: "c"}          # existing key untouched, first arrival wins
    assert delta.count() == 2
    # same batch again -> nothing inserted (0 on a re-run)
    again_table, again = TB.insert_if_absent(new_table, src, ["screen_id"], order_col="arrival")
    assert again.count() == 0 and again_table.count() == 3


def test_empty_target_and_empty_source(spark):
    empty = df(spark, []).drop("arrival")
    src = df(spark, [(5, "x", 1), (5, "y", 0)])
    t, d = TB.insert_if_absent(empty, src, ["screen_id"], order_col="arrival")
    assert [r.v for r in t.collect()] == ["y"]
    t2, d2 = TB.insert_if_absent(t, df(spark, []), ["screen_id"], order_col="arrival")
    assert d2.count() == 0 and t2.count() == 1


def test_conflicts_and_strict_insert(spark):
    target = df(spark, [(1, "a", 0)]).drop("arrival")
    src = df(spark, [(1, "b", 0), (2, "c", 0)]).drop("arrival")
    assert [r.screen_id for r in TB.conflicts(target, src, ["screen_id"]).collect()] == [1]
    try:
        TB.insert_strict(target, src, ["screen_id"])
        raise AssertionError("expected InsertConflict")
    except TB.InsertConflict:
        pass
    ok = TB.insert_strict(target, src.where("screen_id = 2"), ["screen_id"])
    assert ok.count() == 2


def test_update_by_key_last_wins_and_cascade(spark):
    target = spark.createDataFrame([(1, "r1", 0.1), (2, "r1", 0.2), (3, "r2", 0.3)],
                                   "screen_id long, run_id string, conf double")
    upd = spark.createDataFrame([(1, "r1", 0.9, 1), (1, "r1", 0.8, 2), (3, "other", 0.0, 1)],
                                "screen_id long, run_id string, conf double, seq int")
    out = {r.screen_id: (r.conf, r.updated) for r in
           TB.update_by_key(target, upd, ["screen_id", "run_id"], ["conf"], order_col="seq").collect()}
    assert out == {1: (0.8, True), 2: (0.2, False), 3: (0.3, False)}
    gone = spark.createDataFrame([("r1",)], "run_id string")
    left = TB.cascade_delete({"t": target}, gone)["t"]
    assert [r.screen_id for r in left.collect()] == [3]
    assert TB.truncate(target).count() == 0


def test_bronze_defaults_only_for_absent_fields(spark):
    src = spark.createDataFrame([(1, None, b"\x00\x01"), (1, "later", b"\x02"), (2, "app", b"")],
                                "screenId long, app_package_name string, image binary")
    b = {r.screen_id: r for r in I.to_bronze(src.withColumn("t", F.monotonically_increasing_id()),
                                             "run", arrival_col="t").collect()}
    assert b[2].category == "" and b[2].hierarchy_json == "{}"      # absent -> defaults
    assert b[1].app_package == "later"                              # last write wins
    assert b[2].png_path == "screens/2.png" and b[2].hierarchy_json_path == "screens/2.json"
    src2 = spark.createDataFrame([(3, None, b"")], "screenId long, app_package_name string, image binary")
    assert I.to_bronze(src2, "run").collect()[0].app_package is None  # present null stays null


def test_upsert_latest_replaces_and_keeps(spark):
    target = df(spark, [(1, "old", 0), (2, "keep", 0)]).drop("arrival")
    src = df(spark, [(1, "a", 1), (1, "b", 2), (3, "c", 1)])
    table_, changed = TB.upsert_latest(target, src, ["screen_id"], order_col="arrival")
    assert {r.screen_id: r.v for r in table_.collect()} == {1: "b", 2: "keep", 3: "c"}
    assert changed.count() == 2


def test_touch_sets_only_the_timestamp_and_cascade_report(spark):
    import datetime as dt

    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    target = spark.createDataFrame([(1, "r1", "a", t0), (2, "r1", "b", t0), (3, "r2", "c", t0)],
                                   "screen_id long, run_id string, v string, updated_at timestamp_ntz")
    keys = spark.createDataFrame([(2,), (2,), (9,)], "screen_id long")
    got = {r.screen_id: (r.v, r.updated_at) for r in TB.touch(target, keys, ["screen_id"], "updated_at", t1).collect()}
    assert got == {1: ("a", t0), 2: ("b", t1), 3: ("c", t0)}          # repeats and unknown keys are harmless
    gone = spark.createDataFrame([("r1",), ("r1",)], "run_id string")
    rep = {r.table: (r.rows_before, r.rows_after) for r in
           TB.cascade_report({"t": target, "u": target.where("run_id = 'r2'")}, gone).collect()}
    assert rep == {"t": (3, 1), "u": (1, 1)}
