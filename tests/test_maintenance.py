"""Versions, run partitions, counts while writing, the log pivot, gate and keyed stream."""

import time

import pytest
from pyspark.sql import functions as F

from tessera.operators import snapshots as SN
from tessera.operators import tables as TB
from tessera.session import work_dir
from tessera.sources.tables import write_parts
from tessera.streaming.gate import run_gate
from tessera.streaming.keyed import run_keyed_ingest


def rows(spark, ids):
    return spark.createDataFrame([(i, f"v{i}") for i in ids], "id long, v string")


def ids(df):
    return sorted(r.id for r in df.collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def jobs_of(spark, name, act):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        out = act()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return out, len(sc.statusTracker().getJobIdsForGroup(name))


def test_of_two_writers_one_commits_and_the_other_starts_again(spark):
    base = work_dir(spark, "versions")
    v1 = SN.commit(rows(spark, [1, 2]), base, 0)
    pinned = SN.read(spark, base, v1)
    mine, theirs = rows(spark, [1, 2, 3]), rows(spark, [1, 2, 4])
    assert SN.commit(theirs, base, v1) == 2
    with pytest.raises(SN.SnapshotConflict):
        SN.commit(mine, base, v1)
    assert SN.change(spark, base, lambda now: now.unionByName(rows(spark, [3]))) == 3
    assert ids(SN.read(spark, base)) == [1, 2, 3, 4] and ids(SN.read(spark, base, 2)) == [1, 2, 4] and ids(pinned) == [1, 2]
    with pytest.raises(LookupError):
        SN.read(spark, base, 9)


def test_change_retries_after_a_conflict(spark):
    base = work_dir(spark, "versions")
    SN.commit(rows(spark, [1]), base, 0)
    tried = []

    def add(now):
        if not tried:  # another writer commits while this one prepares
            SN.commit(now.unionByName(rows(spark, [2])), base, 1)
        tried.append(1)
        return now.unionByName(rows(spark, [3]))

    assert SN.change(spark, base, add) == 3 and len(tried) == 2
    assert ids(SN.read(spark, base)) == [1, 2, 3]


def test_scans_of_one_run_are_pruned(spark):
    df = spark.range(100).select("id", F.concat(F.lit("run"), F.col("id") % 4).alias("run_id"), F.when(F.col("id") % 2 == 0, "image").otherwise("text").alias("kind"))
    path = write_parts(df, work_dir(spark, "parts"), ("kind", "run_id"))
    one = spark.read.parquet(path).where("run_id = 'run2' AND kind = 'image'")
    pruned = plan_of(one).split("PartitionFilters: [")[1].split("]")[0]
    assert "run2" in pruned and "image" in pruned and one.count() == 25
    runs = spark.createDataFrame([("run1", 1), ("run3", 9)], "run_id string, size int").where("size > 5")
    joined = spark.read.parquet(path).join(F.broadcast(runs), "run_id")
    assert "dynamicpruning" in plan_of(joined).lower() and joined.count() == 25


def test_a_write_counts_its_rows_in_one_job(spark):
    df = rows(spark, range(50))
    counts, jobs = jobs_of(spark, "counted", lambda: TB.write_counted(df, work_dir(spark, "counted"), even=F.count_if(F.col("id") % 2 == 0)))
    assert counts == {"rows": 50, "even": 25} and jobs == 1


def test_planning_an_insert_runs_nothing_and_moves_rows_once(spark):
    target, source = rows(spark, range(5)), rows(spark, [3, 4, 5, 5, 6]).withColumn("arrival", F.monotonically_increasing_id())
    (_, delta), jobs = jobs_of(spark, "planned", lambda: TB.insert_if_absent(target, source, ["id"], order_col="arrival"))
    assert jobs == 0
    plan = plan_of(delta)
    assert plan.count("Join") == 1 and "WindowGroupLimit" in plan
    assert ids(delta) == [5, 6]


def test_a_repeated_key_is_refused(spark):
    assert ids(TB.one_per_key(rows(spark, [1, 2]), ["id"], repeated="refuse")) == [1, 2]
    with pytest.raises(Exception, match="repeated key"):
        TB.one_per_key(rows(spark, [1, 2, 2]), ["id"], repeated="refuse").select("id").collect()


def test_first_and_last_with_nulls_and_ties(spark):
    df = spark.createDataFrame([(1, None, 5), (1, "a", None), (1, "b", 5), (None, "x", 1), (None, "y", 2)], "id long, v string, at int")
    first = {r.id: r.v for r in TB.one_per_key(df, ["id"], "at").collect()}
    last = {r.id: r.v for r in TB.one_per_key(df, ["id"], "at", last=True).collect()}
    assert first == {1: "a", None: "x"} and last == {1: "b", None: "y"}


def drop(df, base):
    df.coalesce(1).write.mode("append").parquet(f"{base}/source")


def test_keyed_state_is_bounded_and_late_keys_are_neither_lost_nor_doubled(spark):
    base = work_dir(spark, "keyed")
    first, second = rows(spark, range(40)), rows(spark, range(100, 130))

    def run(df, ttl_s):
        drop(df, base)
        return run_keyed_ingest(spark, f"{base}/source", df.schema, ["id"], f"{base}/target", f"{base}/checkpoint", ttl_s)

    run(first.unionByName(first), 1)
    time.sleep(2)
    sizes = run(second, 1)
    time.sleep(2)
    sizes += run(rows(spark, [7, 100, 500]), 1)  # known keys whose state has gone, and a new one
    assert max(sizes) <= 40 + 30 and sizes[-1] <= 33, sizes
    assert ids(spark.read.parquet(f"{base}/target")) == [*range(40), *range(100, 130), 500]


def test_the_gate_keeps_findings_once_and_can_halt(spark):
    base = work_dir(spark, "gate")
    drop(rows(spark, [1, 2]), base)
    folders = run_gate(spark, f"{base}/source", rows(spark, [1]).schema, ["id"], base)
    drop(rows(spark, [2, 3, 3]), base)
    run_gate(spark, f"{base}/source", rows(spark, [1]).schema, ["id"], base)
    drop(rows(spark, [3]), base)
    run_gate(spark, f"{base}/source", rows(spark, [1]).schema, ["id"], base)
    assert ids(spark.read.parquet(folders["target"])) == [1, 2, 3]
    assert ids(spark.read.parquet(folders["quarantine"])) == [2, 3, 3]
    assert sorted((r.id, r.reason, r["count"]) for r in spark.read.parquet(folders["findings"]).collect()) == [(2, "in the target", 1), (3, "repeated in the batch", 2)]
    drop(rows(spark, [1]), base)
    with pytest.raises(Exception, match="quarantine"):
        run_gate(spark, f"{base}/source", rows(spark, [1]).schema, ["id"], base, halt=True)
