import hashlib
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators import tables as TB
from tessera.plans import QUERIES
from tessera.plans import maintenance_plans as M
from tessera.session import work_dir
from tessera.sources import tables as T
from tessera.sources.tables import bad_id_lines, binary_files, read_id_list, write_texts


def test_snapshot_never_overwrites_and_append_partitions(spark):
    base = work_dir(spark, "snap")
    df = spark.createDataFrame([(1, "r1"), (2, "r2")], "screen_id long, run_id string")
    p1 = TB.write_snapshot(df, base, 1)
    p2 = TB.write_snapshot(df.where("screen_id = 1"), base, 2)
    assert spark.read.parquet(p1).count() == 2 and spark.read.parquet(p2).count() == 1
    try:
        TB.write_snapshot(df, base, 1)
        raise AssertionError("a snapshot path must not be overwritten")
    except Exception as exc:  # noqa: BLE001
        assert "already exists" in str(exc).lower() or "path" in str(exc).lower()
    log = work_dir(spark, "log")
    TB.append(df, log)
    TB.append(df, log)
    out = spark.read.parquet(log)
    assert out.count() == 4 and out.where("run_id = 'r1'").count() == 2


def test_binary_listing_and_id_list(spark):
    base = work_dir(spark, "blobs")
    spark.createDataFrame([("a",), ("bb",)], "value string").coalesce(1).write.text(base + "/x")
    listing = binary_files(spark, base + "/x", glob="*.txt").select("path", "length").orderBy("path")
    assert listing.count() == 1 and listing.collect()[0].length == 5   # "a\nbb\n"
    ids = work_dir(spark, "ids")
    spark.createDataFrame([("# comment",), ("",), (" 7 ",), ("3",), ("7",)], "value string") \
        .coalesce(1).write.text(ids)
    assert sorted(r.id for r in read_id_list(spark, ids).collect()) == [3, 7]
    spark.createDataFrame([("x",)], "value string").write.mode("append").text(ids)
    assert [r.value for r in bad_id_lines(spark, ids).collect()] == ["x"]
    with pytest.raises(Exception, match="not an integer id"):
        read_id_list(spark, ids).collect()


def test_scale_settings_and_materialize(spark):
    from tessera.session import materialize, scale_settings

    s = scale_settings(100 * 1024 ** 4, 8000)
    assert int(s["spark.sql.shuffle.partitions"]) >= 400_000
    assert scale_settings(10, 8)["spark.sql.shuffle.partitions"] == "16"
    df = spark.range(5).selectExpr("id", "id * 2 AS v")
    m = materialize(df, "t")
    assert sorted(r.v for r in m.collect()) == [0, 2, 4, 6, 8]
    assert "parquet" in m._jdf.queryExecution().executedPlan().toString().lower()


def test_spread_runs_no_job_and_keeps_shuffled_inputs(spark):
    from pyspark.sql import functions as F

    from tessera.session import spread

    sc = spark.sparkContext
    sc.setJobGroup("spread-check", "spread must not execute anything")
    agg = spark.range(0, 1000, numPartitions=2).groupBy((F.col("id") % 7).alias("k")).count()
    out = spread(agg)
    assert out is agg                                              # shuffled input: untouched
    one = spread(spark.range(0, 1000, numPartitions=1))             # scan-only, one split: spread out
    assert sc.statusTracker().getJobIdsForGroup("spread-check") == []
    sc.setJobGroup("", "")
    assert "RoundRobinPartitioning" in one._jdf.queryExecution().executedPlan().toString()


def test_broadcast_if_small_checks_rows_and_bytes(spark):
    from tessera.session import broadcast_if_small

    keys = spark.range(0, 100).selectExpr("concat('run-', id) AS run_id")

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()

    assert hinted(broadcast_if_small(keys))
    assert not hinted(broadcast_if_small(keys, max_rows=50))        # too many rows
    assert not hinted(broadcast_if_small(keys, max_bytes=100))      # too many bytes
    assert hinted(broadcast_if_small(keys.where("false")))          # empty side: fine


def _entries(folder) -> tuple[list[str], list[str]]:
    """Folders and files below."""
    found = [(os.path.relpath(os.path.join(d, x), folder), x in names) for d, names, files in os.walk(folder) for x in names + files]
    return [x for x, is_folder in found if is_folder], sorted(x for x, is_folder in found if not is_folder)


def _blobs(spark, folder) -> dict[str, bytes]:
    return {r.path.rpartition("shard=")[2].partition("/")[2]: bytes(r.content) for r in binary_files(spark, f"{folder}/shard=*", "*.txt", recursive=True).collect()}


def test_payloads_are_one_entry_a_page(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "work_dir", lambda _, name: f"{tmp_path}/{name}")
    n = 300
    pages = spark.range(n).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), "id").alias("url"), F.concat(F.lit("<p>é\n"), "id").alias("html"))
    pages.repartition(4).write.parquet(f"{tmp_path}/in/pages.parquet")
    rows = {r.page_id: r for r in QUERIES["binary_payloads"](spark, f"{tmp_path}/in").collect()}
    folders, files = _entries(tmp_path / "payloads")
    assert sorted(int(x.rpartition("page_id=")[2].removesuffix(".txt")) for x in files) == list(range(n))  # no checksum file, none of an attempt
    assert len(folders) <= 2 * spark.sparkContext.defaultParallelism  # none a page
    for i in range(n):
        text = f"<p>é\n{i}\n".encode()
        assert tuple(rows[i]) == (i, len(text), hashlib.sha256(text).hexdigest(), f"http://h/{i}")


def test_payloads_are_listed_in_lots(spark, tmp_path, monkeypatch):
    assert M._lots({0: 2, 1: 2, 2: 9, 3: 1, 5: 3}, 4) == [[0, 1], [2], [3, 5]]
    assert M._lots({}, 4) == []
    pages = spark.range(90).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.col("id").cast("string").alias("html"))
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    listed = []
    monkeypatch.setattr(M, "PAYLOADS_LISTED", 30)
    monkeypatch.setattr(M, "binary_files", lambda spark, path, *a, **b: listed.append(f := binary_files(spark, path, *a, **b)) or f)
    rows = QUERIES["binary_payloads"](spark, str(tmp_path)).collect()
    assert sorted((r.page_id, r.length) for r in rows) == [(i, len(str(i)) + 1) for i in range(90)]
    assert len(listed) > 2 and all(len(f.inputFiles()) <= 30 for f in listed)


def test_texts_of_a_key_are_one_file(spark, tmp_path):
    rows = [(7, "a"), (8, "é"), (7, "a"), (9, None), (10, ""), (2**60, "x\r\n")]
    want = {"k=7.txt": b"a\na\n", "k=8.txt": "é\n".encode(), "k=9.txt": b"\n", "k=10.txt": b"\n", f"k={2**60}.txt": b"x\r\n\n"}
    df = spark.createDataFrame(rows, "k long, t string").repartition(3)
    files = write_texts(df, str(tmp_path / "own"), "k", "t")
    assert sum(files.values()) == 5 and _blobs(spark, tmp_path / "own") == want
    for shard, n in files.items():
        assert len(os.listdir(tmp_path / "own" / f"shard={shard}")) == n


def test_spark_writes_texts_to_other_stores(spark, tmp_path):
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.texts.link./at", f"file://{tmp_path}")
    df = spark.createDataFrame([(7, "a"), (8, "é"), (7, "a"), (9, None)], "k long, t string")
    files = write_texts(df, "viewfs://texts/at/x", "k", "t")
    got = {k.partition("/")[0]: v for k, v in _blobs(spark, "viewfs://texts/at/x").items()}
    assert sum(files.values()) == 3 and got == {"k=7": b"a\na\n", "k=8": "é\n".encode(), "k=9": b"\n"}


def test_repeated_attempts_leave_the_same_files(tmp_path):
    def batch(*rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.string(), pa.binary()), strict=True)], ["shard", "k", "t"])

    def torn():
        yield batch((3, "1", b"a"), (3, "2", b"b"))
        raise OSError("lost")

    run = T._texts(str(tmp_path), "k")
    with pytest.raises(OSError, match="lost"):
        list(run(torn()))
    assert _entries(tmp_path)[1] == ["shard=3/k=1.txt"]  # no part of the file it was at
    for _ in range(2):
        (done,) = run(iter([batch((3, "1", b"a"), (3, "2", b"b")), batch((3, "2", b"c"), (4, "5", None))]))
        assert done.to_pydict() == {"shard": [3, 4], "files": [2, 1]}
        assert [(tmp_path / x).read_bytes() for x in _entries(tmp_path)[1]] == [b"a\n", b"b\nc\n", b"\n"]


def test_texts_are_shuffled_only_for_repeated_keys_or_uneven_splits(spark):
    even = spark.range(0, 80, 1, 8)
    assert T._gathers(even, "id") == (False, 80)
    assert T._gathers(even.union(even.where("id = 5")), "id") == (True, 81)
    assert T._gathers(spark.range(0, 80, 1, 1), "id") == (True, 80)
    assert T._gathers(even.select(F.when(F.col("id") > 1, F.col("id")).alias("id")), "id") == (True, 80)
    assert T._gathers(even.where("id < 0"), "id") == (False, 0)
