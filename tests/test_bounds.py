"""Memory of Python tasks and number of tasks: bounded whatever the sizes."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators import embed as E
from tessera.operators import pruned as P
from tessera.operators import search as S
from tessera.sources.tables import binary_files


def test_encoder_gets_bounded_parts(spark):
    df = spark.range(0, 6_000, 1, 1).select(F.col("id").alias("screen_id"), F.array_repeat(F.lit("w"), 200).alias("tokens"))

    def make():
        def encode(lists):
            if len(lists) > 1_024 or sum(map(len, lists)) > 262_144:
                raise ValueError("too much at once")
            return np.array([[float(len(x))] for x in lists])

        return encode

    assert E.embed_with(df, "tokens", make, normalize=False).where("vector[0] = 200").count() == 6_000


def test_parts_cover_the_column():
    lists = pa.array([["a"] * n for n in (5, 0, 900, 3, 3)] + [None, ["b"]])
    parts = list(E._parts(lists, values=8, rows=3))
    assert [n for _, n in parts] == [2, 1, 3, 1]
    assert [at for at, _ in parts] == [0, 2, 3, 6]


def test_buckets_forget(monkeypatch):
    monkeypatch.setattr(E, "KNOWN_TOKENS", 10)
    known = E.Buckets(7)
    assert [known[f"t{i}"] for i in range(50)] == [E.bucket(f"t{i}", 7) for i in range(50)]
    assert len(known) <= 10
    assert known.counted([["x", "x"], None, []]).sum() == 2


def test_hash_vectors_equal_over_parts(spark, monkeypatch):
    df = spark.createDataFrame([(i, " ".join(f"w{j % (i + 1)}" for j in range(i))) for i in range(40)] + [(99, None)], "id long, text string")
    whole = {r.id: r.v for r in E.with_hash_vectors(df, "text", "v", 8).collect()}
    for i in range(40):
        counts = np.bincount([E.bucket(f"w{j % (i + 1)}", 8) for j in range(i)], minlength=8).astype(float)
        norm = np.sqrt((counts * counts).sum())
        assert np.allclose(whole[i], counts / norm if norm else counts)
    assert whole[99] is None


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
def test_search_holds_little(metric):
    rng = np.random.default_rng(0)
    q, v = rng.normal(size=(1_000, 16)), pd.Series(list(rng.normal(size=(8_192, 16)).astype(np.float32)))
    tracemalloc.start()
    S._local_topk(metric, 5, q, np.arange(8_192), v, 8_192, 16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
@pytest.mark.parametrize("kind", ["spread", "ties", "scales", "odd", "near"])
def test_pieces_equal_brute_force(metric, kind):
    rng = np.random.default_rng(5)
    n, d, k = 900, 4, 3
    v = rng.normal(size=(n, d))
    if kind == "ties":
        v = np.round(v)[rng.integers(0, 40, n)]
    elif kind == "scales":
        v *= 10.0 ** rng.integers(-160, 150, size=(n, 1))
    elif kind == "odd":
        v[::5] = 0
        v[::7, 0] = np.nan
        v[::11, 1] = np.inf
    elif kind == "near":
        v = 1 + 1e-8 * v
    ids, q = rng.permutation(n).astype(np.int64), v[:24].copy()
    with np.errstate(all="ignore"):
        best = S._local_topk(metric, k, q, ids, pd.Series(list(v)), 700, d)
        for row in range(len(q)):
            dist = S._exact(metric, q[row][None], v)
            nan = np.isnan(dist)
            order = np.lexsort((ids, np.where(nan, 0.0, dist), nan))[:k]
            assert best[2][row].tolist() == ids[order].tolist()


def test_asks_copy_few_vectors_at_a_time():
    blocks, seen = 60, []
    space = P._Space("l2", np.zeros((1, 2)), np.zeros((blocks, 1)), np.full((blocks, 1), 9.0))
    n = 1_000
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array([[0.5, 0.5]] * n, pa.list_(pa.float64())), pa.array(np.zeros(n, np.int64)), pa.array(np.full(n, np.inf))],
                                       ["query_id", "qv", "block", "kth"])
    context = SimpleNamespace(broadcast=lambda x: SimpleNamespace(value=x))
    queries = SimpleNamespace(sparkSession=SimpleNamespace(sparkContext=context), schema={"qv": SimpleNamespace(dataType=SimpleNamespace(simpleString=lambda: "array<double>"))},
                              mapInArrow=lambda run, _: seen.extend(b.num_rows for b in run([batch])))
    P._asks(queries, space, False)
    assert sum(seen) == n * (blocks - 1)
    assert max(seen) <= 8_192


def test_blocked_search_has_a_task_a_cell(spark):
    v = spark.range(60).select("id", F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vector"))
    q = v.select(F.col("id").alias("query_id"), F.col("vector").alias("query_vector"))
    hits = S.knn(q, v, 2, "l2", strategy="blocked", limits=S.SearchLimits(query_block_rows=10, vector_block_rows=10))
    assert "REPARTITION_BY_NUM" in hits._jdf.queryExecution().executedPlan().toString()
    assert hits.where("rank = 1 AND id = query_id").count() == 60


def test_files_of_nested_folders(spark, tmp_path):
    for shard, page in ((0, 7), (1, 8), (1, 9)):
        folder = tmp_path / f"shard={shard}" / f"page_id={page}"
        folder.mkdir(parents=True)
        (folder / "x.txt").write_text(str(page))
    found = binary_files(spark, f"{tmp_path}/shard=*", "*.txt", recursive=True)
    assert found.columns == ["path", "modificationTime", "length", "content"]
    assert sorted(bytes(r.content) for r in found.collect()) == [b"7", b"8", b"9"]
