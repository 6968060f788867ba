import numpy as np
import pytest

from tessera.operators.search import SearchLimits, knn, search


def brute(q, v, k, metric):
    out = {}
    for qi, qv in q.items():
        res = []
        for vi, vv in v.items():
            if vv is None:
                continue
            a, b = np.asarray(qv, float), np.asarray(vv, float)
            if metric == "l2":
                d = float(np.sqrt(((a - b) ** 2).sum()))
            elif metric == "ip":
                d = float(-(a @ b))
            else:
                den = np.linalg.norm(a) * np.linalg.norm(b)
                d = float("nan") if den == 0 else float(1 - (a @ b) / den)
            res.append((1 if np.isnan(d) else 0, d if not np.isnan(d) else 0.0, vi))
        res.sort()
        out[qi] = [r[2] for r in res[:k]]
    return out


def frames(spark, q, v):
    qs = spark.createDataFrame([(i, [float(x) for x in x_]) for i, x_ in q.items()],
                               "query_id long, query_vector array<double>")
    vs = spark.createDataFrame([(i, None if x_ is None else [float(x) for x in x_]) for i, x_ in v.items()],
                               "id long, vector array<float>")
    return qs, vs


@pytest.mark.parametrize("metric", ["l2", "cosine", "ip"])
@pytest.mark.parametrize("strategy", ["broadcast", "blocked"])
def test_knn_matches_brute_force(spark, metric, strategy):
    rng = np.random.default_rng(7)
    q = {i: rng.normal(size=8).round(3).tolist() for i in range(13)}
    v = {i: rng.normal(size=8).round(3).tolist() for i in range(100, 160)}
    qs, vs = frames(spark, q, v)
    lim = SearchLimits(query_block_rows=4, vector_block_rows=16, chunk_rows=7)
    got = knn(qs, vs, 5, metric, limits=lim, strategy=strategy).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append(r.id)
    assert by == brute(q, v, 5, metric)


def test_edge_vectors(spark):
    q = {1: [1.0, 0.0]}
    v = {10: [0.0, 0.0], 11: [2.0, 0.0], 12: [2.0, 0.0], 13: None}
    qs, vs = frames(spark, q, v)
    rows = sorted(knn(qs, vs, 10, "cosine").collect(), key=lambda r: r.rank)
    # equal distances -> id order; zero vector NaN after numbers; null vector last; k > table
    assert [r.id for r in rows] == [11, 12, 10, 13]
    assert np.isnan(rows[2].distance) and rows[3].distance is None


def test_one_dimension_and_prefix_property(spark):
    q = {1: [0.5]}
    v = {i: [float(i)] for i in range(20)}
    qs, vs = frames(spark, q, v)
    k3 = [r.id for r in sorted(knn(qs, vs, 3, "l2").collect(), key=lambda r: r.rank)]
    k4 = [r.id for r in sorted(knn(qs, vs, 4, "l2").collect(), key=lambda r: r.rank)]
    assert k4[:3] == k3 == [0, 1, 2]


def test_dimension_mismatch_raises(spark):
    qs, vs = frames(spark, {1: [1.0, 2.0]}, {1: [1.0, 2.0, 3.0]})
    with pytest.raises(Exception, match="dimensions differ"):
        knn(qs, vs, 1, "l2").collect()


def test_vectors_without_metadata_do_not_use_up_k(spark):
    q = {1: [1.0, 0.0]}
    v = {1: [1.0, 0.0], 2: [0.9, 0.1], 3: [0.0, 1.0]}
    qs, vs = frames(spark, q, v)
    vs = vs.withColumnRenamed("id", "screen_id")
    meta = spark.createDataFrame([(1, "a"), (3, "c")], "screen_id long, app string")
    got = sorted(search(qs, vs, 2, "cosine", metadata=meta).collect(), key=lambda r: r.rank)
    assert [r.screen_id for r in got] == [1, 3]


@pytest.mark.parametrize("metric", ["l2", "cosine", "ip"])
def test_kernel_budget_chunks_and_ties(monkeypatch, metric):
    import pandas as pd

    from tessera.operators import search as S

    monkeypatch.setattr(S, "DIST_BUDGET", 7)          # force many query sub-blocks
    rng = np.random.default_rng(3)
    q = rng.integers(-2, 3, size=(9, 3)).astype(float)
    q[0] = 0.0                                          # zero query -> all NaN for cosine
    vecs = [rng.integers(-2, 3, size=3).astype(float) for _ in range(40)]
    vecs[5] = np.zeros(3)
    ids = rng.permutation(np.arange(100, 140))
    series = pd.Series([None if i % 13 == 0 else v for i, v in enumerate(vecs)])
    best = S._local_topk(metric, 4, q, ids.astype(np.int64), series, chunk_rows=6, dim=3)
    got = S._best_frame(np.arange(9), best)
    want = brute({i: q[i] for i in range(9)},
                 {int(ids[j]): (None if j % 13 == 0 else vecs[j]) for j in range(40)}, 4, metric)
    for qi in range(9):
        rows = got[got.query_id == qi]
        nonnull = [int(x) for x, c in zip(rows.id, rows.cls) if c != 2]
        assert nonnull == want[qi][:len(nonnull)]
        assert len(rows) == 4


@pytest.mark.parametrize("nq,nv,par", [(2000, 2000, 8), (10**6, 10**6, 8000), (100, 10**8, 8000),
                                       (10**7, 10**5, 8000), (5, 3, 8), (1, 1, 64)])
def test_block_grid_bounds(nq, nv, par):
    from tessera.operators.search import block_grid

    bq, bv = block_grid(nq, nv, 32768, 32768, par)
    assert -(-nq // bq) <= 32768 and -(-nv // bv) <= 32768       # every block within its bound
    assert bq * bv >= min(par, nq * nv)                           # enough cells for the cluster
    # never more copies than the unbalanced grid with the same cell count
    assert nq * bv + nv * bq <= nq * (bq * bv) + nv


@pytest.mark.parametrize("strategy", ["broadcast", "blocked"])
def test_grouped_knn_searches_each_index_alone(spark, strategy):
    """Two indexes with different dimensions, queries sharing ids across
    groups: each query must only see its own group's vectors."""
    rng = np.random.default_rng(11)
    groups = {("text", "v1"): 6, ("image", "v2"): 3}
    qrows, vrows, want = [], [], {}
    for (kind, ver), dim in groups.items():
        q = {i: rng.normal(size=dim).round(3).tolist() for i in range(7)}
        v = {i: rng.normal(size=dim).round(3).tolist() for i in range(50, 90)}
        qrows += [(kind, ver, i, x) for i, x in q.items()]
        vrows += [(kind, ver, i, x) for i, x in v.items()]
        want.update({(kind, ver, qi): ids for qi, ids in brute(q, v, 4, "l2").items()})
    qs = spark.createDataFrame(qrows, "kind string, ver string, query_id long, query_vector array<double>")
    vs = spark.createDataFrame(vrows, "kind string, ver string, id long, vector array<double>")
    lim = SearchLimits(query_block_rows=3, vector_block_rows=16, chunk_rows=5)
    got = knn(qs, vs, 4, "l2", limits=lim, strategy=strategy, group=["kind", "ver"])
    assert got.columns == ["kind", "ver", "query_id", "id", "distance", "rank"]
    by = {}
    for r in sorted(got.collect(), key=lambda r: (r.kind, r.ver, r.query_id, r.rank)):
        by.setdefault((r.kind, r.ver, r.query_id), []).append(r.id)
    assert by == want


def test_strategies_agree_on_the_embeddings_table(spark):
    """Metamorphic: the broadcast scan and the co-grouped blocks give the
    same ranked lists over the whole (driver-generated) vector table."""
    from pyspark.sql import functions as F

    from tests.conftest import SF_SMALL

    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    q = e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    v = e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    lim = SearchLimits(query_block_rows=128, vector_block_rows=200)

    def ranked(strategy):
        return sorted((r.query_id, r.rank, r.id, r.distance)
                      for r in knn(q, v, 5, "cosine", limits=lim, strategy=strategy).collect())

    a = ranked("broadcast")
    assert len(a) == 5 * e.count() and a == ranked("blocked")


@pytest.mark.parametrize("strategy", ["broadcast", "blocked"])
@pytest.mark.parametrize("metric,q,v,best", [
    ("l2", [0.0, 0.0], {1: [9e-8, 0], 2: [5e-8, 0], 3: [1e-8, 0], 4: [0, 0]}, [4, 3]),
    ("cosine", [1.0, 0.0], {1: [1, 1e-3], 2: [1, 5e-4], 3: [1, 1e-4], 4: [1, 0]}, [4, 3]),
    ("ip", [1e-4, 0.0], {1: [1e-4, 0], 2: [2e-4, 0], 3: [3e-4, 0], 4: [3e-4, 0]}, [3, 4]),
])
def test_neighbours_closer_than_what_is_shown(spark, metric, q, v, best, strategy):
    qs, vs = frames(spark, {1: q}, v)
    vs = spark.createDataFrame([(i, [float(x) for x in x_]) for i, x_ in v.items()], "id long, vector array<double>")
    got = knn(qs, vs, 2, metric, strategy=strategy).orderBy("rank").collect()
    assert [r.id for r in got] == best


def test_many_ties_at_the_cut(spark):
    v = {i: [1.0, 1.0] for i in range(200)} | {500: [1.0, 1.0 + 1e-12]}
    qs, _ = frames(spark, {1: [1.0, 1.0 + 1e-12]}, {1: [0.0, 0.0]})
    vs = spark.createDataFrame([(i, x) for i, x in v.items()], "id long, vector array<double>")
    for strategy in ("broadcast", "blocked"):
        got = knn(qs, vs, 4, "l2", strategy=strategy).orderBy("rank").collect()
        assert [r.id for r in got] == [500, 0, 1, 2]


def test_broadcast_bound_counts_partial_rows(spark):
    qs, vs = frames(spark, {i: [1.0, 2.0] for i in range(30)}, {i: [1.0, float(i)] for i in range(5)})
    with pytest.raises(ValueError, match="broadcast bounds"):
        knn(qs, vs, 10, "l2", strategy="broadcast", limits=SearchLimits(max_partial_rows=100))
    assert knn(qs, vs, 10, "l2", limits=SearchLimits(max_partial_rows=100)).count() == 150
