"""Pruned search: the same rows as the full search, with fewer pairs measured."""

import numpy as np
import pytest

from tessera.operators.pruned import PruneLimits, knn_pruned
from tessera.operators.search import knn


def frames(spark, q, v):
    rows = [(int(i), None if x is None else [float(c) for c in x]) for i, x in v]
    asked = [(int(i), [float(c) for c in x]) for i, x in q]
    return spark.createDataFrame(asked, "query_id long, query_vector array<double>"), spark.createDataFrame(rows, "id long, vector array<double>")


def same(spark, q, v, k, metric, limits):
    qs, vs = frames(spark, q, v)
    got, work = knn_pruned(qs, vs, k, metric, limits=limits)
    def order(df):
        return sorted((r.query_id, r.rank, r.id, "nan" if r.distance is not None and np.isnan(r.distance) else r.distance) for r in df.collect())
    assert order(got) == order(knn(qs, vs, k, metric))
    w = work.first()
    assert w.n_queries == len(q) and w.n_vectors == len(v)
    return w.measured


def clustered(rng, n, clusters, spread, dim=6):
    centres = rng.normal(size=(clusters, dim)) * 10
    return centres[rng.integers(0, clusters, n)] + rng.normal(size=(n, dim)) * spread


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_equal_to_the_full_search_and_fewer_pairs_when_clustered(spark, metric):
    rng = np.random.default_rng(5)
    limits = PruneLimits(block_rows=32, query_rows=64, pivots=8)
    share = []
    for spread in (20.0, 1.0, 0.05):
        v = list(enumerate(clustered(rng, 600, 12, spread)))
        share.append(same(spark, v, v, 4, metric, limits) / 600**2)
    assert share[0] > share[1] > share[2] and share[2] < 0.2, share


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_ties_copies_nulls_zeros(spark, metric):
    rng = np.random.default_rng(6)
    v = [(k, x) for k, x in enumerate(clustered(rng, 60, 3, 0.3))]
    v += [(100 + k, v[0][1]) for k in range(50)]  # a group of copies larger than a block
    v += [(200, None), (201, None), (202, np.zeros(6)), (203, np.zeros(6))]
    q = [v[0], v[7], (900, np.zeros(6)), (901, rng.normal(size=6) * 100)]
    limits = PruneLimits(block_rows=16, query_rows=2, pivots=4)
    same(spark, q, v, 5, metric, limits)
    same(spark, q, v[:3] + v[-4:], 6, metric, limits)  # more asked for than there are
    same(spark, q, v[-4:], 3, metric, limits)
    same(spark, q, [], 3, metric, limits)


def test_no_bounds_for_inner_products(spark):
    qs, vs = frames(spark, [(1, [1.0])], [(1, [1.0])])
    with pytest.raises(ValueError, match="no bounds"):
        knn_pruned(qs, vs, 1, "ip")
