"""Plan shape of every registered query: no all-pairs joins, no row-at-a-time
Python, and the column pruning / bounded top-k the design relies on."""

import re

import pytest

from tessera.plans import QUERIES
from tests.conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pair_joins_and_no_row_udfs(spark, name):
    p = plan_of(QUERIES[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in p, f"{name}: {bad} in plan"


def read_schemas(p: str, table: str) -> list[str]:
    return re.findall(rf"{table}\.parquet\].*?ReadSchema: (struct<[^>]*>)", p)


def test_counts_read_only_the_columns_they_need(spark):
    p = plan_of(QUERIES["load_counts"](spark, SF_SMALL))
    docs = read_schemas(p, "documents")
    assert docs and all("text:" not in s for s in docs)          # the wide text column is pruned
    emb = read_schemas(p, "embeddings")
    assert emb and all("embedding:" not in s for s in emb)       # counts never read the vectors


def test_knn_ranks_with_bounded_group_limit(spark):
    p = plan_of(QUERIES["knn_batch"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "MapInPandas" in p
    # the vector table is scanned in place: no hash exchange below the local top-k
    below = p[p.index("MapInPandas"):]
    assert "hashpartitioning" not in below


def test_bounded_scan_is_a_top_k_not_a_sort(spark):
    p = plan_of(QUERIES["scan_limit"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p and "Sort [" not in p
