"""Retrieval evaluation: recall@k on a self-test and on a disjoint holdout,
with per-query detail.  All queries are evaluated in one set-based plan
(the reference issues one search per screen)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.pruned import knn_pruned
from tessera.operators.search import knn
from tessera.session import materialize


def next_in_order(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """``(key, next_key)``: the following key in ascending order, the last
    wrapping to the first — i.e. ``(i + 1) mod n`` over the ordered keys.  A null is no key.

    No single-partition window: keys are range-partitioned and sorted
    inside each partition; each task pairs neighbours in one pass, and only
    the partitions' first keys (one row per partition) cross the boundary."""
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = (df.select(F.col(key).alias("k")).where("k IS NOT NULL").distinct()
           .repartitionByRange(n_parts, "k").sortWithinPartitions("k")
           .withColumn("pid", F.spark_partition_id()))

    kind = ids.schema["k"].dataType.simpleString()

    def rows(k, following, pid, first, last):
        n = len(k)
        return pa.RecordBatch.from_arrays([k, following, pa.array([pid] * n, pa.int32()), pa.array([first] * n, k.type), pa.array([last] * n, pa.bool_())],
                                          ["k", "next_k", "pid", "first_k", "last"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pid = first = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("k")
            if held is None:
                pid, first = batch.column("pid")[0].as_py(), keys[0].as_py()
            else:
                keys = pa.concat_arrays([held, keys])
            yield rows(keys[:-1], keys[1:], pid, first, False)
            held = keys[-1:]
        if held is not None:
            yield rows(held, pa.nulls(1, held.type), pid, first, True)

    # both readers below must see one and the same range partitioning: write it once
    p = materialize(ids.mapInArrow(pairs, f"k {kind}, next_k {kind}, pid int, first_k {kind}, last boolean"), "next-in-order")
    # one row per non-empty partition: its first key; the next partition's
    # first key closes each partition's last pair (wrap to the global first)
    heads = p.where("last").select("pid", "first_k")
    w = Window.orderBy("pid")
    bounds = heads.select("pid", F.coalesce(F.lead("first_k").over(w), F.first("first_k").over(
        w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("fix"))
    out = p.join(F.broadcast(bounds), "pid", "left")
    return out.select(F.col("k").alias(key),
                      F.when(F.col("last"), F.col("fix")).otherwise(F.col("next_k")).alias(f"next_{key}"))


def ranked(queries: DataFrame, vectors: DataFrame, k: int, metric: str = "cosine", *,
           vec_id: str = "screen_id", vector: str = "vector") -> DataFrame:
    return knn(queries, vectors, k, metric, vec_id=vec_id, vector=vector)


def hits(queries: DataFrame, vectors: DataFrame, k: int, metric: str = "cosine", *,
         vec_id: str = "screen_id", vector: str = "vector", group=None, pruned: bool = False) -> DataFrame:
    """Per query: ``query_id, expected_id, hit, ranked_ids``.

    ``pruned`` searches by ``pruned.knn_pruned``: the same hits, but a query set as large as the
    index (a self-test) does not measure all pairs.  It is for one index, without ``group``.

    ``queries`` = (query_id, expected_id, query_vector).  Membership is a
    left-semi style test on (query, expected id); the ranked list is one
    bounded (k rows) group per query.  With ``group`` (columns of both
    inputs, e.g. kind / model / version) every query searches its own
    group's index and the group columns lead the result."""
    group = list(group or [])
    # the query side (often a join with the full text, e.g. the blank-text
    # filter) is read by the size check, the search and the membership join:
    # evaluate it once, into the shared work folder
    queries = materialize(queries.select(*group, "query_id", "expected_id", "query_vector"), "eval-queries")
    asked = queries.select(*group, "query_id", "query_vector")
    if pruned:
        if group:
            raise ValueError("a pruned search is for one index: leave out group")
        top, _ = knn_pruned(asked, vectors, k, metric, vec_id=vec_id, vector=vector)
    else:
        top = knn(asked, vectors, k, metric, vec_id=vec_id, vector=vector, group=group)
    exp = queries.select(*group, "query_id", "expected_id")
    g = top.groupBy(*group, "query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "id"))).alias("r"))
    j = exp.join(g, [*group, "query_id"], "left")
    ids = F.transform(F.coalesce(F.col("r"), F.array().cast("array<struct<rank:bigint,id:bigint>>")),
                      lambda e: e["id"])
    return j.select(*group, "query_id", "expected_id",
                    F.coalesce(F.array_contains(ids, F.col("expected_id")), F.lit(False)).alias("hit"),
                    F.array_join(F.transform(ids, lambda x: x.cast("string")), ",").alias("ranked_ids"))


def recall(per_query: DataFrame, by=None) -> DataFrame:
    """``recall, tested, hits`` (per ``by`` group when given); recall is 0.0
    when nothing was tested."""
    cols = [F.coalesce(F.avg(F.col("hit").cast("double")), F.lit(0.0)).alias("recall"),
            F.count(F.lit(1)).alias("tested"),
            F.count_if(F.col("hit")).alias("hits")]
    by = list(by or [])
    return per_query.groupBy(*by).agg(*cols) if by else per_query.agg(*cols)


def eval_metric_rows(result: DataFrame, run_id: str, k: int, model: tuple[str, str] | None = None) -> DataFrame:
    """The evaluation's rows for the metrics log: ``eval_recall_at_<k>`` and
    ``eval_screens_tested`` (long format, appended like the other metrics).

    With ``model`` = (name, version) of the searched index the rows carry
    ``model_name`` / ``model_version``, so appended runs form a recall
    history per model version."""
    names = [f"eval_recall_at_{k}", "eval_screens_tested"]
    wide = result.select(F.col("recall").cast("double").alias(names[0]),
                         F.col("tested").cast("double").alias(names[1]))
    rows = wide.unpivot([], names, "metric_name", "metric_value")
    cols = [F.lit(run_id).alias("run_id"), "metric_name", "metric_value"]
    if model is not None:
        cols += [F.lit(model[0]).alias("model_name"), F.lit(model[1]).alias("model_version")]
    return rows.select(*cols)
