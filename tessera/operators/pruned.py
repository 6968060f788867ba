"""Exact nearest neighbours of many queries without measuring all pairs.

Every vector's distances to a few *pivots* are known.  By the triangle
inequality, a query and a vector are at least as far apart as their distances
to any pivot differ.  Vectors are cut into blocks of near ones (same nearest
pivot, similar distance to it), a block's range of distances to each pivot is
kept, and a query skips every block whose bound is beyond the k-th neighbour
that it already has:

1. pivots: far-apart rows of a bounded sample (``SAMPLE`` rows by a hash of their id);
2. blocks: range partitions by (nearest pivot, distance to it), so a crowded
   region is cut into as many blocks as it needs;
3. each query asks the block with the smallest bound and so gets a first k-th distance;
4. it asks all other blocks that could hold a nearer one, and no others.

Asking is an equi-join on the block; a block that many queries ask is repeated
for every ``query_rows`` of them, so no group is larger than a block and that.
The result is that of ``search.knn``, tie by tie: bounds only skip blocks, with a
margin for rounding, and the distances are those of ``search``.  Where vectors are
spread evenly no bound helps and all pairs are measured, as there.

Cosine distance is half the squared Euclidean distance of unit vectors, so it
has bounds too; the inner product has none (use ``knn``).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import search as S
from tessera.session import materialize, spread

SAMPLE, PIVOTS = 2_048, 16
MAX_SUMMARY_BYTES = 64 << 20
MARGIN = 1e-9
BOUNDS, ASK_ROWS = 262_144, 8_192   # entries of a table of bounds, asks (each with its vector) in one batch


@dataclass(frozen=True)
class PruneLimits:
    block_rows: int = 8_192
    query_rows: int = 32_768
    pivots: int = PIVOTS


@dataclass
class _Space:
    """What every task needs: pivots and the blocks' ranges of distances to them."""

    metric: str
    pivots: np.ndarray
    low: np.ndarray | None = None      # blocks x pivots
    high: np.ndarray | None = None
    slack: float = 0.0

    def placed(self, rows: np.ndarray) -> np.ndarray:
        """The vectors as points of a Euclidean space."""
        if self.metric == "l2":
            return rows
        norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
        return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)

    def to_pivots(self, rows: np.ndarray) -> np.ndarray:
        points = self.placed(rows)
        return np.sqrt(np.stack([((points - p) ** 2).sum(axis=1) for p in self.pivots], axis=1))

    def bounds(self, near: np.ndarray) -> np.ndarray:
        """Least possible distance of each query (rows of distances to pivots) to each block."""
        out = np.zeros((len(near), len(self.low)))
        for p in range(near.shape[1]):
            d = near[:, p:p + 1]
            np.maximum(out, self.low[None, :, p] - d, out=out)
            np.maximum(out, d - self.high[None, :, p], out=out)
        return out

    def reach(self, distance: np.ndarray) -> np.ndarray:
        """A distance of the metric as a distance between points, with the margin."""
        d = distance if self.metric == "l2" else np.sqrt(np.maximum(2.0 * distance, 0.0))
        return d + self.slack


def _far_apart(points: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows, each the farthest from those before."""
    chosen, gap = [0], np.full(len(points), np.inf)
    while len(chosen) < min(n, len(points)):
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
        if gap.max() == 0:
            break
        chosen.append(int(gap.argmax()))
    return points[chosen]


def _rows(column: pa.Array) -> np.ndarray:
    widths = set(column.value_lengths().to_pylist())
    if len(widths) > 1:
        raise ValueError(f"vector dimensions differ: {sorted(widths)}")
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _sane(vector, metric: str) -> F.Column:
    """Usable for bounds: there, finite, and with a direction where that counts."""
    squares = F.aggregate(vector, F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double"))
    ok = vector.isNotNull() & ~F.isnan(squares) & (squares < F.lit(float("inf")))
    return F.coalesce(ok & (squares > 0) if metric == "cosine" else ok, F.lit(False))


def _index(vectors: DataFrame, metric: str, limits: PruneLimits, total: int) -> tuple[DataFrame, _Space]:
    """The vectors (id, vector, block) stored by block, and the space with the blocks' ranges."""
    spark = vectors.sparkSession
    share = min(1.0, SAMPLE / total)
    sample = vectors.where(F.shiftrightunsigned(F.xxhash64("id"), 1).cast("double") <= share * float(1 << 63)).limit(2 * SAMPLE).toArrow()
    space = _Space(metric, np.zeros((0, 0)))
    space.pivots = _far_apart(space.placed(_rows(sample.column("vector").combine_chunks())), limits.pivots) if len(sample) else np.zeros((1, 0))
    if not space.pivots.size:
        first = _rows(vectors.limit(1).toArrow().column("vector").combine_chunks())
        space.pivots = space.placed(first)
    shared = spark.sparkContext.broadcast(space)

    def measure(batches):
        for batch in batches:
            if batch.num_rows:
                near = shared.value.to_pivots(_rows(batch.column("vector")))
                cell = near.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("vector"), pa.array(cell.astype(np.int32)), pa.array(near[np.arange(len(near)), cell]),
                     pa.array(list(near), pa.list_(pa.float64()))], ["id", "vector", "cell", "r", "near"])

    kind = vectors.schema["vector"].dataType.simpleString()
    measured = materialize(spread(vectors).mapInArrow(measure, f"id long, vector {kind}, cell int, r double, near array<double>"), "to-pivots")
    n = max(1, -(-total // limits.block_rows))
    held = materialize(measured.repartitionByRange(n, "cell", "r", "id").withColumn("block", F.spark_partition_id().cast("long")), "blocks")
    p = len(space.pivots)
    if 16 * p * n > MAX_SUMMARY_BYTES:
        raise ValueError(f"{n} blocks of {p} pivots exceed the bound of the summary: use larger blocks")
    sums = held.groupBy("block").agg(F.array(*[F.min(F.col("near")[k]) for k in range(p)]).alias("low"), F.array(*[F.max(F.col("near")[k]) for k in range(p)]).alias("high"))
    rows = sums.collect()  # one row a block, bounded above
    space.low, space.high = np.full((n, p), np.inf), np.full((n, p), -np.inf)  # an empty block is never asked
    for r in rows:
        space.low[r.block], space.high[r.block] = r.low, r.high
    space.slack = MARGIN * (1.0 + float(np.max([r.high for r in rows], initial=0.0)))
    return held.select("id", "vector", "block"), space


def _asks(queries: DataFrame, space: _Space, first: bool) -> DataFrame:
    """(query_id, qv, block): the block with the smallest bound, or every other one within ``reach``."""
    shared = queries.sparkSession.sparkContext.broadcast(space)

    def ask(batches):
        s = shared.value
        step = max(1, BOUNDS // max(1, len(s.low)))
        for whole in batches:
            for k in range(0, whole.num_rows, step):
                batch = whole.slice(k, step)
                bounds = s.bounds(s.to_pivots(_rows(batch.column("qv"))))
                if first:
                    at, block = np.arange(len(bounds)), bounds.argmin(axis=1)
                else:
                    kth = batch.column("kth").to_numpy(zero_copy_only=False)
                    wanted = ~(bounds > s.reach(np.where(np.isnan(kth), np.inf, kth))[:, None]) & ~np.isinf(bounds)
                    wanted[np.arange(len(bounds)), batch.column("block").to_numpy()] = False
                    at, block = np.nonzero(wanted)
                for a in range(0, len(at), ASK_ROWS):  # a query may ask every block: its vector is copied for a few at a time
                    took = pa.array(at[a:a + ASK_ROWS])
                    yield pa.RecordBatch.from_arrays([batch.column("query_id").take(took), batch.column("qv").take(took), pa.array(block[a:a + ASK_ROWS].astype(np.int64))],
                                                     ["query_id", "qv", "block"])

    return queries.mapInArrow(ask, f"query_id long, qv {queries.schema['qv'].dataType.simpleString()}, block long")


def _measured(asks: DataFrame, held: DataFrame, metric: str, k: int, limits: PruneLimits) -> DataFrame:
    """Top-k rows (g, query_id, id, distance, cls) of each query in each block it asks."""
    parts = materialize(asks.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / limits.query_rows).cast("long").alias("parts")), "asked-blocks")
    left = asks.join(F.broadcast(parts), "block").withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("parts"))).drop("parts")
    right = held.join(F.broadcast(parts), "block").select("block", "id", "vector", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))

    def one(qs: pd.DataFrame, vs: pd.DataFrame) -> pd.DataFrame:
        if not len(qs) or not len(vs):
            return S._best_frame(np.zeros(0, dtype=np.int64), S._empty_best(0))
        q, _, dim = S._stack(qs["qv"], None)
        best = S._local_topk(metric, k, q, vs["id"].to_numpy(dtype=np.int64), vs["vector"], 8_192, dim)
        return S._best_frame(qs["query_id"].to_numpy(dtype=np.int64), best)

    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(one, S.PARTIAL_SCHEMA)


def knn_pruned(queries: DataFrame, vectors: DataFrame, k: int, metric: str = "cosine", *, query_id: str = "query_id", query_vector: str = "query_vector",
               vec_id: str = "id", vector: str = "vector", limits: PruneLimits | None = None) -> tuple[DataFrame, DataFrame]:
    """(the rows of ``search.knn``, one row with how many pairs of the n_queries * n_vectors were measured).

    Null vectors, zero vectors under cosine and non-finite ones have no place between the others;
    only the k with the smallest ids of each kind can ever be hits, and they are offered to every query."""
    if metric not in ("l2", "cosine"):
        raise ValueError(f"no bounds for metric {metric!r}: use search.knn")
    limits = limits or PruneLimits()
    vec = vectors.where(F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vector"))
    asked = queries.where(F.col(query_id).isNotNull() & F.col(query_vector).isNotNull()).select(F.col(query_id).cast("long").alias("query_id"), F.col(query_vector).alias("qv"))
    sane_v, sane_q = _sane(F.col("vector"), metric), _sane(F.col("qv"), metric)
    usual = vec.where(sane_v)
    counts = vec.agg(F.count(F.lit(1)).alias("n"), F.count_if(sane_v).alias("sane")).first()
    asked = materialize(asked, "pruned-queries")

    # rows without a place: null vectors, and those whose distances are no numbers
    odd = vec.where(~sane_v).select("id", "vector", F.col("vector").isNull().alias("none"))
    kept = odd.where("none").orderBy("id").limit(k).unionByName(odd.where("NOT none").orderBy("id").limit(k)) if counts.sane < counts.n else odd.limit(0)
    offered = kept.select("id", "vector")
    partials = []
    tidy = asked.where(sane_q)
    wild = asked.where(~sane_q)
    if counts.sane < counts.n:
        partials.append(_offered(tidy, offered, metric, k))
    if not wild.isEmpty():  # every distance of such a query is the same: the smallest ids decide
        partials.append(_offered(wild, offered.unionByName(usual.orderBy("id").limit(k)), metric, k))

    measured = None
    if counts.sane:
        held, space = _index(usual, metric, limits, counts.sane)
        first = materialize(_asks(tidy, space, True), "first-asks")
        found = materialize(_measured(first, held, metric, k, limits), "first-hits")
        kth = found.where("cls = 0").groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("d"))
        known = first.join(kth, "query_id", "left").select("query_id", "qv", "block", F.when(F.col("n") >= k, F.col("d")).otherwise(float("inf")).alias("kth"))
        more = materialize(_asks(known, space, False), "more-asks")
        partials += [found, _measured(more, held, metric, k, limits)]
        sizes = held.groupBy("block").agg(F.count(F.lit(1)).alias("rows"))
        asks = first.select("block").unionAll(more.select("block")).groupBy("block").agg(F.count(F.lit(1)).alias("asks"))
        measured = asks.join(sizes, "block").agg(F.coalesce(F.sum(F.col("asks") * F.col("rows")), F.lit(0)).alias("measured"))
    spark = vectors.sparkSession
    if measured is None:
        measured = spark.createDataFrame([(0,)], "measured long")
    work = measured.select("measured", F.lit(counts.n).alias("n_vectors")).join(asked.agg(F.count(F.lit(1)).alias("n_queries")))  # one row beside one row
    union = spark.createDataFrame([], S.PARTIAL_SCHEMA)
    for p in partials:
        union = union.unionByName(p)
    return S._final_rank(union, k).drop("g"), work


def _offered(queries: DataFrame, few: DataFrame, metric: str, k: int) -> DataFrame:
    """Every query against a few vectors (3 k at most), where the queries lie."""
    rows = few.toArrow().to_pandas()
    shared = queries.sparkSession.sparkContext.broadcast(rows)

    def run(batches):
        vs = shared.value
        for qs in batches:
            if len(qs) and len(vs):
                q, _, dim = S._stack(qs["qv"], None)
                best = S._local_topk(metric, k, q, vs["id"].to_numpy(dtype=np.int64), vs["vector"], 8_192, dim)
                yield S._best_frame(qs["query_id"].to_numpy(dtype=np.int64), best)

    return queries.mapInPandas(run, S.PARTIAL_SCHEMA)
