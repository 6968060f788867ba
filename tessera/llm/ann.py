"""Operator 7 — approximate nearest neighbours by learned partitions.

On a bounded sample (about ``SAMPLE`` vectors that take part, twice as many at most, by a hash) the
exact neighbour graph is built and cut into balanced parts: recursive bisection
by the graph's slowest mode at the median, refined by swaps that lower the cut.
A softmax classifier learns, for a vector, where its sample neighbours lie.  It
places every row of the table in its most probable part and routes a query to
several most probable parts; how many is the smallest number that reaches
``TARGET`` recall on the sample (sparser than the table, so neighbours are farther
and the figure errs to the safe side).  The parts grow with the rows: as many as leave
``PART_SAMPLE`` sample vectors each, ``PARTS`` at most (one part below ``LEAST`` vectors).

All rows are indexed.  Parts are cut into cells of bounded size by a hash of the
id and the row's place in its task, so a part (or a vector or an id that a third of the
rows share) is spread over many tasks; queries go to all cells of their parts, packed by
part in blocks of bounded size, so rows are copied for queries that ask their part only.  Within
a cell candidates are ranked by the exact Euclidean distance in double precision,
ties by smaller id; only each query's best of a cell is shuffled.  A query whose
parts hold too few rows is given further parts until ``k`` candidates are met.

Defined cases: vectors that are null, zero, hold null or non-finite components, or
have another length than most, and rows without an id, take no part; ids occurring twice are
one query (the vector with the smallest hash), and never candidates of themselves; an empty table
gives no rows; only the id and vector columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import sample_by_hash, stored

SAMPLE = 8192
PARTS, PART_SAMPLE, LEAST = 512, 4, 64
TARGET = 0.94
CELL, QUERIES = 20_000, 10_000  # rows and queries met in one task's group
GRAPH_K = 10


@dataclass
class Router:
    """A softmax classifier over parts, and the number of parts to probe."""

    weights: np.ndarray  # (dims + 1, parts)
    probes: int
    dims: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        return unit @ self.weights[:-1] + self.weights[-1]


def matrix(column: pa.Array, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, vectors in double precision) of the vectors that take part."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
    if dims is None:
        some = lengths[lengths > 0]
        dims = int(np.bincount(some).argmax()) if len(some) else 0
    rows = np.flatnonzero(lengths == dims) if dims else np.zeros(0, np.int64)
    flat = pc.fill_null(column.take(pa.array(rows)).flatten().cast(pa.float64()), float("nan"))
    x = np.asarray(flat).reshape(len(rows), dims)
    good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
    return rows[good], x[good]


def takes_part(v: F.Column) -> F.Column:
    """The same rule as an expression (but for the length): there, finite, not zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def neighbours(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k nearest other rows of each row."""
    k = min(k, len(x) - 1)
    norms, out = (x * x).sum(axis=1), np.zeros((len(x), k), np.int64)
    for a in range(0, len(x), 1024):
        d = norms[None, :] - 2 * x[a: a + 1024] @ x.T
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        out[a: a + 1024] = np.argpartition(d, k - 1, axis=1)[:, :k] if k else out[a: a + 1024]
    return out


def _bisect(src: np.ndarray, dst: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """Side (bool) of each of ``n`` nodes: halves of equal size with few edges between them."""
    degree = np.maximum(np.bincount(src, minlength=n), 1)
    v = rng.standard_normal(n)
    for _ in range(60):  # slowest mode of the walk on the graph, the constant one taken out
        v = v + np.bincount(src, weights=v[dst], minlength=n) / degree
        v -= (v * degree).sum() / degree.sum()
        v /= np.linalg.norm(v) + 1e-300
    side = np.zeros(n, bool)
    side[np.argsort(v, kind="stable")[n // 2:]] = True
    for _ in range(20):  # swap the nodes that gain most by moving, as many from either side
        gain = np.bincount(src, weights=np.where(side[src] != side[dst], 1.0, -1.0), minlength=n)
        a, b = np.flatnonzero(side), np.flatnonzero(~side)
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        m = min(len(a), len(b))
        swaps = int((gain[a[:m]] + gain[b[:m]] > 2).sum()) // 2
        if not swaps:
            break
        cut = (side[src] != side[dst]).sum()
        trial = side.copy()
        trial[a[:swaps]], trial[b[:swaps]] = False, True
        if (trial[src] != trial[dst]).sum() >= cut:
            break
        side = trial
    return side


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 0) -> np.ndarray:
    """Part of each node: ``parts`` (a power of two) parts of equal size, by recursive bisection."""
    n, rng = len(graph), np.random.default_rng(seed)
    src, dst = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    src, dst = np.concatenate([src, dst]), np.concatenate([dst, src])
    part = np.zeros(n, np.int64)
    level = 1
    while level < parts:
        new = part * 2
        for p in range(level):
            members = np.flatnonzero(part == p)
            local = np.full(n, -1)
            local[members] = np.arange(len(members))
            inside = (part[src] == p) & (part[dst] == p)
            new[members] += _bisect(local[src[inside]], local[dst[inside]], len(members), rng)
        part, level = new, level * 2
    return part


def fit(x: np.ndarray, parts: int = PARTS, target: float = TARGET, k: int = GRAPH_K, seed: int = 0) -> Router:
    """Router from sample vectors."""
    n, dims = x.shape
    while parts > 1 and n < max(LEAST, PART_SAMPLE * parts):
        parts //= 2
    if parts <= 1 or n <= k:
        return Router(np.zeros((dims + 1, 1)), 1, dims)
    graph = neighbours(x, k)
    part = balanced_parts(graph, parts, seed)
    wanted = np.zeros((n, parts))  # half its own part, half its neighbours'
    np.add.at(wanted, (np.repeat(np.arange(n), graph.shape[1]), part[graph].ravel()), 0.5 / graph.shape[1])
    wanted[np.arange(n), part] += 0.5
    unit = np.hstack([x / np.linalg.norm(x, axis=1, keepdims=True), np.ones((n, 1))]).astype(np.float32)
    wanted = wanted.astype(np.float32)
    w, m, v = (np.zeros((dims + 1, parts), np.float32) for _ in range(3))
    for step in range(1, 301):  # Adam on the cross-entropy
        p = unit @ w
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        p -= wanted
        g = unit.T @ p / n + 1e-5 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    router = Router(w.astype(float), 1, dims)
    scores = router.scores(x)
    placed = scores.argmax(axis=1)
    rank = (-scores).argsort(axis=1).argsort(axis=1)  # place of each part in each row's order
    depth = rank[np.arange(n)[:, None], placed[graph]]
    reached = np.array([(depth < probes).mean() for probes in range(1, parts + 1)])
    router.probes = int(np.argmax(reached >= target)) + 1 if (reached >= target).any() else parts
    return router


def _best(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int):
    """(query id, id, distance) of the k nearest rows of each query, its own id left out."""
    norms = (x * x).sum(axis=1)
    scale = norms.max(initial=0.0)
    step = max(1, 4_000_000 // max(1, len(x)))
    for a in range(0, len(q), step):
        rough = norms[None, :] - 2 * q[a: a + step] @ x.T
        for i, row in enumerate(rough):
            own = ids == q_ids[a + i]
            row[own] = np.inf
            here = len(row) - int(own.sum())
            if not here:
                continue
            kth = np.partition(row, min(k, here) - 1)[min(k, here) - 1]
            # rounding of the rough form cannot hide a nearer row behind this margin
            near = np.flatnonzero(row <= kth + 1e-9 * (scale + 1e-300))
            near = near[~own[near]]
            exact = np.sqrt(((x[near] - q[a + i]) ** 2).sum(axis=1))
            order = np.lexsort((ids[near], exact))[:k]
            yield np.full(len(order), q_ids[a + i]), ids[near[order]], exact[order]


def search(vectors: DataFrame, is_query, k: int = 10, parts: int = PARTS, target: float = TARGET, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows found for every row where ``is_query``
    (a boolean Column of ``vectors``) holds."""
    spark = vectors.sparkSession
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")).where("id IS NOT NULL")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    usable = rows.where(takes_part(F.col("v")))
    lengths = usable.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return empty
    usable = usable.where(F.size("v") == lengths.d)
    pick = sample_by_hash(usable.withColumn("pick", F.struct("id", "v")), "pick", SAMPLE).select("id", "v").toArrow()
    if not pick.num_rows:  # many equal rows whose hash is not among the chosen: one of them, and so one part
        pick = usable.select("id", "v").limit(1).toArrow()
    _, x = matrix(pick.sort_by("id").column("v").combine_chunks(), lengths.d)
    router = fit(x, parts, target)

    def place(batches):
        seen = 0
        for batch in batches:
            at, x = matrix(batch.column("v"), router.dims)
            if len(at):
                part = router.scores(x).argmax(axis=1).astype(np.int32)
                rows = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(part), pa.array(np.arange(seen, seen + len(at)))], ["id", "v", "q", "part", "nth"])
                seen += len(at)

    kind = rows.schema["v"].dataType.simpleString()
    placed = stored(rows.mapInArrow(place, f"id long, v {kind}, q boolean, part int, nth long"), "placed")
    sizes = {r.part: r.n for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each part

    def route(batches):
        for batch in batches:
            _, x = matrix(batch.column("v"), router.dims)  # all of them take part
            parts = []
            for by_odds in (-router.scores(x)).argsort(axis=1, kind="stable").tolist() if len(x) else []:
                met = np.cumsum([sizes.get(p, 0) for p in by_odds])
                depth = max(router.probes, int(np.searchsorted(met, k, side="right")) + 1)
                parts.append([p for p in by_odds[:depth] if p in sizes])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(parts, pa.list_(pa.int32()))], ["id", "v", "parts"])

    one = placed.where("q").groupBy("id").agg(F.min_by("v", F.xxhash64("v")).alias("v"))
    routed = stored(one.select("id", "v").mapInArrow(route, f"id long, v {kind}, parts array<int>"), "routed")
    asking = routed.select(F.explode("parts").alias("part")).groupBy("part").count().collect()  # a row for each part
    if not asking:
        return empty
    layout = F.broadcast(spark.createDataFrame([(r.part, -(-sizes[r.part] // CELL), -(-r["count"] // QUERIES)) for r in asking], "part int, cells int, blocks int"))

    def each(n: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    asked = (routed.select("id", "v", F.explode("parts").alias("part")).join(layout, "part")
             .select("id", "v", "part", F.pmod(F.xxhash64("id", "part"), F.col("blocks")).cast("int").alias("block"), each("cells").alias("cell")))
    held = (placed.join(layout, "part")
            .select("id", "v", "part", F.pmod(F.xxhash64("id", "nth"), F.col("cells")).cast("int").alias("cell"), each("blocks").alias("block")))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            qa, q = matrix(left.column("v").combine_chunks(), router.dims)
            xa, x = matrix(right.column("v").combine_chunks(), router.dims)
            found = list(_best(q, np.asarray(left.column("id"))[qa], x, np.asarray(right.column("id"))[xa], k))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    keys = ["part", "cell", "block"]
    best = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(compare, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
