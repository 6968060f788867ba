"""Exact nearest-neighbour search (L2, cosine, negative inner product).

Plan shape — no cross join, no pair rows:

* **broadcast path** (query set of checked, bounded size): the query matrix is
  shipped once to every task; each vector partition is scanned in place
  (no shuffle of the vector table), candidates come from a blocked matrix
  product in numpy, and each task emits only its local top-k per query.  The only
  shuffle is those partial top-k rows, ranked again with ``row_number``
  (which Spark plans as ``WindowGroupLimit`` partial + final).
* **blocked path** (large query sets, e.g. a self-test over the whole
  table): queries and vectors are hashed into blocks, each query block is
  co-grouped with each vector block (an equi-join on the block key, every
  group bounded by the block sizes), and again only local top-k rows leave
  the task.

Ranking is deterministic: the full double-precision distance, then id
ascending; only the distance that is shown is rounded.  A matrix product
proposes candidates with a margin for its rounding; their distances are then
computed pair by pair in one fixed order of summation, so equal vectors have
equal distances.  Order classes follow the reference store: numbers, then NaN
(zero-norm cosine), then null vectors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.vectors import METRICS
from tessera.session import broadcast_if_small, spread

PARTIAL_SCHEMA = "g string, query_id long, id long, distance double, cls int"
ROUND = 6                           # decimals of the distance shown; ranking uses all of it


@dataclass
class SearchLimits:
    """Size guards.  The broadcast path is used only below both bounds."""

    max_broadcast_queries: int = 50_000
    # every Python worker of an executor holds its own copy: keep it small
    max_broadcast_bytes: int = 64 * 1024 * 1024
    max_partial_rows: int = 1_000_000          # queries x k: rows that one task may emit
    query_block_rows: int = 32_768
    vector_block_rows: int = 32_768
    chunk_rows: int = 8_192


def block_grid(nq: int, nv: int, max_q: int, max_v: int, parallelism: int) -> tuple[int, int]:
    """Number of query and vector blocks for the co-grouped path.

    Every query row is copied once per vector block and every vector once
    per query block, so the shuffle carries ``nq·bv + nv·bq`` rows.  Blocks
    are as large as the bounds allow; the grid has at least ``parallelism``
    cells (one task per cell), split in the ratio that minimises the copies
    (``bq / bv = nq / nv``)."""
    bq0 = max(1, math.ceil(nq / max_q))
    bv0 = max(1, math.ceil(nv / max_v))
    cells = max(bq0 * bv0, min(parallelism, max(1, nq) * max(1, nv)))
    bq = max(bq0, min(max(1, nq), round(math.sqrt(cells * max(1, nq) / max(1, nv)))))
    bv = max(bv0, math.ceil(cells / bq))
    return bq, bv


def _stack(series: pd.Series, dim: int | None):
    """Stack a Series of arrays into a float64 matrix.

    Returns (matrix, valid_mask, dim).  Null vectors are masked out; a
    dimension different from the others raises (the reference store raises
    too; silently padding would give wrong distances)."""
    valid = series.notna().to_numpy()
    rows = [np.asarray(v, dtype=np.float64) for v in series[valid]]
    if rows:
        lens = {r.shape[0] for r in rows}
        if dim is not None:
            lens.add(dim)
        if len(lens) != 1:
            raise ValueError(f"vector dimensions differ: {sorted(lens)}")
        dim = lens.pop()
        mat = np.vstack(rows) if rows else np.zeros((0, dim))
    else:
        mat = np.zeros((0, dim or 0))
    return mat, valid, dim


def _exact(metric: str, q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Distance of every pair along the last axis (broadcast over the others),
    each summed in the same order."""
    if metric == "l2":
        return np.sqrt(((q - v) ** 2).sum(-1))
    dots = (q * v).sum(-1)
    if metric == "ip":
        return -dots
    if metric == "cosine":
        norms = np.sqrt((q * q).sum(-1)) * np.sqrt((v * v).sum(-1))
        with np.errstate(divide="ignore", invalid="ignore"):
            d = 1.0 - dots / norms
        return np.where(norms == 0, np.nan, d)
    raise ValueError(f"unknown metric {metric!r}; expected one of {METRICS}")


def _proposed(metric: str, q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, margin): a matrix product that orders vectors like the metric
    up to ``margin`` (a column, one per query); NaN where cosine is undefined."""
    dots = q @ v.T
    eps = 8.0 * (q.shape[1] + 8) * np.finfo(np.float64).eps
    qq, vv = (q * q).sum(1), (v * v).sum(1)
    if metric == "ip":
        return -dots, eps * np.sqrt(qq[:, None] * vv.max(initial=0.0))
    if metric == "l2":
        return qq[:, None] + vv[None, :] - 2.0 * dots, eps * (qq[:, None] + vv.max(initial=0.0))
    norms = np.sqrt(qq)[:, None] * np.sqrt(vv)[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        order = 1.0 - dots / norms
    order[norms == 0] = np.nan
    return order, np.full((len(q), 1), eps)


DIST_BUDGET = 1024 * 1024          # distance entries per block (8 MB of float64)


def _empty_best(nq: int):
    z = np.zeros((nq, 0))
    return z.astype(np.int8), z.astype(np.float64), z.astype(np.int64)


def _merge(best, cand, k: int):
    """Keep the k smallest (class, distance, id) per query row."""
    cls = np.concatenate([best[0], cand[0]], axis=1)
    dist = np.concatenate([best[1], cand[1]], axis=1)
    ids = np.concatenate([best[2], cand[2]], axis=1)
    key = np.where(cls == 0, dist, 0.0)
    order = np.lexsort((ids, key, cls), axis=1)[:, :k]
    return (np.take_along_axis(cls, order, 1), np.take_along_axis(dist, order, 1),
            np.take_along_axis(ids, order, 1))


def _block_topk(metric: str, q: np.ndarray, mat: np.ndarray, vid: np.ndarray, kk: int):
    """Top-kk of one block by (class, distance, id) on exact distances.

    ``vid`` is sorted.  A few more than kk rows per query are proposed by
    the matrix product and measured exactly; a query whose next proposal
    could still be nearer than its kk-th (ties, rounding, NaN) is measured
    against the whole block."""
    m = len(vid)
    take = min(m, kk + 8)
    order, margin = _proposed(metric, q, mat)
    order = np.where(np.isnan(order), np.inf, order)
    if take < m:
        idx = np.argpartition(order, take, axis=1)
        rest = np.take_along_axis(order, idx[:, take:take + 1], 1)[:, 0]      # the best one left out
        idx = np.sort(idx[:, :take], axis=1)
    else:
        idx, rest = np.broadcast_to(np.arange(m), (len(q), m)), np.full(len(q), np.inf)
    step = max(1, DIST_BUDGET // max(1, take * mat.shape[1]))
    dist = np.concatenate([_exact(metric, q[a:a + step, None, :], mat[idx[a:a + step]]) for a in range(0, len(q), step)])
    cls, out, ids = _merge(_empty_best(len(q)), (np.isnan(dist).astype(np.int8), dist, vid[idx]), kk)
    if take < m:
        kth = np.sort(np.take_along_axis(order, idx, 1), axis=1)[:, kk - 1]
        for row in np.flatnonzero(~(rest > kth + 2.0 * margin[:, 0])):        # also where anything is not finite
            near = np.flatnonzero(~(order[row] > kth[row] + 2.0 * margin[row, 0]))
            if not len(near) or not np.isfinite(kth[row]):
                near = np.arange(m)
            d = np.concatenate([_exact(metric, q[row], mat[near[a:a + 65_536]]) for a in range(0, len(near), 65_536)])
            one = _merge(_empty_best(1), (np.isnan(d).astype(np.int8)[None], d[None], vid[near][None]), kk)
            cls[row], out[row], ids[row] = one[0][0], one[1][0], one[2][0]
    return cls, out, ids


def _usual(metric: str, squares: np.ndarray) -> np.ndarray:
    """Rows whose distances a scaled single-precision product can bound: finite, with a direction
    where that counts, and far from the ends of double precision."""
    some = (squares > 1e-200) & (squares < 1e200)
    return some if metric == "cosine" else some | (squares == 0)


def _lost(metric: str, squares: np.ndarray) -> np.ndarray:
    """Rows that have no distance to any other: NaN among their components, or no direction under cosine."""
    return np.isnan(squares) | (squares == 0) if metric == "cosine" else np.isnan(squares)


def _first_of_equals(mat: np.ndarray, k: int) -> np.ndarray:
    """Row numbers, ascending, of the first k of each set of equal rows (the others are no hit: equal
    vectors have equal distances, and smaller ids go first)."""
    if not mat.size:
        return np.arange(len(mat))
    bits = np.ascontiguousarray(mat).view(np.uint64)
    odd = np.random.default_rng(0).integers(0, 1 << 63, bits.shape[1], dtype=np.uint64) * 2 + 1
    _, first, group, size = np.unique((bits * odd).sum(1), return_index=True, return_inverse=True, return_counts=True)
    if size.max() <= k:
        return np.arange(len(mat))
    order = np.argsort(group, kind="stable")
    place = np.arange(len(mat)) - np.repeat(np.cumsum(size) - size, size)
    large = np.flatnonzero(size[group] > k)
    mixed = np.zeros(len(size), dtype=bool)     # groups whose rows share the sum only: kept whole
    mixed[group[large[(bits[large] != bits[first[group[large]]]).any(1)]]] = True
    late = order[place >= k]
    late = late[~mixed[group[late]]]
    return np.setdiff1d(np.arange(len(mat)), late, assume_unique=True)


class _Bound:
    """Bounds of the distances of some queries to some vectors from one single-precision product.

    Rows are scaled in double precision first (unit length for cosine and the queries of the inner
    product, else the longest row to 1), so nothing overflows and the rounding is at most ``eps``
    times the product of the lengths."""

    def __init__(self, metric: str, q: np.ndarray, mat: np.ndarray):
        self.metric = metric
        self.qn = np.sqrt((q * q).sum(1))
        vn = np.sqrt((mat * mat).sum(1))
        self.eps = 2.0 * (mat.shape[1] + 8) * float(np.finfo(np.float32).eps)
        most = float(vn.max(initial=0.0)) or 1.0
        if metric == "l2":
            self.scale = 1.0 / max(most, float(self.qn.max(initial=0.0)))
            v = mat * self.scale
            self.v = np.concatenate([v, (v * v).sum(1, keepdims=True)], axis=1).astype(np.float32)
            self.q = np.concatenate([q * (-2.0 * self.scale), np.ones((len(q), 1))], axis=1).astype(np.float32)
        else:
            self.scale = 1.0 / most
            unit = np.divide(q, -self.qn[:, None], out=np.zeros_like(q), where=self.qn[:, None] > 0)
            self.q = unit.astype(np.float32)
            self.v = (mat / vn[:, None] if metric == "cosine" else mat * self.scale).astype(np.float32)

    def nearer(self, a: int, b: int, lo: int, hi: int, kth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, column) of every pair of queries a..b and vectors lo..hi that may be as near as ``kth``."""
        n = self.qn[a:b]
        if self.metric == "l2":
            n = n * self.scale
            most = (kth * self.scale) ** 2 - n * n + 2.0 * self.eps * (n * n + 1.0)
        elif self.metric == "cosine":
            most = kth - 1.0 + self.eps
        else:
            most = np.divide(kth * self.scale, n, out=np.zeros_like(kth), where=n > 0) + self.eps
        # the bound itself may be rounded down on its way to single precision
        most = np.nextafter(most.astype(np.float32), np.float32(np.inf))
        near = self.q[a:b] @ self.v[lo:hi].T <= most[:, None]
        return np.divmod(np.flatnonzero(near), hi - lo)


def _better(metric: str, best, q: np.ndarray, mat: np.ndarray, vid: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> None:
    """Measure the pairs (rows, cols) exactly and put those that belong there into ``best`` (k full columns)."""
    k = best[0].shape[1]
    step = max(1, DIST_BUDGET // max(1, mat.shape[1]))
    for s in range(0, len(rows), step):
        r, c = rows[s:s + step], cols[s:s + step]
        d = _exact(metric, q[r], mat[c])
        in_ = ~(d > best[1][r, -1])
        r, c, d = r[in_], c[in_], d[in_]
        if not len(r):
            continue
        hit, at = np.unique(r, return_inverse=True)
        row = np.concatenate([np.repeat(np.arange(len(hit)), k), at])
        cls = np.concatenate([best[0][hit].ravel(), np.isnan(d).astype(np.int8)])
        dist = np.concatenate([best[1][hit].ravel(), d])
        ids = np.concatenate([best[2][hit].ravel(), vid[c]])
        order = np.lexsort((ids, np.where(cls == 0, dist, 0.0), cls, row))
        count = np.bincount(row, minlength=len(hit))
        place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        order = order[place < k]
        for have, new in zip(best, (cls, dist, ids), strict=True):
            have[hit] = new[order].reshape(-1, k)


FIRST_PIECE = 256                  # vectors that give the first k-th distances; every next piece is twice as long


def _piece_topk(metric: str, k: int, q: np.ndarray, mat: np.ndarray, vid: np.ndarray, best):
    """``best`` of usual queries after some usual vectors (``vid`` ascending).

    The first piece is ranked as a whole; of the following ones only the pairs are measured that the
    product cannot show to be farther than the k-th neighbour so far."""
    bound, lo, size = None, 0, FIRST_PIECE
    while lo < len(vid):
        hi = min(len(vid), lo + size)
        step = max(1, DIST_BUDGET // (hi - lo))
        if best[0].shape[1] < k or (best[0][:, -1] != 0).any():
            kk = min(k, hi - lo)
            parts = [_block_topk(metric, q[i:i + step], mat[lo:hi], vid[lo:hi], kk) for i in range(0, len(q), step)]
            best = _merge(best, tuple(np.concatenate([p[j] for p in parts], axis=0) for j in range(3)), k)
        else:
            bound = bound or _Bound(metric, q, mat)
            for i in range(0, len(q), step):
                j = min(len(q), i + step)
                rows, cols = bound.nearer(i, j, lo, hi, best[1][i:j, -1])
                if len(rows):
                    _better(metric, best, q, mat, vid, rows + i, cols + lo)
        lo, size = hi, 2 * size
    return best


def _local_topk(metric: str, k: int, q: np.ndarray, ids: np.ndarray, vecs: pd.Series, chunk_rows: int,
                dim: int | None, best=None):
    """Running top-k of every query row of ``q`` against a bunch of vectors.

    Memory stays bounded whatever the sizes: vectors in chunks, queries in
    sub-blocks so a distance block has at most ``DIST_BUDGET`` entries, and
    only k candidates per query are carried between chunks."""
    nq = q.shape[0]
    best = best if best is not None else _empty_best(nq)
    if nq == 0 or len(ids) == 0:
        return best
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    vecs = vecs.iloc[order]
    with np.errstate(over="ignore", invalid="ignore"):
        qq = (q * q).sum(1)
    plain = _usual(metric, qq)
    for start in range(0, len(ids), chunk_rows):
        c_ids = ids[start:start + chunk_rows]
        mat, valid, _ = _stack(vecs.iloc[start:start + chunk_rows], dim)
        vid = c_ids[valid]
        if len(vid):
            with np.errstate(over="ignore", invalid="ignore"):
                vv = (mat * mat).sum(1)
            usual = _usual(metric, vv)
            lost = _lost(metric, vv)
            lost[np.flatnonzero(lost)[:k]] = False  # no number away from every query: only their first k can be hits
            mat, vid, usual = mat[~lost], vid[~lost], usual[~lost]
            kept = _first_of_equals(mat, k)
            mat, vid, usual = mat[kept], vid[kept], usual[kept]
            best = _chunk_topk(metric, k, q, qq, plain, mat, vid, usual, best)
        if (~valid).any():
            # null vectors rank after everything; only the k smallest ids can matter
            nid = c_ids[~valid][:k]
            cand = (np.full((nq, len(nid)), 2, dtype=np.int8), np.full((nq, len(nid)), np.nan),
                    np.broadcast_to(nid, (nq, len(nid))).copy())
            best = _merge(best, cand, k)
    return best


def _chunk_topk(metric: str, k: int, q: np.ndarray, qq: np.ndarray, plain: np.ndarray, mat: np.ndarray, vid: np.ndarray, usual: np.ndarray, best):
    """``best`` after one chunk: usual pairs by bounds, all others by ``_block_topk``."""
    def whole(queries, m, v):
        step = max(1, DIST_BUDGET // len(v))
        parts = [_block_topk(metric, queries[i:i + step], m, v, min(k, len(v))) for i in range(0, len(queries), step)]
        return tuple(np.concatenate([p[j] for p in parts], axis=0) for j in range(3))

    def among(rows):
        return tuple(b[rows] for b in best)

    if plain.all():
        out = _piece_topk(metric, k, q, mat[usual], vid[usual], best) if usual.any() else best
        return out if usual.all() else _merge(out, whole(q, mat[~usual], vid[~usual]), k)
    # each kind of query by itself; rows of all are as wide as the widest, filled up with nothing
    found = []
    if plain.any():
        found.append((plain, _chunk_topk(metric, k, q[plain], qq[plain], plain[plain], mat, vid, usual, among(plain))))
    lost = _lost(metric, qq)
    if lost.any():  # no number away from every vector: the first ids are the hits
        found.append((lost, _merge(among(lost), whole(q[lost], mat[:k], vid[:k]), k)))
    odd = ~plain & ~lost
    if odd.any():
        found.append((odd, _merge(among(odd), whole(q[odd], mat, vid), k)))
    width = found[0][1][0].shape[1]
    out = (np.zeros((len(q), width), np.int8), np.zeros((len(q), width)), np.zeros((len(q), width), np.int64))
    for rows, part in found:
        for have, new in zip(out, part, strict=True):
            have[rows] = new
    return out


def _best_frame(qids: np.ndarray, best, g: str = "") -> pd.DataFrame:
    cls, dist, ids = best
    n = cls.shape[1]
    return pd.DataFrame({"g": g, "query_id": np.repeat(qids, n), "id": ids.reshape(-1),
                         "distance": dist.reshape(-1), "cls": cls.reshape(-1).astype(np.int32)})


def _final_rank(partial: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("g", "query_id").orderBy(F.col("cls"), F.col("distance").asc_nulls_last(), F.col("id"))
    # Arrow turns NaN into null on the way back: restore it from the class
    dist = (F.when(F.col("cls") == 1, F.lit(float("nan")))
            .when(F.col("cls") == 2, F.lit(None).cast("double"))
            .otherwise(F.round("distance", ROUND) + F.lit(0.0)))
    return (partial.withColumn("rank", F.row_number().over(w).cast("long"))
            .where(F.col("rank") <= k)
            .select("g", "query_id", "id", dist.alias("distance"), "rank"))


def _group_key(group) -> F.Column:
    """One string per group (JSON of the group columns; "" without groups)."""
    return F.to_json(F.struct(*group)) if group else F.lit("")


def _bounded_queries(queries: DataFrame, qid: str, qvec: str, limits: SearchLimits, k: int):
    """Pull the query set to the driver only if it is provably small, in
    rows, in bytes and in the rows it makes each task emit:
    ``{group: (query ids, query matrix, dim)}``.  Rows and bytes are counted
    before any vector is pulled."""
    most = min(limits.max_broadcast_queries, max(1, limits.max_partial_rows // k))
    probe = queries.select("g", F.col(qid).cast("long").alias("qid"), F.col(qvec).alias("qv"))
    probe = probe.where(F.col("qv").isNotNull()).limit(most + 1)
    size = probe.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("qv")), F.lit(0)).alias("x")).first()
    if size["n"] > most or 8 * size["x"] > limits.max_broadcast_bytes:
        return None
    tbl = probe.toArrow()
    pdf = tbl.to_pandas()
    out, size = {}, 0
    for g, part in pdf.groupby("g", sort=True):
        q, _, dim = _stack(part["qv"].reset_index(drop=True), None)
        size += q.nbytes
        if size > limits.max_broadcast_bytes:
            return None
        out[g] = (part["qid"].to_numpy(dtype=np.int64), q, dim)
    return out


def knn(queries: DataFrame, vectors: DataFrame, k: int, metric: str = "cosine", *,
        query_id: str = "query_id", query_vector: str = "query_vector",
        vec_id: str = "id", vector: str = "vector", limits: SearchLimits | None = None,
        strategy: str = "auto", group=None) -> DataFrame:
    """Exact top-k of every query against every vector.

    Returns ``query_id long, id long, distance double, rank long`` with at
    most k rows per query (fewer when the table is smaller than k).
    ``strategy``: "auto" | "broadcast" | "blocked".  A row without an id is no
    hit, and a query without one has no result: neither can be named in it.
    (Without nulls the ids reach numpy as whole numbers, whatever their size.)

    ``group``: column names present in both inputs (e.g. embedding kind,
    model, version).  Each query then searches only the vectors of its own
    group — every index in one plan, dimensions may differ between groups —
    and the result starts with the group columns; a query is identified by
    (group, query_id).
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; expected one of {METRICS}")
    if k <= 0:
        raise ValueError("k must be positive")
    limits = limits or SearchLimits()
    group = list(group or [])
    vec = vectors.where(F.col(vec_id).isNotNull()).select(_group_key(group).alias("g"), F.col(vec_id).cast("long").alias("id"),
                                                          F.col(vector).alias("vector"))
    queries = queries.where(F.col(query_id).isNotNull()).select(_group_key(group).alias("g"), query_id, query_vector)

    pulled = None
    if strategy in ("auto", "broadcast"):
        pulled = _bounded_queries(queries, query_id, query_vector, limits, k)
        if pulled is None and strategy == "broadcast":
            raise ValueError("query set exceeds the broadcast bounds")
    if pulled is not None:
        spark = vectors.sparkSession
        try:
            handle = spark.sparkContext.broadcast(pulled)

            def fetch():
                return handle.value
        except Exception:  # Spark Connect: ship the bounded matrices in the closure
            payload = pulled

            def fetch():
                return payload
        chunk = limits.chunk_rows

        def scan(batches):
            by_group = fetch()
            best = {}
            for pdf in batches:
                if not len(pdf):
                    continue
                for g, part in pdf.groupby("g", sort=False):
                    if g not in by_group:
                        continue
                    _, bm, dim = by_group[g]
                    best[g] = _local_topk(metric, k, bm, part["id"].to_numpy(dtype=np.int64),
                                          part["vector"].reset_index(drop=True), chunk, dim, best.get(g))
            for g, b in best.items():
                yield _best_frame(by_group[g][0], b, g)

        partial = spread(vec).mapInPandas(scan, PARTIAL_SCHEMA)
        return _with_group(_final_rank(partial, k), group, vectors)

    # blocked path: bounded co-groups, never all pairs as rows
    nq = queries.count()
    nv = vectors.count()
    bq, bv = block_grid(nq, nv, limits.query_block_rows, limits.vector_block_rows,
                        vectors.sparkSession.sparkContext.defaultParallelism)
    qs = (queries.select("g", F.col(query_id).cast("long").alias("qid"), F.col(query_vector).alias("qv"))
          .where(F.col("qv").isNotNull())
          .withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(bq)))
          .withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(bv - 1)).cast("array<long>"))))
    vs = (vec.withColumn("vb", F.pmod(F.xxhash64("id"), F.lit(bv)))
          .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(bq - 1)).cast("array<long>"))))
    chunk = limits.chunk_rows

    def block(qpdf: pd.DataFrame, vpdf: pd.DataFrame) -> pd.DataFrame:
        if len(qpdf) == 0 or len(vpdf) == 0:
            return _best_frame(np.zeros(0, dtype=np.int64), _empty_best(0))
        qm, _, dim = _stack(qpdf["qv"], None)
        qids = qpdf["qid"].to_numpy(dtype=np.int64)
        best = _local_topk(metric, k, qm, vpdf["id"].to_numpy(dtype=np.int64), vpdf["vector"], chunk, dim)
        return _best_frame(qids, best, qpdf["g"].iloc[0])

    # the number of cells grows with the product of both sides: so do the tasks, or each of them would
    keys = ["g", "qb", "vb"]
    tasks = 3 * bq * bv
    qs, vs = qs.repartition(tasks, *keys), vs.repartition(tasks, *keys)
    partial = qs.groupBy(*keys).cogroup(vs.groupBy(*keys)).applyInPandas(block, PARTIAL_SCHEMA)
    return _with_group(_final_rank(partial, k), group, vectors)


def _with_group(ranked: DataFrame, group, vectors: DataFrame) -> DataFrame:
    """Group columns back from their JSON key (typed as in ``vectors``)."""
    if not group:
        return ranked.drop("g")
    schema = vectors.select(*group).schema
    parsed = F.from_json(F.col("g"), schema)
    return ranked.select(*[parsed[c].alias(c) for c in group], "query_id", "id", "distance", "rank")


def search(queries: DataFrame, vectors: DataFrame, k: int, metric: str, *, metadata: DataFrame | None = None,
           key: str = "screen_id", vector: str = "vector", query_id: str = "query_id",
           query_vector: str = "query_vector", limits: SearchLimits | None = None,
           strategy: str = "auto") -> DataFrame:
    """Top-k search joined to metadata.

    Vectors without a metadata row must not use up k (the reference joins
    in the same statement as the limit), so they are removed with a
    ``left_semi`` join first: on ids alone, broadcast when their size is
    checked small, so the vectors are filtered where they lie; the k hits are
    then joined back for display.
    """
    vecs = vectors
    if metadata is not None:
        vecs = vectors.join(broadcast_if_small(metadata.select(key).distinct()), key, "left_semi")
    hits = knn(queries, vecs, k, metric, query_id=query_id, query_vector=query_vector, vec_id=key,
               vector=vector, limits=limits, strategy=strategy)
    hits = hits.withColumnRenamed("id", key)
    if metadata is None:
        return hits
    # at most k rows per query: small side of a checked size
    return hits.join(metadata, key, "inner")


def top1_side_by_side(left: DataFrame, right: DataFrame, left_name: str, right_name: str,
                      key: str = "query_id") -> DataFrame:
    """Correlate the top-1 of two retrievers per query (outer: a retriever
    may return nothing for a query)."""
    lt = left.where(F.col("rank") == 1).select(key, F.col("id").alias(f"{left_name}_id"),
                                                F.col("distance").alias(f"{left_name}_distance"))
    rt = right.where(F.col("rank") == 1).select(key, F.col("id").alias(f"{right_name}_id"),
                                                 F.col("distance").alias(f"{right_name}_distance"))
    out = lt.join(rt, key, "full_outer")
    return out.withColumn("agree", F.coalesce(F.col(f"{left_name}_id") == F.col(f"{right_name}_id"), F.lit(False)))


RRF_C = 60


def reciprocal_rank_fusion(ranked: list[DataFrame], k: int, c: int = RRF_C) -> DataFrame:
    """Extension — combine several top-k lists per query: score =
    Σ 1 / (c + rank); top-k by score, then id.  One aggregate over the
    (small) union of ranked lists, then the same bounded window top-k."""
    u = ranked[0].select("query_id", "id", "rank")
    for r in ranked[1:]:
        u = u.unionByName(r.select("query_id", "id", "rank"))
    fused = u.groupBy("query_id", "id").agg(F.sum(F.lit(1.0) / (F.lit(c) + F.col("rank"))).alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id"))
    return (fused.withColumn("rank", F.row_number().over(w).cast("long"))
            .where(F.col("rank") <= k)
            .select("query_id", "id", F.round("score", 9).alias("score"), "rank"))
