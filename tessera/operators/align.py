"""A linear map from one vector space to another, and search across the two.

A model with two towers (text and picture) puts both into one space.  Where the
two sides come from encoders of their own, a map learned from pairs does that:
least squares with a ridge, ``W = (X'X + rI)^-1 X'Y`` over the rows that have both
vectors.  The sums ``X'X`` and ``X'Y`` are taken by task and added up by position, so
only ``d * (d + m)`` numbers reach the driver, whatever the number of pairs; the
solve is that small too.  The map then is an encoder like any other
(``embed.embed_with``): text, its vector, the mapped vector, unit length.

Pairs without one of the vectors teach nothing.  Vectors of other lengths than
the rest are an error, as in a search.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.embed import TEXT_DIMS, Buckets, embed_with
from tessera.operators.search import SearchLimits, search

MAX_SUMS = 4_000_000  # numbers that the driver adds up and solves for (32 MB)


@dataclass(frozen=True)
class LinearMap:
    """Weights from space X (rows) to space Y (columns), and how well they fit their pairs."""

    weights: np.ndarray
    pairs: int
    squares: float      # sum of squares of Y
    residual: float     # what the map leaves of it


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths as doubles."""
    widths = set(column.value_lengths().to_pylist())
    if len(widths) > 1:
        raise ValueError(f"vector dimensions differ: {sorted(widths)}")
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def fit(pairs: DataFrame, x: str, y: str, ridge: float = 1.0) -> LinearMap:
    """Least-squares map from the vectors ``x`` to the vectors ``y`` of the same row."""
    both = pairs.select(F.col(x).cast("array<double>").alias("x"), F.col(y).cast("array<double>").alias("y")).where("x IS NOT NULL AND y IS NOT NULL")

    def sums(batches):
        total, d, m, n, squares = None, 0, 0, 0, 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = _matrix(batch.column("x")), _matrix(batch.column("y"))
            if total is None:
                d, m = a.shape[1], b.shape[1]
                if d * (d + m) > MAX_SUMS:
                    raise ValueError(f"a map of {d} by {m} needs more than {MAX_SUMS} sums")
                total = np.zeros((d, d + m))
            if (a.shape[1], b.shape[1]) != (d, m):
                raise ValueError(f"vector dimensions differ: {sorted({d, a.shape[1]})}, {sorted({m, b.shape[1]})}")
            total += a.T @ np.hstack([a, b])
            n += len(a)
            squares += float((b * b).sum())
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int64()), pa.array([m], pa.int64()), pa.array([n], pa.int64()), pa.array([squares]),
                                              pa.array([total.reshape(-1)], pa.list_(pa.float64()))], ["d", "m", "n", "squares", "sums"])

    tasks = both.mapInArrow(sums, "d long, m long, n long, squares double, sums array<double>")
    added = (tasks.select("d", "m", "n", "squares", F.posexplode("sums").alias("k", "s")).groupBy("d", "m", "k")
             .agg(F.sum("s").alias("s"), F.sum(F.when(F.col("k") == 0, F.col("n"))).alias("n"), F.sum(F.when(F.col("k") == 0, F.col("squares"))).alias("squares")))
    rows = added.collect()  # d * (d + m) rows
    shapes = {(r.d, r.m) for r in rows}
    if len(shapes) != 1:
        raise ValueError("no pairs to learn from" if not shapes else f"vector dimensions differ: {sorted(shapes)}")
    d, m = shapes.pop()
    total = np.zeros(d * (d + m))
    total[[r.k for r in rows]] = [r.s for r in rows]
    total = total.reshape(d, d + m)
    gram, cross = total[:, :d], total[:, d:]
    weights = np.linalg.solve(gram + ridge * np.eye(d), cross)
    first = next(r for r in rows if r.k == 0)
    residual = first.squares - 2 * float((weights * cross).sum()) + float((weights * (gram @ weights)).sum())
    return LinearMap(weights, first.n, first.squares, residual)


def hashing_encoder(dim: int = TEXT_DIMS) -> Callable[[], Callable[[list], np.ndarray]]:
    """The built-in text encoder for ``embed_with``, on token lists (``embed.tokens``)."""
    def make():
        known = Buckets(dim)

        def encode(lists: list) -> np.ndarray:
            counts = known.counted(lists)
            norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
            return np.divide(counts, norms, out=np.zeros_like(counts), where=norms > 0).astype(np.float32)

        return encode

    return make


def across(make_encoder: Callable[[], Callable[[list], np.ndarray]], found: LinearMap) -> Callable[[], Callable[[list], np.ndarray]]:
    """An encoder into space Y: ``make_encoder``'s vectors, mapped."""
    weights = found.weights

    def make():
        encode = make_encoder()
        return lambda inputs: np.asarray(encode(inputs), np.float64) @ weights

    return make


def search_across(queries: DataFrame, input_col: str, make_encoder, found: LinearMap, vectors: DataFrame, k: int, *, metric: str = "l2",
                  metadata: DataFrame | None = None, query_id: str = "query_id", key: str = "screen_id", limits: SearchLimits | None = None) -> DataFrame:
    """Top-k vectors of space Y for inputs of space X, joined to metadata: encode, map, search."""
    asked = embed_with(queries, input_col, across(make_encoder, found), key=query_id).withColumnRenamed("vector", "query_vector")
    return search(asked, vectors, k, metric, metadata=metadata, key=key, query_id=query_id, limits=limits)
