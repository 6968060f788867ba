"""The map between two spaces against a plain solve, and as an encoder."""

import numpy as np
import pytest

from tessera.operators import align


def frame(spark, x, y, parts=5):
    rows = [(k, None if a is None else [float(v) for v in a], None if b is None else [float(v) for v in b]) for k, (a, b) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "id long, x array<float>, y array<double>").repartition(parts)


def test_fit_equals_plain_least_squares(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 6)).astype(np.float32)
    y = x @ rng.normal(size=(6, 9)) + 0.1 * rng.normal(size=(200, 9))
    got = align.fit(frame(spark, [*x, None, x[0]], [*y, y[0], None]), "x", "y", ridge=0.5)
    a = x.astype(np.float64)
    want = np.linalg.solve(a.T @ a + 0.5 * np.eye(6), a.T @ y)
    assert got.pairs == 200 and np.allclose(got.weights, want, atol=1e-10)
    assert got.residual == pytest.approx(float(((y - a @ want) ** 2).sum())) and got.squares == pytest.approx(float((y * y).sum()))


def test_no_pairs_and_mixed_lengths_are_errors(spark):
    with pytest.raises(ValueError, match="no pairs"):
        align.fit(frame(spark, [None, [1.0]], [[1.0], None]), "x", "y")
    with pytest.raises(Exception, match="dimensions differ"):
        align.fit(frame(spark, [[1.0], [1.0, 2.0]], [[1.0], [2.0]], parts=2), "x", "y")


def test_texts_find_the_images_they_were_paired_with(spark):
    """Images are a rotation of the texts' vectors: the map finds it, and held-out texts find their image."""
    from pyspark.sql import functions as F

    from tessera.operators import embed as E

    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(300)]
    texts = [" ".join(rng.choice(words, 30)) for _ in range(150)]
    vectors = align.hashing_encoder(24)()([t.split() for t in texts]).astype(np.float64)
    turn = np.linalg.qr(rng.normal(size=(40, 24)))[0].T  # 24 into 40 dimensions, lengths kept
    images = vectors @ turn
    docs = spark.createDataFrame(list(enumerate(texts)), "screen_id long, text string")
    index = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(images)], "screen_id long, vector array<double>")
    pairs = E.with_hash_vectors(docs.where("screen_id < 100"), "text", "x", 24).join(index, "screen_id")
    found = align.fit(pairs, "x", "vector", ridge=1e-6)
    asked = docs.where("screen_id >= 100").select(F.col("screen_id").alias("query_id"), E.tokens(F.col("text")).alias("tokens"))
    hits = align.search_across(asked, "tokens", align.hashing_encoder(24), found, index, 1).collect()
    assert len(hits) == 50 and all(h.query_id == h.screen_id and h.distance < 1e-4 for h in hits)
