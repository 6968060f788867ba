"""Vector expressions as built-in higher-order functions (JVM side).

Vectors are ``array<float>``; every product is taken in double so results
agree with other engines (float32 storage, float64 arithmetic).

These are per-row expressions (norms, normalisation, zero test).  Distances
between vectors belong to the search: ``tessera.operators.search``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("l2", "cosine", "ip")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sq_norm(v) -> Column:
    return F.aggregate(_c(v), F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double"))


def norm(v) -> Column:
    return F.sqrt(sq_norm(v))


def l2_normalize(v) -> Column:
    """Unit-length ``array<float>`` copy; a zero vector stays zero (no 0/0).

    The squared norm is accumulated once and handed to the ``finish``
    lambda, so it is not recomputed per element."""
    return F.aggregate(
        _c(v), F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double"),
        lambda ss: F.transform(_c(v), lambda x: F.when(ss > 0, x.cast("double") / F.sqrt(ss))
                               .otherwise(x.cast("double")).cast("float")))


def dims(v) -> Column:
    return F.size(_c(v))


def is_zero_vector(v) -> Column:
    """Inner product of the vector with itself is 0 (the reference's test)."""
    return sq_norm(v) == 0.0
