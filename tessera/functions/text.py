"""Scalar text helpers as built-in expressions (JVM side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's).
PREVIEW_CHARS = 80
PREVIEW_KEEP = 77
ELLIPSIS = "..."
FINGERPRINT_PREFIX = 16
DETAILS_CHARS = 1500
TRUNCATED_MARKER = "\n... (truncated)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_blank(c) -> Column:
    """Null, empty or only whitespace — stops at the first visible character
    instead of stripping the whole text."""
    return F.coalesce(~F.regexp_like(_c(c), F.lit(r"[^\s\p{Z}]")), F.lit(True))


def fingerprint(c) -> Column:
    """SHA-256 hex of a string (its UTF-8 bytes) or of binary bytes."""
    return F.sha2(_c(c), 256)


def preview(c, limit: int = PREVIEW_CHARS, keep: int = PREVIEW_KEEP, marker: str = ELLIPSIS) -> Column:
    """Text itself when short, else its first ``keep`` chars and a marker."""
    return F.when(F.length(_c(c)) <= limit, _c(c)).otherwise(F.concat(F.left(_c(c), F.lit(keep)), F.lit(marker)))


def cut(c, limit: int, marker: str = "") -> Column:
    """First ``limit`` chars, plus ``marker`` only when something was cut."""
    if not marker:
        return F.left(_c(c), F.lit(limit))
    return F.when(F.length(_c(c)) > limit, F.concat(F.left(_c(c), F.lit(limit)), F.lit(marker))).otherwise(_c(c))
