"""Ingest: source rows → bronze rows with derived object keys, content
fingerprints and run lineage, then insert-if-absent into the metadata table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import fingerprint
from tessera.operators.tables import one_per_key

# Fixed values (must equal the reference's).
SOURCE_DEFAULTS = {"app_package_name": "", "category": "", "view_hierarchy": "{}"}
KEY_PREFIX = "screens/"
IMAGE_SUFFIX = ".png"
TREE_SUFFIX = ".json"


def with_defaults(df: DataFrame, defaults: dict[str, str] = SOURCE_DEFAULTS) -> DataFrame:
    """Add *absent* attributes with their default; a present null stays
    null (``dict.get(key, default)`` semantics — no ``coalesce``)."""
    out = df
    for name, value in defaults.items():
        if name not in df.columns:
            out = out.withColumn(name, F.lit(value))
    return out


def object_key(id_col, suffix: str) -> F.Column:
    return F.concat(F.lit(KEY_PREFIX), F.col(id_col).cast("string"), F.lit(suffix))


def to_bronze(src: DataFrame, run_id: str, *, id_col: str = "screenId", payload_col: str = "image",
              arrival_col: str | None = None, keep: str = "last") -> DataFrame:
    """Bronze rows: keys, payload bytes, tree text, fingerprint of the payload.

    Writing the same key twice overwrites the object, so the *last* arrival
    of a key wins (``keep="first"`` gives the first one, as a table that
    ignores existing keys keeps it).  Without an arrival column the order of
    two writes is unknown: a repeated key is then refused when the rows are
    read.  Only keys that repeat are reduced; other payloads are not moved."""
    s = with_defaults(src)
    payload = F.col(payload_col)
    if dict(s.dtypes)[payload_col] == "string":
        payload = F.encode(payload, "UTF-8")
    rows = s.select(
        F.col(id_col).cast("long").alias("screen_id"),
        F.col("app_package_name").alias("app_package"),
        F.col("category"),
        payload.alias("payload"),
        F.col("view_hierarchy").alias("hierarchy_json"),
        *([F.col(arrival_col).alias("_arrival")] if arrival_col else []),
    )
    if arrival_col:
        rows = one_per_key(rows, ["screen_id"], "_arrival", last=keep == "last").drop("_arrival")
    else:
        rows = one_per_key(rows, ["screen_id"], repeated="refuse")
    return rows.select(
        "screen_id", "app_package", "category",
        object_key("screen_id", IMAGE_SUFFIX).alias("png_path"),
        object_key("screen_id", TREE_SUFFIX).alias("hierarchy_json_path"),
        "payload", "hierarchy_json",
        fingerprint("payload").alias("source_fingerprint"),
        F.lit(run_id).alias("run_id"),
    )


def metadata_rows(bronze: DataFrame) -> DataFrame:
    """The metadata-table projection of bronze rows (pointers, not bytes)."""
    return bronze.select("screen_id", "app_package", "category", "png_path", "hierarchy_json_path", "run_id",
                         "source_fingerprint")
