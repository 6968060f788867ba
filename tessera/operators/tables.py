"""Keyed table maintenance on plain Parquet (no MERGE): insert-if-absent,
strict insert, keyed update, cascade delete, snapshot writes.

Idempotency comes from anti-joins on the key, never from a unique index:

* the *source* is first reduced to one row per key (``one_per_key``) in one
  pass: a group limit reduces a hot key inside each task;
* the reduced delta is ``left_anti``-joined against the target's keys;
* the new table is written as a new snapshot; the path being read is never
  overwritten (single writer per table is assumed — concurrent writers are
  out of scope).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tessera.session import broadcast_if_small


class InsertConflict(RuntimeError):
    """Strict insert found keys that already exist."""


def one_per_key(df: DataFrame, keys, order_col: str | None = None, last: bool = False, repeated: str = "pick") -> DataFrame:
    """One row per key: the first (or last) by ``order_col``, ties broken by
    the row itself, so a recomputed task picks the same row.

    One pass over ``df`` and no job of its own: ``row_number`` with a limit is
    planned as a group limit, so every task passes on one row a key (a key with
    any share of the rows is reduced where they lie) and the rows cross one
    exchange, by the key that the join that follows needs as well.
    ``repeated="refuse"`` makes a repeated key an error at run time."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    order = [c for c in ([order_col] if order_col else []) + [c for c in rest if c != order_col]]
    # descending order turns nulls last, as the smallest
    by = [F.col(c).desc_nulls_last() if last else F.col(c).asc_nulls_first() for c in order]
    numbered = df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*by)))
    if repeated == "refuse":
        told = F.raise_error(F.concat(F.lit("repeated key without an arrival column: "), F.to_json(F.struct(*keys)))).cast("boolean")
        return numbered.where(F.col("_nth") <= 2).where(F.when(F.col("_nth") == 1, True).otherwise(told)).drop("_nth")
    return numbered.where(F.col("_nth") <= 1).drop("_nth")


def first_per_key(df: DataFrame, keys, order_col: str | None = None) -> DataFrame:
    """One row per key: the first by ``order_col`` (arrival); without it the
    smallest row."""
    return one_per_key(df, keys, order_col)


def new_rows(target: DataFrame, source: DataFrame, keys, order_col: str | None = None) -> DataFrame:
    """Rows an ``INSERT … ON CONFLICT (keys) DO NOTHING`` would add: first
    writer wins inside the batch, existing keys are kept untouched."""
    keys = list(keys)
    src = first_per_key(source, keys, order_col)
    if order_col and order_col not in target.columns:
        src = src.drop(order_col)
    return src.join(target.select(*keys), keys, "left_anti")


def insert_if_absent(target: DataFrame, source: DataFrame, keys, order_col: str | None = None):
    """(new table, delta).  ``delta.count()`` is the inserted-row count
    (0 on an idempotent re-run)."""
    delta = new_rows(target, source, keys, order_col)
    cols = [c for c in target.columns if c in delta.columns]
    # columns the source does not carry (e.g. a payload filled later) stay null
    return target.unionByName(delta.select(*cols), allowMissingColumns=True), delta


def upsert_latest(target: DataFrame, source: DataFrame, keys, order_col: str | None = None):
    """Extension — ``ON CONFLICT DO UPDATE``: the last source row per key
    replaces the target row; other target rows stay.  Returns (new table,
    changed rows)."""
    keys = list(keys)
    cols = [c for c in target.columns]
    if order_col:
        latest = one_per_key(source.select(*dict.fromkeys([*cols, order_col])), keys, order_col, last=True).select(*cols)
    else:
        latest = first_per_key(source.select(*cols), keys)
    kept = target.join(latest.select(*keys), keys, "left_anti")
    return kept.unionByName(latest.select(*cols)), latest.select(*cols)


def conflicts(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Source rows whose key already exists (a strict insert would fail)."""
    return source.join(target.select(*keys).distinct(), list(keys), "left_semi")


def insert_strict(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Append, but raise if any key exists already or repeats in the batch."""
    keys = list(keys)
    bad = conflicts(target, source, keys).select(*keys).limit(20).collect()
    rep = source.groupBy(*keys).count().where("count > 1").select(*keys).limit(20).collect()
    if bad or rep:
        raise InsertConflict(f"duplicate key(s): {[tuple(r) for r in (bad or rep)]}")
    return target.unionByName(source.select(*target.columns))


def update_by_key(target: DataFrame, updates: DataFrame, keys, columns, order_col: str | None = None) -> DataFrame:
    """``UPDATE target SET columns = updates.columns WHERE keys match``.

    Several updates for one key: the last by ``order_col`` wins (sequential
    statements).  Adds ``updated boolean``."""
    keys = list(keys)
    cols = list(columns)
    if order_col:
        u = (updates.groupBy(*keys)
             .agg(F.max_by(F.struct(*[F.col(c) for c in cols]),
                           F.struct(F.col(order_col), *[F.col(c) for c in cols])).alias("_u"))   # ties: by row
             .select(*keys, *[F.col("_u")[c].alias(f"_new_{c}") for c in cols]))
    else:
        u = first_per_key(updates.select(*keys, *cols), keys).select(
            *keys, *[F.col(c).alias(f"_new_{c}") for c in cols])
    u = u.withColumn("_hit", F.lit(True))
    j = target.join(u, keys, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    out = j
    for c in cols:
        out = out.withColumn(c, F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)))
    return out.withColumn("updated", hit).drop("_hit", *[f"_new_{c}" for c in cols])


def touch(target: DataFrame, keys_df: DataFrame, keys, ts_col: str, ts_value) -> DataFrame:
    """Set only ``ts_col`` (a literal fixed once per run) where keys match."""
    hit = keys_df.select(*keys).distinct().withColumn("_hit", F.lit(True))
    j = target.join(hit, list(keys), "left")
    return (j.withColumn(ts_col, F.when(F.col("_hit"), F.lit(ts_value)).otherwise(F.col(ts_col)))
            .drop("_hit"))


def cascade_delete(children: dict[str, DataFrame], deleted_runs: DataFrame, key: str = "run_id") -> dict:
    """Remove every child row of the deleted runs (ON DELETE CASCADE)."""
    gone = broadcast_if_small(deleted_runs.select(key).distinct())
    return {name: df.join(gone, key, "left_anti") for name, df in children.items()}


def cascade_report(children: dict[str, DataFrame], deleted_runs: DataFrame, key: str = "run_id") -> DataFrame:
    """``table, rows_before, rows_after`` of a cascade delete, one scan per
    child table: the children's key columns are unioned, marked by a left
    join to the (checked-size) deleted key set and counted in one aggregate
    — the "after" side is not re-read."""
    gone = broadcast_if_small(deleted_runs.select(key).distinct().withColumn("_gone", F.lit(True)))
    tagged = None
    for name, df in children.items():
        part = df.select(F.lit(name).alias("table"), key)
        tagged = part if tagged is None else tagged.unionByName(part)
    marked = tagged.join(gone, key, "left")
    return marked.groupBy("table").agg(F.count(F.lit(1)).alias("rows_before"),
                                       F.count_if(F.col("_gone").isNull()).alias("rows_after"))


def truncate(df: DataFrame) -> DataFrame:
    """Delete all rows, keep the schema."""
    return df.where(F.lit(False))


def write_snapshot(df: DataFrame, base: str, version: int, partition_by=None) -> str:
    """Write ``base/v=<version>``; readers keep using the previous version
    until the caller moves its pointer."""
    path = f"{base.rstrip('/')}/v={int(version)}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def append(df: DataFrame, path: str, partition_by=("run_id",)) -> None:
    """Append to a log table (audit results, metrics, review queue)."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_counted(df: DataFrame, path: str, partition_by=(), **counts) -> dict[str, int]:
    """Write ``df`` and return its rows and further aggregates, taken while it is written
    (``DataFrame.observe``): no second job, no second pass."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counts.items()]).write.partitionBy(*partition_by).parquet(path)
    return dict(seen.get)
