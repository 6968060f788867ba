"""Numbering rows in an order, and looking values up for rows with hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored
from tessera.session import broadcast_if_small

HOT_SHARE, HOT_LEAST = 100_000, 1_000


def numbered(rows: DataFrame, group: str, order: list[str | Column], keep: list[str]) -> DataFrame:
    """``keep`` and ``group`` of every row, with ``pos`` (its number from 0 within its group, in ``order``) and
    ``group_rows`` (how many the group has).

    Range partitions, sorted and stored with each row's place; only one count for each group and partition
    is summed up.  A group may therefore be any share of the table.  ``rows`` should be narrow and stored."""
    dealt = rows.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    kept = stored(dealt.select(group, *keep, F.spark_partition_id().alias("pos_part"), place.alias("pos_at")), "numbered")
    counts = kept.groupBy(group, "pos_part").agg(F.min("pos_at").alias("pos_first"), F.count(F.lit(1)).alias("pos_n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("pos_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(counts.select(group, "pos_part", (F.coalesce(F.sum("pos_n").over(before), F.lit(0)) - F.col("pos_first")).alias("pos_shift"),
                                  F.sum("pos_n").over(whole).alias("group_rows")), "starts")
    return kept.join(broadcast_if_small(starts), [group, "pos_part"]).select(
        group, *keep, (F.col("pos_at") + F.col("pos_shift")).alias("pos"), "group_rows")


def looked_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join of ``rows`` to ``table`` (one row a key), whatever share of the rows one key has.

    Keys with more than a hundred-thousandth of the rows (and 1,000) are fewer than 100,000: they are
    joined by a broadcast, all others by an exchange.  ``rows`` should be stored; it is read three times."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = rows.count()
    hot = counts.where((F.col("n") > max(HOT_LEAST, total // HOT_SHARE)) & F.col(key).isNotNull()).select(key)
    hot = stored(hot, "hot-keys")
    if hot.isEmpty():
        return rows.join(table, key, "left")
    hot_rows = stored(table.join(F.broadcast(hot), key, "left_semi"), "hot-rows")
    usual = rows.join(F.broadcast(hot), key, "left_anti").join(table, key, "left")
    return usual.unionByName(rows.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(hot_rows), key, "left"))
