"""Operator 5 — sharding by a hierarchical weighted hash tree.

A tree of regions, racks and shards; each node's weight is the sum of its
shards'.  A key descends level by level: every child draws ``-ln(u) / weight``
from a hash of the key and the child's own name, and the smallest draw wins, so
children are chosen in proportion to their weights.  A draw depends on nothing
but the key, the child and its weight: when one weight changes, keys move only
into or out of that child, and movement stays within the subtrees whose weights
change.  A shard that is added as a region of its own takes keys only into
itself.

Everything is DataFrame expressions.  Slots number the rows of a shard without
gaps: rows are counted by (shard, hash bucket), the counts' running sums place
each bucket, and a window numbers the rows inside a bucket.

Defined cases: null text has size 1 and the checksum of no bytes; null ids share
one shard; repeated rows share a shard and get slots of their own; an empty
table gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored

BUCKETS = 4096


@dataclass(frozen=True)
class Tree:
    """region → rack → shard → weight."""

    regions: dict[str, dict[str, dict[int, float]]]

    def shards(self) -> list[int]:
        return [s for racks in self.regions.values() for shards in racks.values() for s in shards]

    def grown(self, weight: float = 1.0) -> Tree:
        """The tree with one more shard, in a region of its own: no other subtree changes."""
        new = max(self.shards(), default=-1) + 1
        return Tree(self.regions | {f"region-of-{new}": {"rack-0": {new: weight}}})


def even_tree(shards: int, per_rack: int = 2, racks: int = 2) -> Tree:
    """Shards 0 to ``shards`` - 1 of equal weight, ``per_rack`` to a rack, ``racks`` to a region."""
    regions: dict = {}
    for s in range(shards):
        rack, region = s // per_rack, s // (per_rack * racks)
        regions.setdefault(f"region-{region}", {}).setdefault(f"rack-{rack}", {})[s] = 1.0
    return Tree(regions)


def _draw(key: Column, node: str, weight: float) -> Column:
    """-ln(u) / weight, u in (0, 1) from 53 bits of a hash of the key and the node's name."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(node)), 11)
    return -F.log((bits + F.lit(0.5)) / F.lit(float(2**53))) / F.lit(float(weight))


def _choose(key: Column, children: list[tuple[str, float, Column]]) -> Column:
    """Value of the child with the smallest draw; children: (name, weight, value)."""
    if len(children) == 1:
        return children[0][2]
    draws = [F.struct(_draw(key, name, weight).alias("d"), F.lit(k).alias("k")) for k, (name, weight, _) in enumerate(children)]
    winner = F.least(*draws)["k"]
    out = F.when(winner == 0, children[0][2])
    for k, (_, _, value) in enumerate(children[1:], 1):
        out = out.when(winner == k, value)
    return out


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard that the tree gives to a key.  Shards of weight 0 get nothing."""
    regions = []
    for region, racks in tree.regions.items():
        options = []
        for rack, shards in racks.items():
            leaves = [(f"{region}/{rack}/{s}", w, F.lit(s)) for s, w in shards.items() if w > 0]
            if leaves:
                options.append((f"{region}/{rack}", sum(w for _, w, _ in leaves), _choose(key, leaves)))
        if options:
            regions.append((region, sum(w for _, w, _ in options), _choose(key, options)))
    if not regions:
        raise ValueError("a tree needs a shard with weight")
    return _choose(key, regions)


def assign(docs: DataFrame, tree: Tree, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    text, key = F.coalesce(docs[text_col].cast("binary"), F.lit(b"")), docs[id_col]
    rows = docs.select(
        key.alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"), shard_of(key, tree).cast("int").alias("shard"), shard_of(key, tree.grown()).cast("int").alias("grown_shard"),
        F.xxhash64(key, F.crc32(text)).alias("h"))
    rows = stored(rows, "shards").withColumn("bucket", F.pmod("h", F.lit(BUCKETS)))  # narrow: the texts are read once
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "bucket").orderBy("h", "doc_id", "size")
    placed = rows.join(starts, ["shard", "bucket"])  # dealt once, for the join and the window
    return placed.select("doc_id", "size", "text_crc32", "law", "shard",
                         (F.col("start") + F.row_number().over(inside) - 1).cast("long").alias("slot"), "grown_shard")
