"""Operator 12 — prefix trie of conversations by van Emde Boas recursion.

A node is a distinct sequence of first turns (role, text).  Depth is halved again
and again: sequences are cut at half depth, the cut prefixes get names, the trie
above the cuts and the forests below them are built by the same steps, all parts
of one level together, and at the end the forests' totals are grafted onto the
trie above.  As DataFrames, with ``LEAF`` turns as the smallest part:

* *up*: a part's whole stretch of turns gets a name, two neighbouring stretches
  one, and so on;
* *down*: the name of the prefix at a cut is that of the prefix where the stretch
  began and of the stretch's upper half; after log(depth) steps every part
  knows the name it starts from, and names its own prefixes;
* *graft*: each part sums its nodes; then, from the smallest halves to the largest,
  every root of a forest below a cut adds its total to its ancestors in the half above.

A name is a 128-bit digest of what it names, so equal prefixes meet without any
exchange of names.  A conversation *owns* a node if it is the node's smallest member;
it owns one stretch of its path, down to its end.  Totals move along owners'
paths only: the copies of a conversation cost nothing there, and every sum is
combined in its task first.  No step handles a node's members, a conversation
or a level of the trie as one group; rounds grow with the logarithm of the depth.

The members that end at a node are hashed in the order of their ids.  Ids are
packed to text by ranges of ``CHUNK``; a node with more ranges streams through one
task, since SHA-256 is sequential by definition.

Defined cases: turns without a number come first, equal numbers in the order of
their content's digest, each a turn of its own, so repeated rows are repeated turns;
null role or text is empty; rows without a conversation id belong to none and are
left out; conversations left without turns are members of the root; an empty table
has no nodes; very long texts are hashed whole; other columns are not read.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored
from tessera.llm.order import looked_up, numbered

LEAF, CHUNK = 16, 4096
HEADS, GROUP = 9, 5  # fixed by the contract: up to 8 turns come from the first conversation of each five


def _root() -> Column:
    return F.lit(bytes(16))


def _name(tag: str, *parts: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(F.lit(tag.encode()), *parts), 256)), 1, 16)


def turns_of(talks: DataFrame) -> DataFrame:
    """(conv, pos, group_rows, sym, bytes): numbered turns, their content as a digest."""
    role, text = (F.coalesce(talks[c].cast("string"), F.lit("")).cast("binary") for c in ("role", "text"))
    sym = _name("t", F.concat(F.octet_length(role).cast("string"), F.lit(":")).cast("binary"), role, text)
    rows = talks.where(talks["conv_id"].isNotNull()).select(
        talks["conv_id"].alias("conv"), talks["turn"].alias("turn"), sym.alias("sym"), F.octet_length(text).cast("long").alias("bytes"))
    return stored(numbered(stored(rows, "turns"), "conv", [F.col("turn").asc_nulls_first(), "sym"], ["sym", "bytes"]), "numbered-turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The contract's conversations: (conv, depth, total, sym, bytes) and (conv, total).

    The first h turns are those of the first conversation of each five, then follow the
    conversation's own after its first h; h = CRC-32 of its id modulo 9."""
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS
    sizes = turns.where("pos = 0").select("conv", F.col("group_rows").alias("n"))
    plan = sizes.select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % GROUP).alias("first"))
    lengths = sizes.select(F.col("conv").alias("first"), F.col("n").alias("there"))
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    plan = stored(plan.join(lengths, "first", "left").select("conv", "first", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total")), "plan")
    heads = turns.where(F.col("pos") < HEADS - 1).select(F.col("conv").alias("first"), "pos", "sym", "bytes")
    lead = plan.join(heads, "first").where("pos < h").select("conv", (F.col("pos") + 1).alias("depth"), "total", "sym", "bytes")
    own = looked_up(turns.select("conv", "pos", "sym", "bytes"), plan.drop("first"), "conv").where("pos >= h")
    own = own.select("conv", (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("depth"), "total", "sym", "bytes")
    return stored(lead.unionByName(own), "rebuilt"), plan.select("conv", "total")


def _starts(parts: DataFrame, leaf: int) -> DataFrame | None:
    """(conv, part, start): the name of the prefix before each part, for conversations with a whole part."""
    fold = F.aggregate("turns", F.lit(b"").cast("binary"), lambda acc, t: _name("b", acc, t["sym"]))
    level = stored(parts.where(F.size("turns") == leaf).select("conv", F.col("part").alias("q"), fold.alias("b")), "stretches")
    if level.isEmpty():
        return None
    starts = level.where("q = 0").select("conv", F.lit(0).cast("long").alias("part"), _root().alias("start"))
    levels = []
    while not level.isEmpty():
        levels.append(level)
        pairs = level.groupBy("conv", F.floor(F.col("q") / 2).alias("q")).agg(F.sort_array(F.collect_list(F.struct("q", "b"))).alias("two"))
        level = stored(pairs.where(F.size("two") == 2).select("conv", "q", _name("u", F.col("two")[0]["b"], F.col("two")[1]["b"]).alias("b")), "stretches")
    for j in range(len(levels) - 1, -1, -1):  # cut every stretch of 2^(j+1) parts in the middle
        width = 1 << j
        at = starts.select("conv", "part", "start", F.floor(F.col("part") / width).alias("q"))
        cut = at.join(levels[j], ["conv", "q"]).select("conv", (F.col("part") + width).alias("part"), _name("s", F.col("start"), F.col("b")).alias("start"))
        starts = stored(starts.unionByName(cut), "starts-of-parts")
    return starts


def named(turns: DataFrame, leaf: int = LEAF) -> DataFrame:
    """(conv, depth, total, part, name, parent, bytes) of every prefix of every conversation but the empty one."""
    parts = (turns.groupBy("conv", F.floor((F.col("depth") - 1) / leaf).alias("part"))
             .agg(F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("depth", "sym", "bytes"))).alias("turns")))  # ``leaf`` turns at most
    parts = stored(parts, "parts")
    starts = _starts(parts, leaf)
    if starts is None:
        parts = parts.withColumn("start", _root()).withColumn("next", F.lit(None).cast("binary"))
    else:
        after = starts.select("conv", (F.col("part") - 1).alias("part"), F.col("start").alias("next"))
        parts = parts.join(starts, ["conv", "part"], "left").join(after, ["conv", "part"], "left").withColumn("start", F.coalesce("start", _root()))
    chain = F.aggregate("turns", F.array("start"), lambda acc, t: F.concat(acc, F.array(_name("n", F.element_at(acc, -1), t["sym"]))))
    each = parts.select("conv", "part", "total", "next", chain.alias("names"), F.posexplode("turns").alias("k", "t"))
    own = F.when(F.col("k") == leaf - 1, F.col("next")).otherwise(F.col("names")[F.col("k") + 1])
    return stored(each.select("conv", F.col("t.depth").alias("depth"), "total", "part", own.alias("name"), F.col("names")[F.col("k")].alias("parent"), F.col("t.bytes").alias("bytes")), "named")


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _totals(nodes: DataFrame, prefixes: DataFrame, leaf: int) -> DataFrame:
    """(name, leaves, saved) summed over each node's subtree."""
    down = Window.partitionBy("conv", "part").orderBy(F.col("depth").desc())  # a stretch inside a part: ``leaf`` rows at most
    nodes = nodes.withColumn("part", F.floor((F.col("depth") - 1) / leaf))
    paths = stored(nodes.select("name", "conv", "depth", "part", F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).over(down).alias("leaves"),
                                F.sum((F.col("n_convs") - 1) * F.col("bytes")).over(down).alias("saved")), "paths")
    # where an owner's stretch begins inside a part, it hangs on prefixes that others own
    tops = paths.groupBy("conv").agg(F.min(F.struct("depth", "part", "leaves", "saved")).alias("top")).select("conv", F.col("top.part").alias("part"), F.col("top.depth").alias("d"), "top.leaves", "top.saved")
    hung = tops.where((F.col("d") - 1) % leaf > 0).join(prefixes.select("conv", "part", "depth", "name"), ["conv", "part"]).where("depth < d")
    grafts = [stored(_sums(hung), "grafts")]

    deep = prefixes.where(F.col("total") > leaf).select("conv", "depth", "name")
    roots = paths.where((F.col("depth") > 1) & ((F.col("depth") - 1) % leaf == 0)).select("name", "conv", "depth", "leaves", "saved")
    roots = stored(_grafted(roots, grafts[0]), "forest-roots")
    deepest = roots.agg(F.max("depth")).first()[0] or 0
    width = leaf
    while width < deepest:
        below = roots.where((F.col("depth") - 1) % (2 * width) == width).select("conv", (F.floor((F.col("depth") - 1) / width) - 1).alias("half"), "leaves", "saved")
        above = deep.select("conv", F.floor((F.col("depth") - 1) / width).alias("half"), "name")
        grafts.append(stored(_sums(below.join(above, ["conv", "half"])), "grafts"))
        roots = stored(_grafted(roots, grafts[-1]), "forest-roots")
        width *= 2
    rows = paths.select("name", "leaves", "saved")
    for g in grafts:
        rows = rows.unionByName(g)
    return _sums(rows)


def _grafted(roots: DataFrame, graft: DataFrame) -> DataFrame:
    more = graft.select("name", F.col("leaves").alias("l"), F.col("saved").alias("s"))
    return roots.join(more, "name", "left").select(
        "name", "conv", "depth", *[(F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a) for a, b in (("leaves", "l"), ("saved", "s"))])


def _ends(prefixes: DataFrame, lengths: DataFrame, chunk: int) -> DataFrame:
    """(name, ends): SHA-256 of the comma-joined ids that end at a node."""
    last = prefixes.where(F.col("depth") == F.col("total")).select("name", "conv").unionByName(lengths.where("total = 0").select(_root().alias("name"), "conv"))
    ids = F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",")
    chunks = stored(last.groupBy("name", F.floor(F.col("conv") / chunk).alias("chunk")).agg(ids.alias("ids")), "chunks")
    counts = chunks.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("ids").alias("ids"))
    counts = stored(counts.select("name", "n", F.sha2(F.col("ids").cast("binary"), 256).alias("ends")), "chunk-counts")
    long = chunks.join(counts.where("n > 1"), "name", "left_semi").repartition("name").sortWithinPartitions("name", "chunk")

    def stream(batches):
        name, run = None, None
        for batch in batches:
            done = []
            for key, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if key == name:
                    run.update(b"," + ids.encode())
                    continue
                if run:
                    done.append((name, run.hexdigest()))
                name, run = key, sha256(ids.encode())
            yield _hashed(done)
        if run:
            yield _hashed([(name, run.hexdigest())])

    return counts.where("n = 1").select("name", "ends").unionByName(long.select("name", "ids").mapInArrow(stream, "name binary, ends string"))


def _hashed(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], ["name", "ends"])


def trie(turns: DataFrame, lengths: DataFrame, leaf: int = LEAF, chunk: int = CHUNK) -> DataFrame:
    """One row a node of the trie over ``turns`` (conv, depth from 1, total, sym, bytes); ``lengths``
    (conv, total) also names the conversations without turns."""
    prefixes = named(turns, leaf)
    nodes = prefixes.groupBy("name").agg(F.min("conv").alias("conv"), F.min("depth").alias("depth"), F.min("parent").alias("parent"),
                                         F.count(F.lit(1)).alias("n_convs"), F.min("bytes").alias("bytes"))
    nodes = stored(nodes, "nodes")
    children = nodes.groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(nodes.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")

    whole = lengths.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    sums = nodes.agg(F.count_if(F.col("depth") == 1).alias("n_children"), F.greatest(F.count_if(F.col("n_children") == 0), F.lit(1)).alias("n_leaves"),
                     F.coalesce(F.sum((F.col("n_convs") - 1) * F.col("bytes")), F.lit(0)).alias("saved_tokens"))
    root = stored(whole.join(sums).select(_root().alias("name"), "conv", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv"),
                                          "n_convs", "n_children", "n_leaves", "saved_tokens"), "root")  # one row beside one row

    owners = nodes.select(F.col("name").alias("parent"), F.col("conv").alias("parent_conv")).unionByName(
        root.select(F.col("name").alias("parent"), F.col("conv").alias("parent_conv")))
    parents = looked_up(nodes, owners, "parent")
    totals = _totals(nodes, prefixes, leaf)
    rows = parents.join(totals, "name").select("name", "conv", "depth", "parent_conv", "n_convs", "n_children",
                                               F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    full = rows.unionByName(root).join(_ends(prefixes, lengths, chunk), "name", "left")
    longs = [F.col(c).cast("long").alias(a) for c, a in (("conv", "conv_id"), ("depth", "depth"), ("parent_conv", "parent_conv_id"), ("n_convs", "n_convs"),
                                                         ("n_children", "n_children"), ("n_leaves", "n_leaves"), ("saved_tokens", "saved_tokens"))]
    return full.select(*longs, F.coalesce("ends", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))


def conversation_trie(talks: DataFrame, leaf: int = LEAF, chunk: int = CHUNK) -> DataFrame:
    """The trie of the rebuilt conversations of ``talks`` (conv_id, turn, role, text)."""
    return trie(*rebuilt(turns_of(talks)), leaf, chunk)
