"""Operator 13 — Merkle manifest of a table by butterfly exchange.

Every row is a leaf: the SHA-256 of its fields, each written ``-`` if null, else
as its UTF-8 length, ``:`` and its value.  The leaves of a group (``lang``) ascend by
id; every ``fanout`` consecutive nodes become the hash of their hex digests joined,
until one remains, the group's subroot.  Subroots, ordered by group, likewise give
the root.  A leaf's proof holds, level by level, its siblings to the left and right.

A group's sequence is cut into aligned partitions of ``fanout ** HEIGHT`` leaves, each
hashed to a node of its own in one task.  Then partitions exchange: in round r,
aligned sets of ``fanout`` neighbouring sub-butterflies swap the roots that they
hold, and every partition hashes their common ancestor for itself.  After
log(partitions) rounds each has its siblings at all upper levels and the subroot;
nothing is sent down again.  In an incomplete set the members that are there
answer in turn, so no partition serves them all.  The subroots go through the
same steps.  A round moves one narrow row for each partition.

Defined cases: null ids come first, equal ids in the order of their leaves, so
repeated rows are neighbours with equal leaves and proofs of their own; a null
group is the first group; null, empty and very long texts are hashed whole; a row
without an id is never tampered with; an empty table gives no rows; columns other
than the fields are not read and may have any name.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored
from tessera.llm.order import numbered

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEIGHT = 11  # levels inside a partition: 2,048 leaves at fanout 2
_PATH = "array<struct<l:string,r:string>>"


def leaf(fields: list[Column]) -> Column:
    """Hex digest of a row's fields."""
    parts = []
    for f in fields:
        raw = f.cast("string").cast("binary")
        head = F.concat(F.octet_length(raw).cast("string"), F.lit(":")).cast("binary")
        parts.append(F.when(f.isNull(), F.lit(b"-")).otherwise(F.concat(head, raw)))
    return F.sha2(F.concat(*parts), 256)


def node(children: list[str]) -> str:
    return sha256("".join(children).encode()).hexdigest()


def climb(leaves: list[str], fanout: int, height: int | None) -> list[list[str]]:
    """Levels above ``leaves``, these first: ``height`` of them, or (None) until one node remains."""
    levels = [leaves]
    while len(levels) <= height if height is not None else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([node(below[k: k + fanout]) for k in range(0, len(below), fanout)])
    return levels


def siblings(levels: list[list[str]], at: int, fanout: int) -> list[tuple[str, str]]:
    """What stands left and right of node ``at`` and its ancestors in their runs, joined."""
    path = []
    for level in levels[:-1]:
        start = at - at % fanout
        path.append(("".join(level[start:at]), "".join(level[at + 1: start + fanout])))
        at //= fanout
    return path


def fold(digest: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for left, right in path:
        digest = sha256((left + digest + right).encode()).hexdigest()
    return digest


def _height(blocks: int, height: int) -> int | None:
    return height if blocks > 1 else None


def _exchange(state: DataFrame, fanout: int) -> DataFrame:
    """Butterfly rounds over (grp, block, blocks, digest, path): at the end every partition has the
    root of its group in ``digest`` and its siblings at all levels above its own node in ``path``."""
    most = state.agg(F.max("blocks")).first()[0] or 0
    width = 1
    while width < most:
        active = state.where(F.col("blocks") > width)
        own = F.floor(F.col("block") / width)
        run = F.floor(own / fanout) * fanout
        held = F.least((F.col("other") + 1) * width, F.col("blocks")) - F.col("other") * width  # partitions of the other sub-butterfly
        asks = (active.select("grp", F.col("block").alias("asker"), "block", "blocks", own.alias("own"), F.explode(F.sequence(run, run + (fanout - 1))).alias("other"))
                .where((F.col("other") != F.col("own")) & (F.col("other") * width < F.col("blocks")))
                .select("grp", "asker", "other", (F.col("other") * width + (F.col("block") % width) % held).alias("block")))
        answers = (asks.join(active.select("grp", "block", "digest"), ["grp", "block"])
                   .groupBy("grp", F.col("asker").alias("block")).agg(F.sort_array(F.collect_list(F.struct("other", "digest"))).alias("got")))
        joined = active.join(answers, ["grp", "block"], "left").withColumn("own", own)
        got = F.coalesce(F.col("got"), F.expr("array()").cast("array<struct<other:bigint,digest:string>>"))

        def side(keep, got=got):
            return F.array_join(F.transform(F.filter(got, keep), lambda s: s["digest"]), "")

        joined = (joined.withColumn("l", side(lambda s: s["other"] < F.col("own"))).withColumn("r", side(lambda s: s["other"] > F.col("own")))
                  .select("grp", "block", "blocks", F.sha2(F.concat("l", "digest", "r").cast("binary"), 256).alias("digest"),
                          F.concat("path", F.array(F.struct("l", "r"))).alias("path")))
        state = stored(joined.unionByName(state.where(F.col("blocks") <= width)), "butterfly")
        width *= fanout
    return state


def _partitions(rows: DataFrame, fanout: int, height: int) -> tuple[DataFrame, DataFrame]:
    """Numbered rows (grp, pos, group_rows, digest, …) with their partition, and each partition's state
    after the exchange."""
    size = fanout**height
    rows = rows.withColumn("block", F.floor(F.col("pos") / size)).withColumn("blocks", F.ceil(F.col("group_rows") / size))

    def top(key, table):
        table = table.sort_by("pos")
        blocks = table.column("blocks")[0].as_py()
        root = climb(table.column("digest").to_pylist(), fanout, _height(blocks, height))[-1][0]
        return pa.table({"grp": [key[0].as_py()], "block": [key[1].as_py()], "blocks": [blocks], "digest": [root]},
                        schema=pa.schema([("grp", pa.string()), ("block", pa.int64()), ("blocks", pa.int64()), ("digest", pa.string())]))

    roots = rows.select("grp", "block", "blocks", "pos", "digest").groupBy("grp", "block").applyInArrow(top, "grp string, block long, blocks long, digest string")
    state = stored(roots.withColumn("path", F.expr("array()").cast(_PATH)), "partition-roots")
    return rows, _exchange(state, fanout)


def prove(rows: DataFrame, fanout: int, height: int, keep: list[str], order: list) -> tuple[DataFrame, DataFrame]:
    """Proofs inside the groups ``grp`` of stored rows with a ``digest``: the rows with their partition, and
    the partitions (grp, block, digest: subroot, path)."""
    return _partitions(numbered(rows, "grp", order, ["digest", *keep]), fanout, height)


def _paths_of(rows: DataFrame, state: DataFrame, fanout: int, height: int) -> DataFrame:
    """(name, root, path) of the rows of a small digest table (the subroots)."""

    def walk(key, left, right):
        left, up = left.sort_by("pos"), right.to_pylist()[0]
        levels = climb(left.column("digest").to_pylist(), fanout, _height(up["blocks"], height))
        upper = [(p["l"], p["r"]) for p in up["path"]]
        paths = [[{"l": a, "r": b} for a, b in siblings(levels, k, fanout) + upper] for k in range(len(left))]
        kind = pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))
        return pa.table({"name": left.column("name"), "root": pa.array([up["digest"]] * len(left), pa.string()), "path": pa.array(paths, kind)})

    return (rows.select("grp", "block", "pos", "digest", "name").groupBy("grp", "block")
            .cogroup(state.groupBy("grp", "block")).applyInArrow(walk, f"name string, root string, path {_PATH}"))


def manifest(docs: DataFrame, altered: dict[str, Column] | None = None, alter: Column | None = None, id_col: str = "doc_id", group_col: str = "lang",
             fields: tuple[str, ...] = FIELDS, fanout: int = 2, height: int = HEIGHT, with_path: bool = False) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of ``docs``.

    ``folded_root`` is computed from the row's leaf and proof.  Where ``alter`` holds, the leaf is that of
    the row with the columns ``altered`` instead: the check then has to find the change.  With ``with_path``
    also the proof itself: at each level the joined digests left (l) and right (r) in the run."""
    whole = leaf([docs[f] for f in fields])
    other = F.lit(None).cast("string")
    if alter is not None:
        other = F.when(alter, leaf([(altered or {}).get(f, docs[f]) for f in fields]))
    name = F.when(docs[group_col].isNull(), "").otherwise(F.concat(F.lit("="), docs[group_col].cast("string")))
    leaves = stored(docs.select(docs[id_col].alias("doc_id"), name.alias("grp"), whole.alias("digest"), other.alias("shown")), "leaves")
    rows, state = prove(leaves, fanout, height, ["doc_id", "shown"], [F.col("doc_id").asc_nulls_first(), "digest"])

    subroots = state.where("block = 0").select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    top_rows, top_state = prove(subroots, fanout, height, ["name"], ["name"])
    tops = _paths_of(top_rows, top_state, fanout, height).withColumnRenamed("path", "top")
    uppers = (state.join(tops, state["grp"] == tops["name"])
              .select("grp", "block", "blocks", F.col("digest").alias("subroot"), "root", F.concat("path", "top").alias("path")))

    def walk(key, left, right):
        left, up = left.sort_by("pos"), right.to_pylist()[0]
        digests, shown = left.column("digest").to_pylist(), left.column("shown").to_pylist()
        levels = climb(digests, fanout, _height(up["blocks"], height))
        upper = [(p["l"], p["r"]) for p in up["path"]]
        tail = "".join(a + b for a, b in upper)
        proofs, folded, paths = [], [], []
        for k, digest in enumerate(digests):
            mine = siblings(levels, k, fanout)
            proofs.append(sha256(("".join(a + b for a, b in mine) + tail).encode()).hexdigest())
            folded.append(fold(shown[k] or digest, mine + upper))
            if with_path:
                paths.append([{"l": a, "r": b} for a, b in mine + upper])
        n = len(digests)
        out = {"doc_id": left.column("doc_id"), "leaf": left.column("digest"), "subroot": pa.array([up["subroot"]] * n, pa.string()),
               "root": pa.array([up["root"]] * n, pa.string()), "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(folded, pa.string()),
               "verified": pa.array([f == up["root"] for f in folded], pa.bool_())}
        if with_path:
            out["path"] = pa.array(paths, pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())])))
        return pa.table(out)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return (rows.select("grp", "block", "pos", "digest", "shown", "doc_id").groupBy("grp", "block")
            .cogroup(uppers.groupBy("grp", "block")).applyInArrow(walk, schema + (f", path {_PATH}" if with_path else "")))


def tampered(docs: DataFrame) -> tuple[dict[str, Column], Column]:
    """The contract's change: one more character stated where 7 divides the CRC-32 of the decimal id."""
    hit = F.coalesce(F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 0, F.lit(False))
    return {"n_chars": docs["n_chars"] + 1}, hit
