"""Operator 3 — SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits link at ``distance`` = 4 or fewer differing bits.  The bits are cut
into two segments of 32 with thresholds 2 and 1: two fingerprints at distance 4 are within the
threshold in one of them (beyond it in both, they would differ in 3 + 2 = 5 bits).  In both
segments the anchors are a covering code: the 31-bit Hamming code (covering radius 1) beside
one free bit, 2^27 anchors.  A fingerprint is replicated to every anchor within the covering
radius plus the half of the threshold that is its own: two fingerprints within the threshold
have a point between them, no more than that half from either, and meet at the anchor that
covers it.  That makes some 34 rows for a fingerprint.  (With the whole threshold on one side,
the other staying at its nearest anchor, it would be 190 rows.)  A covering code over all 64
bits would need tens of thousands of anchors for each fingerprint at this distance.

Equal fingerprints are one before all this.  Per anchor, all that meet are compared by
vectorised popcounts; only a spanning forest of the links leaves a task.  An anchor with more
than ``BLOCK`` fingerprints is cut into blocks whose pairs are compared in tasks of their own,
so no group is larger than two blocks.

Defined cases: null and wordless texts have fingerprint zero and link like any
other; a document with fewer than four words has one shingle, all its words; a
null id takes part in linking but never names a component unless nothing else
could (then the component is null); repeated rows are in one component; an empty
table gives no rows; whole texts are read.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import docs_column, stored, utf8, whole_rows
from tessera.llm.components import components
from tessera.session import broadcast_if_small

SEED = 42
BLOCK = 20_000
PAIRS = 4_000_000  # comparisons held at once by a task
SEGMENTS = ((0, 32, 2), (32, 32, 1))  # first bit, bits, threshold
CODE_BITS, RADIUS = 31, 1  # the Hamming code and its covering radius
_hash = partial(xxhash.xxh64_intdigest, seed=SEED)


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """SimHash of a text's word shingles (repeats included)."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return _hash(b" ".join(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - shingle + 1].tolist()
    stops = (ends[shingle - 1:] - 1).tolist()
    hashes = np.array([_hash(joined[a:b]) for a, b in zip(starts, stops, strict=True)], "<u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[k: k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long) of every row."""

    def run(batches):
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in utf8(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


# -- anchors ------------------------------------------------------------------------------------


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Hamming syndrome of words of ``CODE_BITS`` bits: the XOR of their set positions, counted from 1."""
    out = np.zeros(len(words), np.int64)
    for k in range(CODE_BITS):
        out ^= np.where(words >> k & 1, k + 1, 0)
    return out


def _masks(bits: int, reach: int) -> list[np.ndarray]:
    """For each syndrome, what to flip in a segment value to get to every anchor within ``reach``."""
    tables: list[list[int]] = [[] for _ in range(CODE_BITS + 1)]
    for w in range(reach + 1):
        for flips in combinations(range(bits), w):
            syndrome = 0
            for k in flips:
                syndrome ^= k + 1 if k < CODE_BITS else 0
            tables[syndrome].append(sum(1 << k for k in flips))
    return [np.array(t, np.int64) for t in tables]


_TABLES = [_masks(bits, RADIUS + (threshold + 1) // 2) for _, bits, threshold in SEGMENTS]


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, position in ``fps``, compared) of every replica; all are compared."""
    found, at = [], []
    for k, (first, bits, _) in enumerate(SEGMENTS):
        value = (fps >> np.uint64(first) & np.uint64((1 << bits) - 1)).astype(np.int64)
        syndrome = _syndrome(value & ((1 << CODE_BITS) - 1))
        for s, masks in enumerate(_TABLES[k]):
            rows = np.flatnonzero(syndrome == s)
            found.append((k << 32 | (value[rows][:, None] ^ masks)).ravel())
            at.append(np.repeat(rows, len(masks)))
    anchor, at = np.concatenate(found), np.concatenate(at)
    return anchor, at, np.ones(len(anchor), bool)


def _replicas(distinct: DataFrame) -> DataFrame:
    """(anchor, fp) rows of every fingerprint."""

    def run(batches):
        for batch in batches:
            fps = np.asarray(batch.column("fp")).view(np.uint64)
            for k in range(0, len(fps), 4096):
                part = fps[k: k + 4096]
                anchor, at, _ = anchors(part)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(part[at].view(np.int64))], ["anchor", "fp"])

    return distinct.select("fp").mapInArrow(run, "anchor long, fp long")


# -- links --------------------------------------------------------------------------------------


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links (a, b): each node with the smallest of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        la, lb = label[a], label[b]
        if np.array_equal(la, lb):
            break
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while not np.array_equal(label, label[label]):
            label = label[label]
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def links_of_groups(group: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest of the links between fingerprints of equal ``group`` (sorted by group)."""
    cut = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.append(cut, len(group)))
    start, count = np.repeat(cut, size), np.repeat(size, size)
    at = np.flatnonzero(count > 1)
    found_a, found_b = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    ends = np.cumsum(count[at])
    done = 0
    while done < len(at):
        base = ends[done - 1] if done else 0
        stop = max(done + 1, int(np.searchsorted(ends, base + PAIRS, "right")))
        mine = at[done:stop]
        n = count[mine]
        left = np.repeat(mine, n)
        right = np.repeat(start[mine] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        near = (np.bitwise_count(fps[left] ^ fps[right]) <= distance) & (fps[left] != fps[right])
        if near.any():
            found_a, found_b = forest(np.concatenate([found_a, fps[left[near]]]), np.concatenate([found_b, fps[right[near]]]))
        done = stop
    return found_a, found_b


def links(distinct: DataFrame, distance: int = 4, block: int = BLOCK) -> DataFrame:
    """(u, v) links between the distinct fingerprints ``fp``: every pair within ``distance`` is
    connected by them, and each is such a pair's tree edge."""
    if sum(t + 1 for _, _, t in SEGMENTS) <= distance:
        raise ValueError(f"these segments cover distances up to {sum(t + 1 for _, _, t in SEGMENTS) - 1}")
    rows = _replicas(distinct)
    hot = rows.groupBy("anchor").count().where(F.col("count") > block).select("anchor", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    hot = stored(hot, "hot-anchors")
    if hot.isEmpty():
        rows = rows.withColumn("pair", F.lit(0).cast("long"))
    else:
        own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
        pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1), lambda j: F.least(own, j) * F.lit(1 << 20) + F.greatest(own, j))
        rows = rows.join(broadcast_if_small(hot), "anchor", "left").select(
            "anchor", "fp", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(pairs)).alias("pair"))

    def run(batches):
        keys, fps = [], []

        def flush(last: bool):
            """Compare whole groups; what may go on in the next batch stays."""
            key, fp = np.concatenate(keys), np.concatenate(fps)
            stop = len(key) if last else int(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))[-1])
            keys[:], fps[:] = [key[stop:]], [fp[stop:]]
            if stop:
                u, v = links_of_groups(key[:stop], fp[:stop], distance)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        held = 0
        for batch in batches:
            # anchor (33 bits) and block pair in one number, equal in a group; should two neighbours ever
            # have the same, they are compared as one group, which loses nothing
            key = np.asarray(batch.column("anchor")) * 1_000_003 ^ np.asarray(batch.column("pair")) << 1
            keys.append(key)
            fps.append(np.asarray(batch.column("fp")).view(np.uint64))
            held += len(key)
            if held > 300_000:
                yield from flush(False)
                held = sum(map(len, keys))
        if held:
            yield from flush(True)

    dealt = rows.repartition("anchor", "pair").sortWithinPartitions("anchor", "pair")
    return dealt.mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (hex), component_id of every row."""
    prints = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    found = _by_fingerprint(prints, distance)
    return prints.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _by_fingerprint(prints: DataFrame, distance: int) -> DataFrame:
    """(fp, component, component_id): the linked class of each distinct fingerprint, its smallest doc_id."""
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    classes = components(links(distinct, distance))
    labelled = distinct.join(classes, distinct["fp"] == classes["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    names = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    return labelled.join(names, "component").select("fp", "least", "component", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id; of rows that share
    that id and fingerprint, the one with the smallest hash of the whole row.

    A row travels as one column, so its columns may have any names."""
    carried = whole_rows(docs).select("row", docs_column("row", id_col).alias("doc_id"), docs_column("row", text_col).alias("text"))

    def run(batches):
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in utf8(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(found.view(np.int64))], ["row", "doc_id", "fp"])

    schema = T.StructType([*carried.schema.fields[:2], T.StructField("fp", T.LongType())])
    marked = stored(carried.mapInArrow(run, schema), "marked", "zstd")
    found = _by_fingerprint(marked.select("doc_id", "fp"), distance)
    # among a component's fingerprints whose smallest id is the component's, the smallest fingerprint
    kept = (found.where(F.col("least").eqNullSafe(F.col("component_id"))).groupBy("component").agg(F.min(F.struct("fp", "least")).alias("k"))
            .select(F.col("k.fp").alias("fp"), F.col("k.least").alias("least")))
    joined = marked.join(kept, "fp").where(F.col("doc_id").eqNullSafe(F.col("least")))
    first = Window.partitionBy("fp").orderBy(F.xxhash64("row"), F.crc32(F.to_json("row").cast("binary")))
    return joined.withColumn("nth", F.row_number().over(first)).where("nth = 1").select("row.*")
