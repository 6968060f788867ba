"""Widget-tree flattening: nested JSON tree → element rows → reading-order
text.

Each tree is parsed once inside ``mapInArrow`` and visited in one pass, with
no shuffle and no per-level job; memory is one tree plus a bounded batch of
rows.  ``screen_texts`` builds the text in that same pass, so element rows
are shuffled only when someone asks for them (``reading_order_text``).

Semantics:

* root = ``activity.root`` when ``activity`` is an object (a present-but-null
  root yields nothing), else the tree itself; a non-object tree → nothing;
* parents before children, children left to right; entries that are not
  objects are skipped; a ``children`` that is not a list is ignored;
* text / class stripped of all white space; an element is kept when either is
  non-empty; element type = last dotted part of the class;
* bounds: 4 entries converted with ``int`` (truncation), else zeros.

A tree that is not JSON, or nested deeper than the parser can follow, is a bad
record: ``bad_records`` lists it with the parser's message, ``strict=True``
raises instead, and by default the other trees go on.  ``activity: null``
falls back to the tree; bounds that ``int`` cannot convert (or that do not fit
64 bits) give zeros; scalar text or class is used in its string form, other
shapes as empty; characters that UTF-8 cannot hold (lone surrogates) become
``?``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import spread

ELEMENT_SCHEMA = "screen_id long, pos long, depth long, element_type string, text string, x1 long, y1 long, x2 long, y2 long"
TEXT_SCHEMA = "screen_id long, n_elements long, text_rep string"
BAD_SCHEMA = "screen_id long, error string, hierarchy_json string"
STATUS_SCHEMA = "screen_id long, ok boolean, error string, n_elements long"
FLUSH_ROWS = 65_536


class BadTree(ValueError):
    """A tree that cannot be parsed (strict mode)."""


def _label(value) -> str:
    """A text or class attribute as stripped text."""
    if isinstance(value, bool | int | float):
        value = str(value)
    return value.strip().encode("utf-8", "replace").decode() if isinstance(value, str) else ""


def _box(value) -> list[int]:
    """Four whole numbers, zeros when they are not there."""
    try:
        box = [int(v) for v in value] if isinstance(value, list) else []
    except (TypeError, ValueError, OverflowError):
        box = []
    return box if len(box) == 4 and all(abs(v) < 1 << 63 for v in box) else [0, 0, 0, 0]


def visit(tree) -> Iterator[tuple[int, dict]]:
    """(depth, node) of every object of a tree, parents first.

    One iterator per open level: the deepest one moves on, and a node with
    children opens the next level."""
    entry = tree
    if isinstance(tree, dict) and isinstance(tree.get("activity"), dict):
        entry = tree["activity"].get("root", tree)
    levels = [iter([entry] if isinstance(tree, dict) else [])]
    while levels:
        for node in levels[-1]:
            if isinstance(node, dict):
                yield len(levels) - 1, node
                if isinstance(node.get("children"), list):
                    levels.append(iter(node["children"]))
                    break
        else:
            levels.pop()


def walk(tree) -> list[list]:
    """Kept elements of a parsed tree: [depth, type, text, x1, y1, x2, y2]."""
    labelled = ((depth, _label(n.get("class")), _label(n.get("text")), n) for depth, n in visit(tree))
    return [[depth, cls.rpartition(".")[2], text, *_box(n.get("bounds"))] for depth, cls, text, n in labelled if cls or text]


def read_tree(raw: str | None):
    """(tree, None), or (None, why it is a bad record)."""
    if raw is None:
        return None, "no tree"
    try:
        return json.loads(raw), None
    except (ValueError, RecursionError) as exc:
        return None, f"{type(exc).__name__}: {exc}"


_ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}


def _per_tree(trees: DataFrame, key: str, json_col: str, make, schema: str, strict: bool) -> DataFrame:
    """``make(id, raw, elements or None, error)`` rows of every tree, in bounded batches.

    Ids go through Arrow as whole numbers: a null one does not change the others."""
    fields = [f.split() for f in schema.split(", ")]

    def rows_of(rows: list) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], [n for n, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list = []
        for batch in batches:
            for sid, raw in zip(batch.column("k").to_pylist(), batch.column("j").to_pylist(), strict=True):
                tree, error = read_tree(raw)
                if error and strict:
                    raise BadTree(f"screen {sid}: {error}")
                rows.extend(make(sid, raw, None if error else walk(tree), error))
                if len(rows) >= FLUSH_ROWS:
                    yield rows_of(rows)
                    rows = []
        if rows:
            yield rows_of(rows)

    return spread(trees.select(F.col(key).cast("long").alias("k"), F.col(json_col).alias("j"))).mapInArrow(run, schema)


def elements(trees: DataFrame, key: str = "screen_id", json_col: str = "hierarchy_json", strict: bool = False) -> DataFrame:
    """One row per kept element: ``screen_id, pos, depth, element_type, text,
    x1, y1, x2, y2`` (``pos`` = place among the tree's kept elements)."""

    def make(sid, raw, found, error):
        return [[sid, pos, *e] for pos, e in enumerate(found or [])]

    return _per_tree(trees, key, json_col, make, ELEMENT_SCHEMA, strict)


def screen_texts(trees: DataFrame, key: str = "screen_id", json_col: str = "hierarchy_json", strict: bool = False) -> DataFrame:
    """``screen_id, n_elements, text_rep`` of every parsed tree in one pass: its
    texts in reading order (top, then left, ties as visited) joined by blanks;
    ``n_elements`` counts elements with text."""

    def make(sid, raw, found, error):
        if error:
            return []
        texts = [e[2] for e in sorted(found, key=lambda e: (e[4], e[3])) if e[2]]
        return [[sid, len(texts), " ".join(texts)]]

    return _per_tree(trees, key, json_col, make, TEXT_SCHEMA, strict)


def bad_records(trees: DataFrame, key: str = "screen_id", json_col: str = "hierarchy_json") -> DataFrame:
    """Trees that cannot be parsed: ``screen_id, error, hierarchy_json``, whole."""

    def make(sid, raw, found, error):
        return [[sid, error, raw]] if error else []

    return _per_tree(trees, key, json_col, make, BAD_SCHEMA, False)


def tree_status(trees: DataFrame, key: str = "screen_id", json_col: str = "hierarchy_json") -> DataFrame:
    """Per tree: parsed or not, the parser's message, and the element count."""

    def make(sid, raw, found, error):
        return [[sid, error is None, error, len(found or [])]]

    return _per_tree(trees, key, json_col, make, STATUS_SCHEMA, False)


def reading_order_text(elems: DataFrame, key: str = "screen_id") -> DataFrame:
    """The text of stored element rows, in the same order as ``screen_texts``.

    One group per tree (bounded by the tree's size); the sort is an
    ``array_sort`` of structs inside the group."""
    # collect_list skips the nulls: a tree whose elements have no text gives ""
    item = F.when(F.col("text") != "", F.struct("y1", "x1", "pos", "text"))
    g = elems.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("s"))
    return g.select(key, F.size("s").cast("long").alias("n_elements"),
                    F.array_join(F.transform("s", lambda e: e["text"]), " ").alias("text_rep"))


def first_elements(elems: DataFrame, n: int = 10, key: str = "screen_id") -> DataFrame:
    """Preview: the first ``n`` elements of every tree in pre-order
    (``row_number`` per tree, planned as a group limit — no global sort)."""
    w = Window.partitionBy(key).orderBy("pos")
    return elems.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
