"""The manifest against a plain tree of Python lists."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tessera.llm import merkle
from tests.conftest import SF_SMALL


def h(text):
    return sha256(text.encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text):
    out = b""
    for v in (doc_id, source, lang, n_chars, text):
        raw = None if v is None else str(v).encode()
        out += b"-" if raw is None else str(len(raw)).encode() + b":" + raw
    return sha256(out).hexdigest()


def plain_tree(leaves, k):
    """Root and, for each leaf, [(left, right)] by level."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for n, a in enumerate(at):
            run = a - a % k
            paths[n].append(("".join(level[run:a]), "".join(level[a + 1:run + k])))
            at[n] = a // k
        level = [h("".join(level[j:j + k])) for j in range(0, len(level), k)]
    return level[0], paths


def plain_manifest(rows, k=2):
    """rows: (doc_id, source, lang, n_chars, text) -> sorted result tuples."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, plain_leaf(*r), r))
    order = sorted(groups, key=lambda g: b"" if g is None else b"=" + g.encode())
    trees = {g: plain_tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], k) for g in order}
    root, tops = plain_tree([trees[g][0] for g in order], k)
    out = []
    for n, g in enumerate(order):
        for m, (_, _, leaf, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            path = trees[g][1][m] + tops[n]
            shown = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                shown = plain_leaf(r[0], r[1], r[2], None if r[3] is None else r[3] + 1, r[4])
            for a, b in path:
                shown = h(a + shown + b)
            out.append((r[0], leaf, trees[g][0], root, h("".join(a + b for a, b in path)), shown, shown == root))
    return sorted(out, key=str)


def run(docs, **options):
    altered, hit = merkle.tampered(docs)
    return sorted((tuple(r) for r in merkle.manifest(docs, altered, hit, **options).collect()), key=str)


def fields_of(df):
    return [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()]


@pytest.mark.parametrize(("fanout", "height"), [(2, 1), (2, 3), (3, 2), (2, merkle.HEIGHT)])
def test_equals_plain_tree(spark, fanout, height):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = run(docs, fanout=fanout, height=height)
    assert got == plain_manifest(fields_of(docs), fanout)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("height", [1, 4])
def test_edges(spark, edge, nothing, height):
    assert run(edge, height=height) == plain_manifest(fields_of(edge))
    assert run(nothing) == []
    one = edge.where("doc_id = 7")
    assert run(one) == plain_manifest(fields_of(one))


def test_many_groups_and_one_large(spark):
    docs = spark.range(700).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.when(F.col("id") % 3 == 0, "en").otherwise(F.concat(F.lit("l"), F.col("id") % 101)).alias("lang"),
        F.lit(4).cast("long").alias("n_chars"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    assert run(docs, height=2) == plain_manifest(fields_of(docs))


def test_paths_fold_to_the_root(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for r in merkle.manifest(docs, with_path=True, height=2).collect():
        assert merkle.fold(r.leaf, [(p.l, p.r) for p in r.path]) == r.root == r.folded_root
        assert h("".join(p.l + p.r for p in r.path)) == r.proof_sha256
