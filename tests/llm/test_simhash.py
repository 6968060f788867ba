"""Fingerprints, links and components against brute force."""

import numpy as np
import pytest
import xxhash

from tessera.llm import simhash
from tessera.llm.components import components
from tests.conftest import SF_SMALL


def plain_fingerprint(text, n=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k:k + n]) for k in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, distance=4):
    label = {f: f for f in fps}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    fps = sorted(set(fps))
    for k, a in enumerate(fps):
        for b in fps[k + 1:]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {f: root(f) for f in fps}


def test_query_equals_brute_force(spark):
    from tessera.llm.queries import op3_simhash

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    classes = plain_components(prints.values())
    least = {}
    for i, f in prints.items():
        least[classes[f]] = min(least.get(classes[f], i), i)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op3_simhash(spark, SF_SMALL).collect()}
    assert got == {i: (f"{f:016x}", least[classes[f]]) for i, f in prints.items()}


def test_every_close_pair_meets_at_an_anchor():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    for flips in range(1, 5):
        for x in base:
            y = x
            for b in rng.choice(64, flips, replace=False):
                y ^= np.uint64(1) << np.uint64(b)
            a, at, home = simhash.anchors(np.array([x, y], np.uint64))
            homes = set(a[(at == 0) & home].tolist())
            assert homes & set(a[at == 1].tolist())


@pytest.mark.parametrize("block", [8, simhash.BLOCK])
def test_links_of_a_crowded_neighbourhood(spark, block):
    rng = np.random.default_rng(2)
    fps = set(rng.integers(0, 2**63, 200, dtype=np.uint64).tolist())
    for centre in list(fps)[:3]:  # clusters whose members differ in a few bits
        for _ in range(60):
            f = centre
            for b in rng.choice(64, rng.integers(1, 4), replace=False):
                f ^= 1 << int(b)
            fps.add(f)
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    found = {r.node % (1 << 64): r.component for r in components(simhash.links(frame, block=block)).collect()}
    want = plain_components(fps)
    groups = {}
    for f in fps:
        groups.setdefault(want[f], set()).add(found.get(f, ("alone", f)))
    assert all(len(g) == 1 for g in groups.values()) and len({x for g in groups.values() for x in g}) == len(groups)


def test_components_of_chains_and_stars(spark):
    chain = [(k + 1, k) for k in range(100, 140)]
    star = [(k, 7) for k in range(200, 260)]
    frame = spark.createDataFrame(chain + star + [(5, 5)], "u long, v long")
    got = {r.node: r.component for r in components(frame).collect()}
    assert got == {k: 100 for k in range(100, 141)} | {k: 7 for k in [7, *range(200, 260)]}


def test_edges(spark, edge, nothing):
    rows = simhash.near_duplicates(edge).collect()
    assert len(rows) == edge.count()
    by = {(r.doc_id, r.fingerprint): r.component_id for r in rows}
    zero = "0" * 16
    assert by[3, zero] == by[4, zero] == by[5, zero] == by[None, zero] == 3
    kept = simhash.one_of_each(edge)
    assert kept.columns == edge.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and set(ids) == {r.component_id for r in rows}
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.one_of_each(nothing).count() == 0
