"""Links and components of the n-gram join against brute force over all pairs."""

import random
from fractions import Fraction

import pytest

from tessera.llm import ngramjoin
from tests.conftest import SF_SMALL


def plain_set(text, n=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[k:k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def plain_components(rows, like=Fraction(4, 5)):
    """rows: (doc_id, text) -> sorted (doc_id, n, component)."""
    sets = [plain_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and len(sets[a] & sets[b]) >= like * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted(((i, len(sets[k]), least.get(root(k))) for k, (i, _) in enumerate(rows)), key=str)


def run(docs):
    return sorted((tuple(r) for r in ngramjoin.near_duplicates(docs).collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert run(docs) == plain_components([(r.doc_id, r.text) for r in docs.collect()])


def crowd(rng):
    """Copies, near copies around a few texts, chains of small changes, documents that share a passage."""
    def words(n):
        return [f"w{rng.randrange(5000)}" for _ in range(n)]

    texts, passage = [], words(60)
    for size in (30, 80, 120):
        base = words(size)
        texts += [base] * 5
        for _ in range(40):
            t = list(base)
            for _ in range(rng.randrange(1, 4)):
                t[rng.randrange(len(t))] = "x" + str(rng.randrange(10**6))
            texts.append(t)
    step = words(100)
    for k in range(20):  # each is near the one before, the ends are far apart
        step = step[1:] + [f"s{k}"]
        texts.append(step)
    texts += [passage + words(rng.randrange(4, 40)) for _ in range(40)] + [words(n) for n in (0, 1, 3, 4, 5, 6)] + [["a", "b"], ["A", "b"]]
    return [(k * 3 + 1, " ".join(t)) for k, t in enumerate(texts)]


@pytest.mark.parametrize(("stars", "block", "fragments"), [(0, 3, 1), (1, 7, 3), (4, 2_000, 8)])
def test_crowded_neighbourhoods(spark, monkeypatch, stars, block, fragments):
    """The links must not depend on the rounds, blocks or fragments, nor on what counts as hot."""
    rows = crowd(random.Random(7))
    if stars == 1:
        monkeypatch.setattr(ngramjoin, "HOT_LEAST", 4)
        monkeypatch.setattr("tessera.llm.order.HOT_LEAST", 4)
    monkeypatch.setattr(ngramjoin.classes, "__defaults__", (ngramjoin.LIKE, fragments, stars, block))
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == plain_components(rows)


def test_edges(spark, edge, nothing):
    got = run(edge)
    want = plain_components([(r.doc_id, r.text) for r in edge.collect()])
    assert [g for g in got if g[1]] == [w for w in want if w[1]]
    assert all(g[2] == g[0] for g in got if not g[1])
    assert run(nothing) == []


def test_threshold_is_exact(spark):
    """Overlap of exactly four fifths of the union links, one less does not."""
    a = [f"a{k}" for k in range(22)]  # 18 n-grams
    rows = [(1, " ".join(a)), (2, " ".join(a[:20]) + " z1 z2")]  # 16 of 20
    rows += [(3, " ".join(f"b{k}" for k in range(13))), (4, " ".join([*(f"b{k}" for k in range(12)), "y"]))]  # 8 of 10
    rows += [(5, " ".join(f"c{k}" for k in range(12))), (6, " ".join([*(f"c{k}" for k in range(11)), "y"]))]  # 7 of 9
    got = {r[0]: r[2] for r in run(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6}
