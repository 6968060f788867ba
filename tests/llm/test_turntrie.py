"""The conversation trie against a plain dictionary of prefixes."""

import random
import zlib
from hashlib import sha256

import pytest

from tessera.llm import turntrie
from tests.conftest import SF_SMALL

FIELDS = "conv_id long, turn long, role string, text string, name string, depth int, part string, total string"


def plain_trie(rows):
    """rows: (conv_id, turn, role, text) -> sorted result tuples."""
    talks = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            talks.setdefault(conv, []).append((turn is not None, turn or 0, (role or "", text or "")))
    talks = {c: [t[2] for t in sorted(v, key=lambda t: t[:2])] for c, v in talks.items()}
    whole = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(talks.get(c - c % 5, [])[:h] + own[h:])
    members, ends = {}, {}
    for c, seq in whole.items():
        ends.setdefault(seq, []).append(c)
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children, leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()) for p, m in members.items()), key=str)


def run(talks, **options):
    return sorted((tuple(r) for r in turntrie.conversation_trie(talks, **options).collect()), key=str)


def test_query_equals_plain_trie(spark):
    talks = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    assert run(talks) == plain_trie([tuple(r) for r in talks.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize(("leaf", "chunk"), [(1, 3), (2, 50), (16, 4096)])
def test_deep_shared_conversations(spark, leaf, chunk):
    """Prefixes shared at many depths, long conversations, a group of copies, turns out of order."""
    rng, rows = random.Random(4), []
    base = [("user", f"t{rng.randrange(3)}") for _ in range(41)]
    for c in range(60):
        if c % 3 == 0:
            seq = list(base)  # a third are copies
        else:
            keep = rng.choice([0, 1, 5, 16, 17, 33, 40])
            seq = base[:keep] + [(rng.choice(["user", "assistant"]), f"é{rng.randrange(2)}") for _ in range(rng.randrange(12))]
        rows += [(c, k, role, text, "x", 1, "p", "q") for k, (role, text) in enumerate(seq)]
    rng.shuffle(rows)
    assert run(spark.createDataFrame(rows, FIELDS), leaf=leaf, chunk=chunk) == plain_trie([r[:4] for r in rows])


def test_edges(spark):
    rows = [(1, None, None, None), (1, 0, "user", "hi"), (1, 5, None, "x" * 100_000), (None, 0, "user", "lost"), (2, 0, "user", ""), (7, 3, "user", "hi"),
            (10, 0, "a", "same"), (10, 1, "a", "same"), (11, 0, "a", "same"), (11, 1, "a", "same"), (13, 0, "r", "t"), (13, 1, "r", "t"), (13, 1, "r", "t")]
    frame = spark.createDataFrame([(*r, "x", 1, "p", "q") for r in rows], FIELDS)
    for leaf in (1, 16):
        assert run(frame, leaf=leaf) == plain_trie(rows)
    assert run(frame.limit(0)) == []
    only = frame.where("conv_id = 2")
    assert run(only) == plain_trie([r for r in rows if r[0] == 2])
