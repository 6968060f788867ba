"""Language-model scores against a plain model held in dictionaries."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import ppm
from tests.conftest import SF_SMALL


class Plain:
    def __init__(self, texts):
        self.words, self.trie = Counter(), [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
        for w in texts:
            self.words.update([*w, ppm.END])
            s = self.stream(w)
            for p in range(ppm.ORDER, len(s)):
                for k, table in enumerate(self.trie):
                    table[s[p - k:p]][s[p]] += 1
        self.n, self.v = sum(self.words.values()), len(self.words)

    @staticmethod
    def stream(words):
        return ppm.END * ppm.ORDER + b" ".join(words) + ppm.END

    def base(self, w):
        return sum(math.log10((self.words[x] + 1) / (self.n + self.v + 1)) for x in [*w, ppm.END])

    def one(self, context, symbol):
        out, gone = 0.0, set()
        for k in range(ppm.ORDER, -1, -1):
            seen = self.trie[k].get(context[len(context) - k:])
            if not seen:
                continue
            total = sum(n for b, n in seen.items() if b not in gone)
            kinds = len(set(seen) - gone)
            if symbol in seen:
                return out + math.log10(seen[symbol] / (total + kinds))
            if kinds:
                out += math.log10(kinds / (total + kinds))
            gone = set(seen)
        return out - math.log10(256 - len(gone))

    def score(self, w):
        s = self.stream(w)
        return sum(self.one(s[p - ppm.ORDER:p], s[p]) for p in range(ppm.ORDER, len(s)))


def _check(rows, texts, held):
    plain = Plain([w for i, w in texts if not held(i)])
    want = sorted((str(i), held(i), len(w) + 1, sum(plain.words[x] > 0 for x in [*w, ppm.END]), plain.n, plain.base(w), plain.score(w)) for i, w in texts)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-5)


@pytest.mark.parametrize("block", [3_000, 8 << 20])
def test_scores_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ppm, "BLOCK_BYTES", block)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("length(text) < 1200 or text is null")  # the plain model is slow
    held = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 2
    texts = [(r.doc_id, (r.text or "").encode().lower().split()) for r in docs.collect()]
    _check(ppm.score(docs, held).collect(), texts, lambda i: zlib.crc32(str(i).encode()) % 7 == 2)


def test_edges(spark, edge, nothing):
    small = edge.where("n_chars < 1000 or n_chars is null")
    texts = [(r.doc_id, (r.text or "").encode().lower().split()) for r in small.collect()]
    _check(ppm.score(small, small["doc_id"] == 8).collect(), texts, lambda i: i == 8)
    assert ppm.score(nothing, nothing["doc_id"] == 1).count() == 0
    alone = ppm.score(small, F.lit(True)).collect()  # nothing to learn from: every byte is uniform
    assert all(r.score == pytest.approx(-math.log10(256) * len(Plain.stream(w)[ppm.ORDER:]), rel=1e-6)
               for r, w in zip(sorted(alone, key=lambda r: (r.doc_id or 0, r.n_tokens)), [w for _, w in sorted(texts, key=lambda x: (x[0] or 0, len(x[1])))]))


def test_probabilities_sum_to_one():
    plain = Plain([b"the cat sat on the mat".split(), b"a cat and a hat".split()])
    for context in (b"e cat", b"zzzcat"[1:], b"zzzzz", b"\n\n\n\n\n"):
        assert sum(10 ** plain.one(context, s) for s in range(256)) == pytest.approx(1)


def _some(spark, n):
    texts = [f"tale {k} of the {k * k % 101} ships, sailing past {k % 17} isles" for k in range(n)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), [(k, t.lower().encode().split()) for k, t in enumerate(texts)]


@pytest.mark.parametrize("buckets", [1, 7, 3000])
def test_number_of_buckets_does_not_change_the_scores(spark, monkeypatch, buckets):
    monkeypatch.setattr(ppm, "BLOCK_DOCS", 9)
    docs, texts = _some(spark, 60)
    _check(ppm.score(docs, F.col("doc_id") % 4 == 1, buckets=buckets).collect(), texts, lambda i: i % 4 == 1)


def test_requests_are_bounded_by_strings_and_words(spark, monkeypatch):
    monkeypatch.setattr(ppm, "BLOCK_DOCS", 9)
    written = []
    for n in (60, 120, 240):
        docs, _ = _some(spark, n)
        packed = ppm.blocks(docs.coalesce(1).withColumn("held", F.lit(False)))
        needs = sum(len(b.strings()[0]) + len({w for d in b.documents() for w in d}) + 1 for b in map(ppm.Block, (r.asDict() for r in packed.collect())))
        rows = ppm.requests(packed, 10**7 * n)  # far more buckets than strings
        assert rows.select("block", "bucket").distinct().count() == rows.count() <= needs
        written.append(rows.count())
    assert written[1] <= 2.1 * written[0] and written[2] <= 2.1 * written[1]
