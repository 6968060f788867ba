"""Whole queries against plain single-process versions: quality verdicts, toxicity scores, parts of the vector search."""

import math
import re
import string
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import ann, quality, queries, toxicity
from tests.conftest import SF_MID

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


# -- quality rules --------------------------------------------------------------------------


def _base_failed(text):
    words = WORDS.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)}
    return len(words) < 50 or 100 * len(covered) > 50 * len(words)


def _character_shares(text):
    counts = [0] * 7
    for c in text:
        if ord(c) > 127:
            counts[6] += 1
        elif c in string.ascii_lowercase:
            counts[0] += 1
        elif c in string.ascii_uppercase:
            counts[1] += 1
        elif c in string.digits:
            counts[2] += 1
        elif c in " \t\n\v\f\r":
            counts[3] += 1
        elif c in ".,;:!?\"'()-":
            counts[4] += 1
        else:
            counts[5] += 1
    return [c / sum(counts) for c in counts]


def _word_shares(text):
    words = [w.strip(".,;:!?\"'()-") for w in WORDS.findall(text.translate(UPPER))]
    return {w: n / len(words) for w, n in Counter(words).items()}


def _jensen_shannon(p, q):
    total = 0.0
    for a, b in zip(p, q, strict=True):
        m = (a + b) / 2
        total += (a * math.log2(a / m) if a else 0) + (b * math.log2(b / m) if b else 0)
    return math.sqrt(max(0.0, total / 2))


def test_verdicts_equal_a_plain_version(spark):
    rows = spark.read.parquet(f"{SF_MID}/documents.parquet").collect()
    texts = defaultdict(set)
    for r in rows:
        if not _base_failed(r.text or ""):
            texts[r.lang].add(r.text)
    reference = {}
    for lang, some in texts.items():
        words, chars = Counter(), np.zeros(7)
        for t in some:
            words.update(_word_shares(t))
            chars += _character_shares(t)
        common = sorted(words, key=lambda w: (-words[w], w.encode()))[:48]
        shares = [words[w] / len(some) for w in common]
        reference[lang] = common, [*shares, 1 - sum(shares)], (chars / len(some)).tolist()
    got = {r.doc_id: r for r in queries.op10_quality(spark, SF_MID).collect()}
    judged = close = rejected = 0
    for r in rows:
        text = r.text or ""
        if _base_failed(text):
            assert not got[r.doc_id].kept
            continue
        common, words_ref, chars_ref = reference[r.lang]
        own, n = _word_shares(text), len(WORDS.findall(text))
        own = [own.get(w, 0) for w in common]
        word = _jensen_shannon([*own, max(0.0, 1 - sum(own))], words_ref)
        char = _jensen_shannon(_character_shares(text), chars_ref)
        assert got[r.doc_id].word_distance == pytest.approx(word, abs=2e-3) and got[r.doc_id].char_distance == pytest.approx(char, abs=2e-3)
        room = min(max(0.30, 0.08 + 3.4 / n**0.5) - word, max(0.0, 0.16 + 1.2 / n**0.5) - char)
        judged += 1
        if abs(room) < 2e-3:  # the query's weights are millionths
            close += 1
            continue
        rejected += room < 0
        assert got[r.doc_id].kept == (room > 0)
    assert judged > 500 and rejected > 10 and close < 0.02 * judged


# -- toxicity -------------------------------------------------------------------------------


def _plain_features(text):
    found = set()
    for w in text.translate(UPPER).split(" ") if not re.search(r"[\t-\r]", text) else WORDS.findall(text.translate(UPPER)):
        core = w.strip(string.punctuation)
        if core:
            found.add(xxhash.xxh32_intdigest(core.encode()) % toxicity.DIMS)
            found |= {xxhash.xxh32_intdigest(("^" + core[:k]).encode()) % toxicity.DIMS for k in (4, 5, 6, 7) if len(core) > k}
    return found


def test_toxicity_query_equals_a_plain_version(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect() if r.toxic is not None and r.doc_id in texts}
    assert len(labels) <= toxicity.SAMPLE  # the sample is all of them
    known = {i: _plain_features(texts[i]) for i in labels}
    toxic_in, all_in = Counter(), Counter()
    for i, found in known.items():
        all_in.update(found)
        if labels[i]:
            toxic_in.update(found)
    bad = sorted(i for i in labels if labels[i])
    telling = {f for f, n in all_in.items() if n >= 3 and math.log((toxic_in[f] + 0.5) / (len(bad) + 1)) - math.log((n - toxic_in[f] + 0.5) / (len(labels) - len(bad) + 1)) > 2}
    by_density = sorted(bad, key=lambda i: (len(telling & known[i]) / max(1, len(WORDS.findall(texts[i]))), i))
    grades = dict.fromkeys(labels, 0) | {i: 1 + place * 3 // len(bad) for place, i in enumerate(by_density)}
    order = sorted(labels)
    model = toxicity.fit([np.array(sorted(known[i]), np.int64) for i in order], np.array([grades[i] for i in order]), 4)
    weight = dict(zip(model.index.tolist(), model.weight.tolist(), strict=True))
    rows = queries.op6_toxicity(spark, SF_MID).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        s = sum(weight.get(f, 0.0) for f in _plain_features(texts[r.doc_id]))
        reach = [1 / (1 + math.exp(-min(60, max(-60, s - t)))) for t in model.thresholds]
        exact = [a - b for a, b in zip([1, *reach], [*reach, 0], strict=True)]
        assert r.p_toxic == pytest.approx(reach[0], abs=1e-6) and r.severity == pytest.approx(sum(reach), abs=1e-6)
        assert r.toxic == (r.p_toxic >= 0.3) and exact[r.grade] == pytest.approx(max(exact), abs=1e-6)


def _loss(x, grades, w, thresholds, l1):
    up = np.hstack([np.ones((len(x), 1)), 1 / (1 + np.exp(-(x @ w)[:, None] + thresholds)), np.zeros((len(x), 1))])
    rows = np.arange(len(x))
    return -np.log(np.maximum(up[rows, grades] - up[rows, grades + 1], 1e-12)).mean() + l1 * np.abs(w).sum()


def test_ordinal_fit_reaches_the_loss_of_a_plain_fit():
    """Proximal gradient steps with gradients by differences of each row's probability, to the end."""
    rng, l1 = np.random.default_rng(7), 2e-3
    x = (rng.random((400, 20)) < 0.3).astype(float)
    latent = x[:, :6] @ np.array([2.0, 1.5, 1.0, -1.0, -1.5, 0.5]) + rng.logistic(size=400)
    grades = np.digitize(latent, [0.5, 1.5, 3.0])
    model = toxicity.fit([np.flatnonzero(r) for r in x], grades, 4, steps=2000, l1=l1)
    w = np.zeros(20)
    w[model.index] = model.weight
    own, best = _loss(x, grades, w, model.thresholds, l1), np.inf
    plain, cut = np.zeros(20), np.array([-0.5, 0.5, 1.5])
    rows = np.arange(400)
    for _ in range(6000):
        up = np.hstack([np.ones((400, 1)), 1 / (1 + np.exp(-(x @ plain)[:, None] + cut)), np.zeros((400, 1))])
        slope, p = up * (1 - up), up[rows, grades] - up[rows, grades + 1]
        low, high = slope[rows, grades] / p, slope[rows, grades + 1] / p
        plain -= 0.5 * x.T @ (high - low) / 400
        plain = np.sign(plain) * np.maximum(np.abs(plain) - 0.5 * l1, 0)
        cut -= 0.5 * np.array([low[grades == j].sum() - high[grades == j - 1].sum() for j in (1, 2, 3)]) / 400
        best = min(best, _loss(x, grades, plain, cut, l1))
    assert own <= best * 1.005 and np.abs(w - plain).max() < 0.1 and np.abs(model.thresholds - cut).max() < 0.1


# -- vector search --------------------------------------------------------------------------


def test_under_half_of_the_pairs_are_compared(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toArrow()
    at, x = ann.matrix(table["embedding"].combine_chunks())
    asks = np.asarray(table["vec_id"])[at] % 100 == 0
    router = ann.fit(x)
    scores = router.scores(x)
    sizes = np.bincount(scores.argmax(axis=1), minlength=scores.shape[1])
    compared = sum(sizes[np.argsort(-s, kind="stable")[:router.probes]].sum() for s in scores[asks])
    assert scores.shape[1] >= 128 and compared < 0.5 * asks.sum() * len(x)


def test_one_id_on_a_third_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL", 60)
    monkeypatch.setattr(ann, "QUERIES", 2)
    rng = np.random.default_rng(11)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(1, 400)] + [(77, [0.5] * 6)] * 200
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in ann.search(frame, F.col("vec_id") % 50 == 0, k=500, parts=1).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
    for q in range(50, 400, 50):
        own = next(np.array(v) for i, v in rows if i == q)
        want = sorted((float(np.sqrt(((np.array(v) - own) ** 2).sum())), i) for i, v in rows if i != q)[:500]
        assert [i for _, i in got[q]] == [i for _, i in want] and [s for s, _ in got[q]] == pytest.approx([s for s, _ in want])
