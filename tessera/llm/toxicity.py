"""Operator 6 — toxicity by cumulative-link ordinal regression.

Severity grades 0 … K - 1 are predicted from sparse text features (which words a
document holds, and how they begin, hashed).  One weight vector is shared by all grades; ordered
thresholds cut its score: P(grade ≥ k) = sigmoid(w·x - θ_k).  The result is the
expected severity, the sum of these probabilities over k ≥ 1.

The model is fitted on a bounded sample of labelled rows: about ``SAMPLE`` rows (twice
as many at most) by a hash of their id.  Labels that only say toxic or not are graded
first: grade 0 is not toxic; toxic rows are ranked by the density of words that
are much more frequent in toxic rows, and cut into ``GRADES`` - 1 equal groups.
All documents are scored, whole texts.

Words are lower-cased (A-Z) and lose ASCII punctuation and symbols at both ends.

Defined cases: null text has no words and scores like an empty one; a label of an
unknown document, a null label and a null id are not learned from; a document
labelled twice is learned from by its larger label, a repeated id once; without labels of both kinds
the weights are zero and every document gets the labels' average; repeated rows
score alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import string
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import Memo
from tessera.llm.common import sample_by_hash, utf8

SAMPLE, GRADES, DIMS = 10_000, 4, 1 << 20
BEGINNINGS = (4, 5, 6, 7)  # characters of a word's beginning that are features too
MIN_DOCS = 3  # a feature is learned if it occurs in so many sample rows
_EDGE = string.punctuation.encode()


def word_features(word: bytes) -> tuple[int, ...]:
    """Hashed features of a word: itself and its beginnings."""
    core = word.strip(_EDGE)
    if not core:
        return ()
    text = core.decode("utf-8", "replace")
    parts = [core] + [b"^" + text[:k].encode() for k in BEGINNINGS if len(text) > k]
    return tuple(xxhash.xxh32_intdigest(p) % DIMS for p in parts)


def features(text: bytes, memo: Memo) -> set[int]:
    return set(chain.from_iterable(map(memo.__getitem__, set(text.lower().split()))))


@dataclass
class Model:
    """Sparse weights and ordered thresholds."""

    index: np.ndarray  # features with a weight, ascending
    weight: np.ndarray
    thresholds: np.ndarray  # θ_1 ≤ … ≤ θ_{K-1}

    def reach(self, score: np.ndarray) -> np.ndarray:
        """P(grade ≥ k) for k = 1 … K - 1, a column each."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -60, 60)))


def _rows(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.repeat(np.arange(len(lists)), [len(x) for x in lists]), np.concatenate(lists) if lists else np.zeros(0, np.int64)


def grade(lists: list[np.ndarray], words: np.ndarray, toxic: np.ndarray, grades: int) -> np.ndarray:
    """Severity grades of labelled rows: toxic rows by the density of their telling features."""
    out = np.zeros(len(toxic), np.int64)
    bad = np.flatnonzero(toxic)
    if not len(bad):
        return out
    row, col = _rows(lists)
    in_bad = np.bincount(col, weights=toxic[row], minlength=DIMS)
    in_all = np.bincount(col, minlength=DIMS)
    odds = np.log((in_bad + 0.5) / (len(bad) + 1)) - np.log((in_all - in_bad + 0.5) / (len(toxic) - len(bad) + 1))
    telling = (in_all >= MIN_DOCS) & (odds > 2)
    density = np.bincount(row, weights=telling[col], minlength=len(toxic))[bad] / np.maximum(words[bad], 1)
    place = np.empty(len(bad), np.int64)
    place[np.lexsort((bad, density))] = np.arange(len(bad))
    out[bad] = 1 + place * (grades - 1) // len(bad)
    return out


def fit(lists: list[np.ndarray], grades: np.ndarray, count: int, steps: int = 200, l1: float = 2e-4) -> Model:
    """Proximal Adam on the cumulative-link likelihood; ``l1`` keeps the weights sparse."""
    row, col = _rows(lists)
    often = np.flatnonzero(np.bincount(col, minlength=DIMS) >= MIN_DOCS)
    local = np.full(DIMS, -1)
    local[often] = np.arange(len(often))
    keep = local[col] >= 0
    row, col = row[keep], local[col[keep]]
    n, k, f = max(1, len(grades)), count - 1, len(often)
    share = np.array([((grades >= j).sum() + 0.5) / (n + 1) for j in range(1, count)])
    start = np.log((1 - share) / share)
    # parameters: weights, first threshold, logs of the gaps
    par = np.concatenate([np.zeros(len(often)), [start[0]], np.log(np.maximum(np.diff(start), 1e-3))])
    m, v = np.zeros_like(par), np.zeros_like(par)
    for step in range(1, steps + 1 if 0 < (grades > 0).sum() < len(grades) else 1):
        theta = par[f] + np.concatenate([[0], np.cumsum(np.exp(par[f + 1:]))])
        score = np.bincount(row, weights=par[col], minlength=n)
        up = np.concatenate([np.ones((n, 1)), 1 / (1 + np.exp(-np.clip(score[:, None] - theta, -60, 60))), np.zeros((n, 1))], axis=1)
        slope = up * (1 - up)  # of P(≥ k) in the score
        here = np.arange(n)
        p = np.maximum(up[here, grades] - up[here, grades + 1], 1e-12)
        low, high = slope[here, grades] / p, slope[here, grades + 1] / p
        g_score = (high - low) / n
        g_theta = np.array([(low[grades == j].sum() - high[grades == j - 1].sum()) / n for j in range(1, count)])
        tail = np.cumsum(g_theta[::-1])[::-1]
        grad = np.concatenate([np.bincount(col, weights=g_score[row], minlength=f), [tail[0]], tail[1:] * np.exp(par[f + 1:])])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        par -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        scale = 0.1 * l1 / (np.sqrt(v[:f] / (1 - 0.999**step)) + 1e-9)
        par[:f] = np.sign(par[:f]) * np.maximum(np.abs(par[:f]) - scale, 0)
    theta = par[f] + np.concatenate([[0], np.cumsum(np.exp(par[f + 1:]))])[:k]
    used = np.flatnonzero(par[:f])
    return Model(often[used], par[:f][used], theta)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, grades: int = GRADES, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on the labelled rows of the bounded sample.  ``label_col`` holds 0 / 1, or grades 0 … ``grades`` - 1 if any is larger."""
    known = labels.select(labels[id_col].alias("doc_id"), labels[label_col].cast("int").alias("label")).dropna()
    chosen = sample_by_hash(known.groupBy("doc_id").agg(F.max("label").alias("label")), "doc_id", sample)

    def run(batches):
        memo = Memo(word_features)
        for batch in batches:
            texts = utf8(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([len(t.split()) for t in texts], pa.int64()),
                 pa.array([sorted(features(t, memo)) for t in texts], pa.list_(pa.int32()))], ["doc_id", "label", "words", "features"])

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    # at most 2 ``sample`` rows are broadcast, and as many come to the driver, as hashed features
    held = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    table = held.mapInArrow(run, f"doc_id {kind}, label int, words long, features array<int>").toArrow().sort_by("doc_id")
    label = np.asarray(table.column("label"), np.int64)
    lists = [np.asarray(x, np.int64) for x in table.column("features").to_pylist()]
    graded = label if label.max(initial=0) > 1 else grade(lists, np.asarray(table.column("words")), label > 0, grades)
    return fit(lists, graded, grades)


def score(docs: DataFrame, model: Model, cut: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, toxic (P(grade ≥ 1) reaches ``cut``), p_toxic, severity (expected), grade (most probable) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMS weights at most

    def run(batches):
        model = shared.value
        weight = np.zeros(DIMS)
        weight[model.index] = model.weight
        learned = set(np.flatnonzero(weight).tolist())
        memo = Memo(lambda w: tuple(f for f in word_features(w) if f in learned))
        for batch in batches:
            scores = np.array([weight[list(features(t, memo))].sum() for t in utf8(batch.column("text"))])
            up = model.reach(scores.reshape(-1))
            each = np.concatenate([np.ones((len(up), 1)), up], axis=1) - np.concatenate([up, np.zeros((len(up), 1))], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(up[:, 0] >= cut), pa.array(up[:, 0]), pa.array(up.sum(axis=1)), pa.array(each.argmax(axis=1).astype(np.int32))],
                ["doc_id", "toxic", "p_toxic", "severity", "grade"])

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, toxic boolean, p_toxic double, severity double, grade int")
