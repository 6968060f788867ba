"""Operator 10 — quality rules by distribution divergence.

Every language gets a reference from its documents of ``min_words`` words or more
(as the queries call it: its distinct texts that pass the base rules): the mean histogram of character classes, and the mean histogram of its most
common words (with one bin for all other words).  Each document counts once,
whatever its length.  A document is rejected when the Jensen-Shannon distance of
its own histograms to its language's reference is above a limit; short texts have
noisy histograms, so the limits grow with one over the root of the word count, and
texts below ``min_words`` are not judged by distance at all.  Base rules (too few
words, too many repeated three-word windows) come first.

Words of a histogram are lower-cased (A-Z) and lose ASCII punctuation at both ends.

Defined cases: null text is empty (no words, rejected by the base rule); a
document whose language is null is held against the nearest reference; for a
stated language without a reference (it needs ``min_docs`` documents), and without
any reference, only the base rules decide; repeated rows are judged alike; an
empty table gives no rows; whole texts are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import utf8

SYMBOLS = b"#*$%&|<>"
PUNCTUATION = b".,;:!?\"'()-"
CLASSES = ("lower", "upper", "digit", "space", "punctuation", "symbol", "beyond_ascii")


@dataclass(frozen=True)
class Rules:
    """Parameters of the rules; ``*_limit`` is (floor, offset, factor / sqrt(words))."""

    min_words: int = 50
    max_repeat_percent: int = 50
    common_words: int = 48
    min_docs: int = 20
    word_limit: tuple[float, float, float] = (0.30, 0.08, 3.4)
    char_limit: tuple[float, float, float] = (0.0, 0.16, 1.2)
    max_languages: int = 2000


def _class_table() -> np.ndarray:
    table = np.full(256, 5)
    for b in range(256):
        c = chr(b)
        if b >= 0x80:
            table[b] = 6 if b >= 0xC0 else 7  # a code point counts at its first byte
        elif c.islower():
            table[b] = 0
        elif c.isupper():
            table[b] = 1
        elif c.isdigit():
            table[b] = 2
        elif b in b" \t\n\v\f\r":
            table[b] = 3
        elif b in PUNCTUATION:
            table[b] = 4
    return table


TABLE = _class_table()
IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
FILTER_BITS = 1 << 23  # 1 MB; more copied texts than bits only send more texts through the exchange
IN_WORD = (TABLE != 3) & (TABLE != 7)


def common_counts(words: list[bytes]) -> Counter:
    """Words of a histogram with their counts."""
    counts: Counter = Counter()
    for w, n in Counter(words).items():
        counts[w.strip(PUNCTUATION)] += n
    return counts


def class_counts(raw: np.ndarray) -> np.ndarray:
    return np.bincount(raw, minlength=256)


def divergence(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms that sum to 1."""
    mid = (p + q) / 2

    def kl(a):
        at = a > 0
        return float(np.sum(a[at] * np.log2(a[at] / mid[at])))

    return max(0.0, (kl(p) + kl(q)) / 2) ** 0.5


def repeated(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    last, total = -1, 0  # last word already counted
    for at, w in enumerate(windows):
        if counts[w] > 1:
            total += at + 2 - max(last, at - 1)
            last = at + 2
    return total


def repetitive(words: list[bytes], repeat: int, rules: Rules) -> bool:
    return 100 * repeat > rules.max_repeat_percent * len(words)


def _copied(rows: DataFrame) -> np.ndarray:
    """Bitmap over the column ``h`` modulo FILTER_BITS, with the bit of every value found at least twice set."""
    twice = rows.groupBy("h").count().where("count > 1").select((F.pmod("h", F.lit(FILTER_BITS)) + 1).alias("b"))
    found = (twice.groupBy(F.bitmap_bucket_number("b").alias("k"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits")).collect())  # FILTER_BITS / 32,768 rows at most
    bits = np.zeros((FILTER_BITS >> 15, 1 << 12), np.uint8)
    for r in found:
        bits[r.k - 1] = np.frombuffer(bytes(r.bits), np.uint8)
    return bits.ravel()


def _part(batches: Iterator[pa.RecordBatch], bits: np.ndarray, copied: bool) -> Iterator[pa.RecordBatch]:
    """Text and lang of the rows whose bit says that they may have copies, or of all others."""
    for batch in batches:
        at = batch.column("h").to_numpy() & (8 * len(bits) - 1)
        yield batch.select(["text", "lang"]).filter(pa.array((bits[at >> 3] >> (at & 7) & 1 == 1) == copied))


def references(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text", lang_col: str = "lang", distinct: bool = False) -> dict:
    """lang → (common words, word histogram, class histogram), from all documents of ``min_words`` or more.

    With ``distinct`` every text of a language counts once, however many rows hold it, and
    texts that fail the base rules do not count: a group of copies or of repetitive junk
    does not move the reference.

    Each task adds up its documents before the shuffle; weights are integers (millionths of
    a document), so the sums do not depend on their order."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()

        def rows():
            keys = list(sums)
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array([k[2] for k in keys], pa.binary()), pa.array([sums[k] for k in keys], pa.int64())], ["lang", "kind", "key", "weight"])

        for batch in batches:
            for text, lang in zip(utf8(batch.column("text")), batch.column("lang").to_pylist(), strict=True):
                words = text.lower().split()
                if lang is None or len(words) < rules.min_words:
                    continue
                if distinct and repetitive(words, repeated(text.split()), rules):
                    continue
                for w, n in common_counts(words).items():
                    sums[lang, 0, w] += round(1e6 * n / len(words))
                classes = np.bincount(TABLE, weights=class_counts(np.frombuffer(text, np.uint8)), minlength=8)[:7]
                for k, n in enumerate(classes):
                    sums[lang, 1, b"%d" % k] += round(1e6 * n / classes.sum())
                sums[lang, 2, b""] += 1
                if len(sums) > 400_000:  # bounds the task's memory; what is sent early is added up later
                    yield rows()
                    sums.clear()
        if sums:
            yield rows()

    rows = docs.select(docs[text_col].alias("text"), docs[lang_col].cast("string").alias("lang"))
    kind = "lang string, kind int, key binary, weight long"
    if distinct:  # texts that surely are there once are added up where they are; all that may have copies meet by an exchange
        rows = rows.where(F.col("lang").isNotNull() & (F.octet_length("text") >= 2 * rules.min_words - 1)).withColumn("h", F.xxhash64("lang", "text"))
        bits = _copied(rows)
        once = rows.mapInArrow(lambda batches: partial(_part(batches, bits, False)), kind)  # one Python worker a task
        found = once.union(rows.mapInArrow(lambda batches: _part(batches, bits, True), "text string, lang string").distinct().mapInArrow(partial, kind))
    else:
        found = rows.mapInArrow(partial, kind)
    sums = (found.groupBy("lang", "kind", "key").agg(F.sum("weight").alias("weight")))
    best = Window.partitionBy("lang", "kind").orderBy(F.desc("weight"), "key")
    top = (sums.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= rules.common_words)
           .limit(rules.max_languages * (rules.common_words + len(CLASSES) + 1) + 1).collect())
    if len(top) > rules.max_languages * (rules.common_words + len(CLASSES) + 1):
        raise ValueError(f"more than {rules.max_languages} languages: raise max_languages, or pass a coarser column")
    by_lang: dict = {}
    for r in sorted(top, key=lambda r: (r.kind, r.rank)):
        by_lang.setdefault(r.lang, {}).setdefault(r.kind, []).append((bytes(r.key), r.weight / 1e6))
    out = {}
    for lang, parts in by_lang.items():
        n = parts[2][0][1] * 1e6
        if n < rules.min_docs:
            continue
        words = [w for w, _ in parts[0]]
        common = np.array([v / n for _, v in parts[0]])
        classes = np.zeros(len(CLASSES))
        for k, v in parts[1]:
            classes[int(k)] = v / n
        out[lang] = (words, np.append(common, max(0.0, 1 - common.sum())), classes / classes.sum())
    return out


def _limit(limit: tuple[float, float, float], n: int) -> float:
    return max(limit[0], limit[1] + limit[2] / n**0.5)


def judge(text: bytes, lang: str | None, refs: dict, rules: Rules) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance, word_distance, kept."""
    counts = class_counts(np.frombuffer(text, np.uint8))
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    n, repeat = len(words), repeated(words)
    base = (n, int(counts[IN_WORD].sum()), int(counts[IS_SYMBOL].sum()), len(lines) - len(set(lines)), repeat)
    failed = n < rules.min_words or repetitive(words, repeat, rules)
    if failed or not refs or (lang is not None and lang not in refs):
        return (*base, failed, None, None, not failed)
    classes = np.bincount(TABLE, weights=counts, minlength=8)[:7]
    classes /= classes.sum()
    own = common_counts(text.lower().split())
    best = None
    for common, words_ref, classes_ref in refs.values() if lang is None else [refs[lang]]:
        hist = np.array([own[w] for w in common], float)
        hist = np.append(hist, n - hist.sum()) / n
        found = (divergence(classes, classes_ref), divergence(hist, words_ref))
        best = min(best or found, found, key=sum)
    kept = best[0] <= _limit(rules.char_limit, n) and best[1] <= _limit(rules.word_limit, n)
    return (*base, failed, *best, kept)


_TYPES = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", "kept"]


def measure(docs: DataFrame, refs: dict, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id and every figure and verdict of each row."""

    def run(batches):
        for batch in batches:
            found = [judge(t, g, refs, rules) for t, g in zip(utf8(batch.column("text")), batch.column("lang").to_pylist(), strict=True)]
            columns = zip(*found, strict=True) if found else [[]] * len(_TYPES)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True))], ["doc_id", *_NAMES])

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].cast("string").alias("lang"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, word_chars long, n_symbols long, "
                                "n_dup_lines long, n_repeat_words long, base_failed boolean, char_distance double, word_distance double, kept boolean")


def keep(docs: DataFrame, refs: dict, rules: Rules = Rules(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""

    def run(batches):
        for batch in batches:
            texts, langs = utf8(batch.column(text_col)), batch.column(lang_col).cast(pa.string()).to_pylist()
            yield batch.filter(pa.array([judge(t, g, refs, rules)[-1] for t, g in zip(texts, langs, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
