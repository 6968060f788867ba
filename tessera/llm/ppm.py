"""Operator 2 — language-model scoring by prediction by partial matching.

A text is lower-cased (A-Z), its words are joined by single blanks, and an end
mark follows.  The model predicts each byte from the ``ORDER`` = 5 bytes before it.
Its trie holds, for every context of the training documents, the bytes that
followed and how often (all orders are updated).  A byte met in the longest known
context has probability count / (total + distinct); otherwise the model escapes
with distinct / (total + distinct) to the context one byte shorter, where the
bytes of the longer context are excluded from all sums, down to a uniform choice
of the bytes never met.  A document's score is the sum of log10 probabilities of
its bytes, the end included: a pretrained code length.

The trie grows with the corpus and is never held in one place:

* documents are packed into blocks of about 6 MB, written once;
* a block asks for what it needs: its distinct 6-byte strings with their training
  counts, and its distinct words likewise, cut by hash into buckets (their number grows
  with the blocks; a block writes a row only for a bucket it needs something of, so the
  rows are never more than its distinct strings and words);
* a bucket adds up the counts of all blocks (a context is in one bucket, with all
  its bytes) and answers every block; strings never met in training are left open;
* lower orders are sums of the counts, as tables; open strings walk down them by
  joins, one order at a time;
* blocks meet their answers and add up their documents' scores.

The base score is that of a word unigram model with counts plus one.

Defined cases: null text is empty (its end only); ``held_out`` null counts as not
held out; repeated rows are scored and counted each; without training documents
every byte is uniform; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored, utf8

ORDER = 5
BLOCK_BYTES, BLOCK_DOCS = 6 << 20, 1 << 16
END = b"\n"
_PAD = END * ORDER  # the context at a document's start


# -- blocks -------------------------------------------------------------------------------------


def blocks(docs: DataFrame) -> DataFrame:
    """(block, ids, held, lengths, payload): documents (doc_id, text, held) in normal form, packed."""

    def run(batches):
        part, seq, size = TaskContext.get().partitionId(), 0, 0
        ids, held, texts = [], [], []

        def block():
            return pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | seq], pa.int64()), pa.array([ids], pa.list_(kind)), pa.array([held], pa.list_(pa.bool_())),
                 pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                 pa.array([zstandard.ZstdCompressor(level=3).compress(b"".join(texts))], pa.binary())],
                ["block", "ids", "held", "lengths", "payload"])

        for batch in batches:
            kind = batch.column("doc_id").type
            for doc, text, out in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text")), batch.column("held").to_pylist(), strict=True):
                ids.append(doc)
                held.append(out)
                texts.append(_PAD + b" ".join(text.lower().split()) + END)
                size += len(texts[-1])
                if size >= BLOCK_BYTES or len(ids) == BLOCK_DOCS:
                    yield block()
                    ids, held, texts, size, seq = [], [], [], 0, seq + 1
        if ids:
            yield block()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"block long, ids array<{kind}>, held array<boolean>, lengths array<long>, payload binary")


class Block:
    """A block's documents, its distinct strings and words."""

    def __init__(self, row: dict):
        self.ids, self.block = row["ids"], row["block"]
        self.held = np.array(row["held"], bool)
        self.lengths = np.array(row["lengths"], np.int64)
        self.raw = zstandard.ZstdDecompressor().decompress(row["payload"])

    def strings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(string, run of it, document, times): the sorted distinct strings, and for every
        (string, document) that occurs the string's index, the document and the count."""
        a = np.frombuffer(self.raw, np.uint8)
        key = np.zeros(len(a), np.uint64)
        for j in range(ORDER, -1, -1):  # the byte itself comes last, so in the lowest place
            key <<= np.uint64(8)
            np.bitwise_or(key[j:], a[: len(a) - j], out=key[j:])
        key <<= np.uint64(16)
        np.bitwise_or(key, np.repeat(np.arange(len(self.ids), dtype=np.uint16), self.lengths), out=key)
        real = np.ones(len(a), bool)
        starts = np.cumsum(self.lengths) - self.lengths
        for j in range(ORDER):
            real[starts + j] = False
        key = key[real]
        key.sort()
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        times = np.diff(first, append=len(key)).astype(np.int32)
        key = key[first]
        del first, real
        document = (key & np.uint64(0xFFFF)).astype(np.uint16)
        key >>= np.uint64(16)
        new = np.concatenate([[True], key[1:] != key[:-1]])
        return key[new], np.cumsum(new, dtype=np.int32) - 1, document, times

    def documents(self) -> list[list[bytes]]:
        ends = np.cumsum(self.lengths)
        return [self.raw[a:b].split() for a, b in zip((ends - self.lengths).tolist(), ends.tolist(), strict=True)]


def pack(a: np.ndarray) -> bytes:
    """An array's bytes, the first of all its elements first, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes())


def unpack(raw: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=a.dtype.type(0)))


def unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw, np.uint64), dtype=np.uint64)


def word_key(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _cut(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``keys`` by (bucket, place) and the buckets in this order."""
    bucket = bucket_of(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    return order, bucket[order]


def _pieces(cut: tuple[np.ndarray, np.ndarray], wanted: np.ndarray) -> list[np.ndarray]:
    """Places of the keys of each wanted bucket (none: empty)."""
    order, bucket = cut
    first, end = np.searchsorted(bucket, wanted), np.searchsorted(bucket, wanted, side="right")
    return [order[a:b] for a, b in zip(first.tolist(), end.tolist(), strict=True)]


def requests(packed: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, strings, times, words, word_times): what each block needs from each bucket
    that has any of it, with its own training counts."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                b = Block(batch.slice(k, 1).to_pylist()[0])
                strings, at, document, times = b.strings()
                times[b.held[document]] = 0
                trained = np.bincount(at, weights=times, minlength=len(strings)).astype(np.uint32)
                del at, document, times
                counts: Counter = Counter()
                for words, held in zip(b.documents(), b.held, strict=True):
                    if held:
                        counts.update(dict.fromkeys(words, 0))
                    else:
                        counts.update(words)
                counts[END] = int((~b.held).sum())
                words = np.fromiter(map(word_key, counts), np.uint64, len(counts))
                word_times = np.fromiter(counts.values(), np.uint32, len(counts))
                by_key = np.argsort(words)
                words, word_times = words[by_key], word_times[by_key]
                cuts = _cut(strings >> np.uint64(8), buckets), _cut(words, buckets)
                needed = np.union1d(cuts[0][1], cuts[1][1])
                for at in range(0, len(needed), 4096):
                    some = needed[at: at + 4096]
                    parts = list(zip(*(_pieces(cut, some) for cut in cuts), strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some, pa.int64()), pa.array([b.block] * len(some), pa.int64()),
                         pa.array([pack_sorted(strings[s]) for s, _ in parts], pa.binary()), pa.array([pack(trained[s]) for s, _ in parts], pa.binary()),
                         pa.array([pack_sorted(words[w]) for _, w in parts], pa.binary()), pa.array([pack(word_times[w]) for _, w in parts], pa.binary())],
                        ["bucket", "block", "strings", "times", "words", "word_times"])

    return packed.mapInArrow(run, "bucket long, block long, strings binary, times binary, words binary, word_times binary")


# -- buckets ------------------------------------------------------------------------------------

ANSWER, TRIE, OPEN, TOTAL = range(4)
_ANSWERS = "kind int, block long, bucket long, a binary, b binary"


def _sums(runs: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the key of each element of the runs, and the keys' sums."""
    keys, at = np.unique(np.concatenate(runs), return_inverse=True)
    return keys, at, np.bincount(at, weights=np.concatenate(times), minlength=len(keys))


def answer(table: pa.Table) -> pa.Table:
    """One bucket: add up all blocks' counts, answer each block.  ANSWER rows hold log10
    probabilities (NaN: open) and word counts in the order asked; TRIE rows strings and counts;
    OPEN rows a block's open strings; the TOTAL row training words and distinct ones."""
    rows = table.to_pylist()
    bucket = rows[0]["bucket"]
    runs = [unpack_sorted(r["strings"]) for r in rows]
    keys, at, counts = _sums(runs, [unpack(r["times"], np.uint32) for r in rows])
    logs = np.full(len(keys), np.nan, np.float32)
    met = counts > 0
    if met.any():
        context, group = np.unique(keys[met] >> np.uint64(8), return_inverse=True)
        total = np.bincount(group, weights=counts[met]) + np.bincount(group)  # total + distinct
        logs[met] = np.log10(counts[met] / total[group])
    word_runs = [unpack_sorted(r["words"]) for r in rows]
    words, word_at, word_counts = _sums(word_runs, [unpack(r["word_times"], np.uint32) for r in rows])
    word_counts = word_counts.astype(np.uint64)
    out = [(TRIE, None, pack_sorted(keys[met]), pack(counts[met].astype(np.int64))),
           (TOTAL, None, None, np.array([word_counts.sum(), (word_counts > 0).sum()], np.int64).tobytes())]
    a = b = 0
    for r, run, word_run in zip(rows, runs, word_runs, strict=True):
        mine, mine_words = at[a: a + len(run)], word_at[b: b + len(word_run)]
        a, b = a + len(run), b + len(word_run)
        out.append((ANSWER, r["block"], pack(logs[mine]), pack(word_counts[mine_words])))
        still = run[~met[mine]]
        if len(still):
            out.append((OPEN, r["block"], pack_sorted(still), None))
    kind, block, first, second = zip(*out, strict=True)
    return pa.table([pa.array(kind, pa.int32()), pa.array(block, pa.int64()), pa.array([bucket] * len(out), pa.int64()),
                     pa.array(first, pa.binary()), pa.array(second, pa.binary())], ["kind", "block", "bucket", "a", "b"])


def _totals(batches):
    """(n, v) of each TOTAL row."""
    for batch in batches:
        both = np.frombuffer(b"".join(batch.column("b").to_pylist()), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["n", "v"])


def _unpacked(answers: DataFrame, kind: int) -> DataFrame:
    """(block, g, c) rows of packed TRIE or OPEN rows."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                g = unpack_sorted(r["a"]).view(np.int64)
                c = unpack(r["b"], np.int64) if r["b"] else np.zeros(len(g), np.int64)
                for k in range(0, len(g), 1 << 18):
                    piece = slice(k, k + (1 << 18))
                    yield pa.RecordBatch.from_arrays([pa.array([r["block"]] * len(g[piece]), pa.int64()), pa.array(g[piece]), pa.array(c[piece])], ["block", "g", "c"])

    return answers.where(F.col("kind") == kind).select("block", "a", "b").mapInArrow(run, "block long, g long, c long")


# -- lower orders -------------------------------------------------------------------------------


def _low(column: Column, nbytes: int) -> Column:
    return column.bitwiseAND(F.lit((1 << 8 * nbytes) - 1))


def _few(table: DataFrame, key_bytes: int) -> DataFrame:
    """``table`` with a broadcast hint where its key of so many bytes bounds it to 65,536 rows.
    (All strings share the context of no bytes: dealt by it, they would meet in one task.)"""
    return F.broadcast(table) if key_bytes <= 2 else table


def open_scores(trie: DataFrame, strings: DataFrame) -> DataFrame:
    """(g, lp): log10 probability of strings whose last byte was never met after the others.

    ``trie``: (g, c) counts of all 6-byte strings of the training documents."""
    tables = {ORDER: trie}
    for k in range(ORDER - 1, -1, -1):  # counts of order k: bytes after contexts of k bytes
        tables[k] = stored(tables[k + 1].groupBy(_low(F.col("g"), k + 1).alias("g")).agg(F.sum("c").alias("c")), f"trie-{k}")
    # m, x: count and number of the bytes excluded at this order; done: the byte was found
    state = strings.select("g", F.lit(0.0).alias("lp"), F.lit(0).cast("long").alias("m"), F.lit(0).cast("long").alias("x"), F.lit(False).alias("done"))
    for k in range(ORDER, -1, -1):
        table = tables[k]
        context = table.groupBy(F.shiftrightunsigned("g", 8).alias("ctx")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("d"))
        asked = state.withColumn("ctx", _low(F.shiftrightunsigned("g", 8), k)).withColumn("low", _low(F.col("g"), k + 1))
        met = asked.join(_few(context, k), "ctx", "left").join(_few(table.select(F.col("g").alias("low"), "c"), k + 1), "low", "left")
        if k:  # what excluding this context's bytes takes from the context one byte shorter
            below = tables[k - 1].select(F.col("g").alias("low"), F.col("c").alias("c_low"))
            own = table.select(F.shiftrightunsigned("g", 8).alias("ctx"), _low(F.col("g"), k).alias("low"))
            taken = own.join(_few(below, k), "low").groupBy("ctx").agg(F.sum("c_low").alias("m_low"))
            met = met.join(_few(taken, k), "ctx", "left")
        else:
            met = met.withColumn("m_low", F.lit(0).cast("long"))
        left, kinds = F.col("n") - F.col("m"), F.col("d") - F.col("x")
        known, found = ~F.col("done") & F.col("n").isNotNull(), F.col("c").isNotNull()
        step = (F.when(known & found, F.log10(F.col("c") / (left + kinds)))
                .when(known & (kinds > 0), F.log10(kinds / (left + kinds))).otherwise(0.0))
        state = stored(met.select("g", (F.col("lp") + step).alias("lp"),
                                  F.when(known, F.coalesce("m_low", F.lit(0))).otherwise(F.col("m")).cast("long").alias("m"),
                                  F.when(known, F.col("d")).otherwise(F.col("x")).alias("x"), (F.col("done") | (known & found)).alias("done")), f"open-{k}")
    # the bytes of order 0 are excluded from the uniform choice
    return state.select("g", F.when(F.col("done"), F.col("lp")).otherwise(F.col("lp") - F.log10(F.lit(256) - F.col("x"))).alias("lp"))


# -- scores -------------------------------------------------------------------------------------


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row; the model
    learns from the rows where ``held_out`` (a boolean Column of ``docs``) does not hold.  ``buckets``
    is half the number of blocks unless given; it does not change the scores."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    packed = stored(blocks(rows), "blocks")
    buckets = buckets or max(16, packed.count() // 2)
    asked = stored(requests(packed, buckets), "requests")
    answers = stored(asked.groupBy("bucket").applyInArrow(answer, _ANSWERS), "answers")
    n, v = answers.where(F.col("kind") == TOTAL).select("b").mapInArrow(_totals, "n long, v long").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    still = stored(_unpacked(answers, OPEN).select("block", "g"), "open")
    lows = open_scores(stored(_unpacked(answers, TRIE).select("g", "c"), "trie"), still.select("g").distinct())
    found = still.join(lows, "g")
    right = answers.where(F.col("kind") == ANSWER).select("block", "bucket", "a", "b", F.lit(None).cast("long").alias("g"), F.lit(None).cast("double").alias("lp"))
    right = right.union(found.select("block", F.lit(None).cast("long").alias("bucket"), F.lit(None).cast("binary").alias("a"),
                                     F.lit(None).cast("binary").alias("b"), "g", "lp"))
    floor = n + v + 1

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            b = Block(row)
            replies = right.filter(pc.is_valid(right.column("bucket"))).select(["bucket", "a", "b"]).to_pylist()
            lower = right.filter(pc.is_valid(right.column("g")))
            strings, at, document, times = b.strings()
            logs, word_logs = np.empty(len(strings)), {}
            texts = b.documents()
            index = {w: k for k, w in enumerate(dict.fromkeys(chain([END], *texts)))}
            keys = np.fromiter(map(word_key, index), np.uint64, len(index))
            by_key = np.argsort(keys)
            asked = np.array([r["bucket"] for r in replies], np.int64)
            counts = np.zeros(len(index))
            for r, mine, mine_words in zip(replies, _pieces(_cut(strings >> np.uint64(8), buckets), asked), _pieces(_cut(keys[by_key], buckets), asked), strict=True):
                logs[mine] = unpack(r["a"], np.float32)
                counts[by_key[mine_words]] = unpack(r["b"], np.uint64)
            if lower.num_rows:
                logs[np.searchsorted(strings, np.asarray(lower.column("g")).view(np.uint64))] = np.asarray(lower.column("lp"))
            word_logs = np.log10((counts + 1) / floor)
            sizes = np.array([len(t) for t in texts])
            words = np.fromiter(map(index.__getitem__, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
            owner = np.repeat(np.arange(len(texts)), sizes)
            size = len(texts)
            known = np.bincount(owner, weights=counts[words] > 0, minlength=size) + (counts[0] > 0)
            base = np.bincount(owner, weights=word_logs[words], minlength=size) + word_logs[0]
            model = np.bincount(document, weights=logs[at] * times, minlength=size)
            out.append(pa.table([pa.array(b.ids, left.schema.field("ids").type.value_type), pa.array(b.held), pa.array(sizes + 1, pa.int64()),
                                 pa.array(known.astype(np.int64)), pa.array(np.full(size, n, np.int64)), pa.array(base), pa.array(model)], names))
        return pa.concat_tables(out) if out else pa.table([pa.array([], t) for t in (id_type, pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())], names)

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kind = packed.schema["ids"].dataType.elementType
    id_type = pa.int64() if kind.typeName() == "long" else pa.string()
    return packed.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(
        add_up, f"doc_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
