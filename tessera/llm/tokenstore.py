"""Operator 9 — token-id / binary output.

Documents are encoded, each id run is serialised and compressed on its own with
zstandard and one shared dictionary, and the frames are written in ascending
document order.  A store is a folder with two tables:

* ``dictionary``: one row (dict_sha256, dictionary) — the bytes every frame needs;
* ``segments``: rows of about one megabyte: ``part`` and ``seq`` give the order, ``first_id``
  and ``last_id`` the smallest and largest id (a null id comes first),
  ``part_start`` the ids before the segment in its part, ``doc_ids``,
  ``n_tokens`` and ``offsets`` (one more than documents) index the frames in
  ``payload``, ``id_bytes`` is the width of a serialised id, ``dict_sha256``
  names the dictionary.

One document is read by its index entry alone: cut its frame out of the payload
(``fetch``), decompress it with the dictionary.  A reader refuses a segment
whose dictionary hash is not the hash of the dictionary it holds.

The dictionary is fitted on a bounded sample: of about ``SAMPLE_DOCS`` documents (twice as
many at most, by a hash of their id) the whole texts are cut into chunks of ``CHUNK_CHARS``
characters, and about ``SAMPLE_CHUNKS`` of these (twice as many at most, by a hash) are taken,
wherever in a text they stand.  It only decides the compression ratio.  Everything else reads whole texts of all rows.

Defined cases: null text is an empty document (the end id alone); null ids sort
first; rows with one id follow each other, in the order of a hash of their text;
an empty table gives an empty store; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm.bpe import LETTERS, Memo, _slices, byte_symbols, is_plain
from tessera.llm.common import sample_by_hash

SAMPLE_DOCS, SAMPLE_CHUNKS, CHUNK_CHARS, DICTIONARY_BYTES, LEVEL = 500, 2_000, 2_000, 64 << 10, 1
SEGMENT_BYTES = 1 << 20
PIECES = 700_000  # in one generation of a worker's memo: about 150 MB for each of two
# fixed: the byte-level pattern of the vocabulary, for plain texts
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")


class Encoder:
    """Ids of whole texts by the tokenizers library.

    A plain text is cut as the byte-level pattern cuts it, and the library's model encodes each
    piece once for a bounded memo; any other text goes through the library as a whole."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.dtype = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        width = np.dtype(self.dtype).itemsize
        symbol = {b: c for c, b in byte_symbols().items()}
        table, model = "".join(symbol[b] for b in range(256)), self.library.model

        raw = [i.to_bytes(width, "little") for i in range(self.library.get_vocab_size())]

        def piece(text: str) -> bytes:
            name = text.replace(" ", table[32]) if text.isascii() and text.isprintable() else text.encode().decode("latin-1").translate(table)
            return b"".join([raw[t.id] for t in model.tokenize(name)])

        self.memo = Memo(piece, PIECES)

    def encode(self, text: str) -> bytes:
        """Serialised ids of a text."""
        if is_plain(text) and not any(s in text for s in self.special):
            return b"".join(map(self.memo.__getitem__, _PIECES.findall(text)))
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def train_dictionary(docs: DataFrame, path: str) -> bytes:
    """Dictionary bytes from the bounded sample; empty if there is too little to learn from."""
    texts = sample_by_hash(docs, "doc_id", SAMPLE_DOCS).where(F.length("text") > 0)
    last = F.floor((F.length("text") - 1) / CHUNK_CHARS)
    chunks = texts.select("doc_id", "text", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("nth")).withColumn("chunk", F.struct("doc_id", "nth"))
    cut = F.substring("text", (F.col("nth") * CHUNK_CHARS + 1).cast("int"), F.lit(CHUNK_CHARS))
    sample = sample_by_hash(chunks, "chunk", SAMPLE_CHUNKS).select(cut.alias("t")).orderBy("t").collect()
    runs = [r for s in sample if (r := encoder(path).encode(s.t))]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, runs, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few samples: their own bytes serve as the dictionary
        return b"".join(runs)[-DICTIONARY_BYTES:]


def _dictionary(raw: bytes):
    return zstandard.ZstdCompressionDict(raw) if raw else None


def write(docs: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every row of ``docs``, append ``end_id`` to each and write the store at ``folder``."""
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    raw = train_dictionary(rows, path)
    sha = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame([(sha, bytearray(raw))], "dict_sha256 string, dictionary binary").coalesce(1).write.parquet(f"{folder}/dictionary")
    shared = spark.sparkContext.broadcast(raw)  # 64 KB at most

    def run(batches):
        coder = encoder(path)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(shared.value), write_content_size=True)
        end = np.array([end_id], coder.dtype).tobytes()
        width, part, seq, start = np.dtype(coder.dtype).itemsize, TaskContext.get().partitionId(), 0, 0
        ids, counts, frames = [], [], []

        def segment():
            offsets = np.cumsum([0] + [len(f) for f in frames]).tolist()
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([start], pa.int64()),
                 pa.array([ids], pa.list_(id_type)), pa.array([counts], pa.list_(pa.int64())), pa.array([offsets], pa.list_(pa.int64())),
                 pa.array([width], pa.int32()), pa.array([sha]), pa.array([b"".join(frames)], pa.binary()), pa.array([ids[0]], id_type), pa.array([ids[-1]], id_type)],
                ["part", "seq", "part_start", "doc_ids", "n_tokens", "offsets", "id_bytes", "dict_sha256", "payload", "first_id", "last_id"])

        size = 0
        for batch in batches:
            id_type = batch.column("doc_id").type
            for piece in _slices(batch):
                runs = [coder.encode(t or "") for t in piece.column("text").to_pylist()]
                for doc, run_ids in zip(piece.column("doc_id").to_pylist(), runs, strict=True):
                    frame = press.compress(run_ids + end)
                    ids.append(doc)
                    counts.append(len(run_ids) // width + 1)
                    frames.append(frame)
                    size += len(frame)
                    if size >= SEGMENT_BYTES:
                        yield segment()
                        start, seq, size = start + sum(counts), seq + 1, 0
                        ids, counts, frames = [], [], []
        if ids:
            yield segment()

    kind = rows.schema["doc_id"].dataType.simpleString()
    order = ["doc_id", F.xxhash64("text")]
    (rows.repartitionByRange(*order).sortWithinPartitions(*order)
     .mapInArrow(run, f"part int, seq int, part_start long, doc_ids array<{kind}>, n_tokens array<long>, offsets array<long>, "
                      f"id_bytes int, dict_sha256 string, payload binary, first_id {kind}, last_id {kind}")
     .write.option("compression", "none").parquet(f"{folder}/segments"))


def _dictionary_of(spark: SparkSession, folder: str) -> tuple[object, str]:
    """The broadcast dictionary and its hash."""
    row = spark.read.parquet(f"{folder}/dictionary").first()
    if hashlib.sha256(row.dictionary).hexdigest() != row.dict_sha256:
        raise ValueError("the dictionary is damaged")
    return spark.sparkContext.broadcast(bytes(row.dictionary)), row.dict_sha256


def _open(spark: SparkSession, folder: str) -> tuple[DataFrame, object, str]:
    """Segments with the ids before their part (``part_base``), the broadcast dictionary, its hash."""
    shared, sha = _dictionary_of(spark, folder)
    segments = spark.read.parquet(f"{folder}/segments").drop("first_id", "last_id")
    total = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)
    parts = segments.select("part", total.alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_base"))
    # one row for each part that was written: a few hundred thousand at most
    return segments.join(F.broadcast(base), "part"), shared, sha


def _presser(shared, sha: str, batch: pa.RecordBatch):
    if any(s != sha for s in batch.column("dict_sha256").to_pylist()):
        raise ValueError("a segment was written with another dictionary")
    return zstandard.ZstdDecompressor(dict_data=_dictionary(shared.value))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary) of every document, ids as little-endian 32-bit integers."""
    return _read(spark, folder, ("ids binary", pa.binary(), bytes))


def read_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from its decompressed frame."""
    return _read(spark, folder, ("ids_crc32 long", pa.int64(), zlib.crc32))


def _read(spark: SparkSession, folder: str, out: tuple) -> DataFrame:
    segments, shared, sha = _open(spark, folder)
    column, arrow, make = out

    def run(batches):
        for batch in batches:
            press = _presser(shared, sha, batch)
            for s in batch.to_pylist():
                frames = memoryview(s["payload"])
                ids = [np.frombuffer(press.decompress(frames[a:b]), f"<u{s['id_bytes']}").astype("<u4").tobytes()
                       for a, b in zip(s["offsets"], s["offsets"][1:], strict=False)]
                counts = np.array(s["n_tokens"], np.int64)
                if any(len(i) != 4 * n for i, n in zip(ids, counts, strict=True)):
                    raise ValueError("a frame does not hold the ids its index states")
                starts = s["part_base"] + s["part_start"] + np.cumsum(counts) - counts
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s["doc_ids"], batch.schema.field("doc_ids").type.value_type), pa.array(starts), pa.array(counts),
                     pa.array([make(i) for i in ids], arrow)], ["doc_id", "start", "n_tokens", column.split()[0]])

    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()
    return segments.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, {column}")


def fetch(spark: SparkSession, folder: str, doc_ids: list) -> DataFrame:
    """(doc_id, ids binary) of a few documents: only segments whose range holds one of the ids are
    read (a filter that reaches the file statistics), and only their frames leave the segments."""
    shared, sha = _dictionary_of(spark, folder)
    segments = spark.read.parquet(f"{folder}/segments")
    within = F.lit(False)
    for d in doc_ids:
        within = within | ((F.col("first_id").isNull() | (F.col("first_id") <= F.lit(d))) & (F.col("last_id") >= F.lit(d)))
    segments = segments.where(within)
    index = F.explode(F.arrays_zip("doc_ids", "n_tokens", F.slice("offsets", 1, F.size("doc_ids")).alias("a"),
                                   F.slice("offsets", 2, F.size("doc_ids")).alias("b")))
    frames = (segments.where(F.arrays_overlap("doc_ids", F.array(*[F.lit(d) for d in doc_ids])))
              .select(index.alias("i"), "payload", "id_bytes", "dict_sha256").where(F.col("i.doc_ids").isin(list(doc_ids)))
              .select(F.col("i.doc_ids").alias("doc_id"), "id_bytes", "dict_sha256",
                      F.expr("substring(payload, cast(i.a + 1 as int), cast(i.b - i.a as int))").alias("frame")))

    def run(batches):
        for batch in batches:
            press = _presser(shared, sha, batch)
            ids = [np.frombuffer(press.decompress(f), f"<u{w}").astype("<u4").tobytes()
                   for f, w in zip(batch.column("frame").to_pylist(), batch.column("id_bytes").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return frames.mapInArrow(run, f"doc_id {frames.schema['doc_id'].dataType.simpleString()}, ids binary")
