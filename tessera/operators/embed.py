"""Batch encoders: text → vector and bytes → vector, with lineage columns.

No model weights are available offline, so two deterministic built-in
encoders stand in for the reference's text and image models; any real
model plugs in through ``embed_with`` (an iterator ``mapInArrow`` that
builds the model once per task and encodes one Arrow batch per call).
Never present the built-ins as semantic quality: they are for plumbing,
scale and parity tests.

* ``with_hash_vectors`` — feature hashing: tokens = maximal runs of letters
  and digits of the lower-cased text; bucket = first 8 hex digits of the
  token's MD5 modulo ``dim``; vector = bucket counts scaled to unit length.
  Tokenising is a built-in expression; an Arrow stage hashes each distinct
  token of a batch once and counts with one ``bincount``.
* ``nibble_histogram_vectors`` — 16 buckets: the low 4 bits of every payload
  byte, counted with string functions on the hex form (all JVM side).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import fingerprint
from tessera.session import spread

# Fixed values of the built-in encoders (must equal the oracle SQL).
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
HASH_HEX_DIGITS = 8
TEXT_DIMS = 384
NIBBLE_DIMS = 16
HEX_DIGITS = "0123456789ABCDEF"
TEXT_MODEL = ("hash-text", "v1")
BYTES_MODEL = ("nibble-hist", "v1")


PART_VALUES, PART_ROWS = 262_144, 1_024        # tokens (or bytes) and rows that an encoder holds at once, as Python objects
FLAT_VALUES, FLAT_ROWS = 1_048_576, 4_096      # the same as flat arrays


def _parts(column: pa.Array, values: int = PART_VALUES, rows: int = PART_ROWS) -> Iterator[tuple[int, int]]:
    """(first row, rows) of consecutive parts of a column, bounded in rows and, for lists, texts and bytes,
    in values: an Arrow batch is bounded in rows only, whatever the length of its texts.  A longer row is a part by itself."""
    import pyarrow.compute as pc

    kind = column.type
    if pa.types.is_list(kind):
        lengths = pc.list_value_length(column)
    elif pa.types.is_string(kind) or pa.types.is_binary(kind):
        lengths = pc.binary_length(column)
    else:
        lengths = pa.array(np.zeros(len(column), np.int64))
    ends = np.cumsum(pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        used = ends[at - 1] if at else 0
        end = max(at + 1, min(at + rows, int(np.searchsorted(ends, used + values, side="right"))))
        end = min(end, len(column))
        yield at, end - at
        at = end


def tokens(text: Column) -> Column:
    """Tokens of a text, in order."""
    return F.array_remove(F.split(F.lower(text), TOKEN_SPLIT), "")


KNOWN_TOKENS = 1 << 16


class Buckets(dict):
    """Bucket by token for one task: it keeps ``KNOWN_TOKENS`` tokens at most, not all that the task meets."""

    def __init__(self, dim: int):
        super().__init__()
        self.dim = dim

    def __missing__(self, token: str) -> int:
        if len(self) >= KNOWN_TOKENS:
            self.clear()
        self[token] = found = bucket(token, self.dim)
        return found

    def counted(self, lists: list) -> np.ndarray:
        """Counts per bucket (columns) of each list of tokens (rows); null counts as empty."""
        out = np.zeros((len(lists), self.dim))
        for row, found in zip(out, lists, strict=True):
            if found:
                row[:] = np.bincount([self[t] for t in found], minlength=self.dim)
        return out


def bucket(token: str, dim: int) -> int:
    return int(hashlib.md5(token.encode(), usedforsecurity=False).hexdigest()[:HASH_HEX_DIGITS], 16) % dim


def with_hash_vectors(df: DataFrame, text_col: str, out_col: str = "vector", dim: int = TEXT_DIMS) -> DataFrame:
    """Add the unit-length hashed bag of tokens of ``text_col`` as ``out_col``.

    Runs in ``mapInArrow`` on the flat Arrow buffers of each batch: distinct
    tokens are hashed once, then one ``bincount`` over (row · dim + bucket);
    no per-row Python objects."""
    import pyarrow.compute as pc

    staged = spread(df).withColumn("_tokens", tokens(F.col(text_col)))
    keep = [f for f in staged.schema.fields if f.name != "_tokens"]
    schema = T.StructType(keep + [T.StructField(out_col, T.ArrayType(T.FloatType(), containsNull=False))])
    names = [f.name for f in keep]

    def run(batches):
        known = Buckets(dim)
        for rb in (whole.slice(at, n) for whole in batches for at, n in _parts(whole.column(whole.schema.get_field_index("_tokens")), FLAT_VALUES, FLAT_ROWS)):
            b = rb.column(rb.schema.get_field_index("_tokens"))
            n = rb.num_rows
            lens = pc.fill_null(pc.list_value_length(b), 0).to_numpy().astype(np.int64)
            coded = pc.list_flatten(b).dictionary_encode()
            buckets = np.array([known[t] for t in coded.dictionary.to_pylist()], dtype=np.int64)
            flat = buckets[coded.indices.to_numpy(zero_copy_only=False)] if len(buckets) else np.zeros(0, dtype=np.int64)
            rows = np.repeat(np.arange(n, dtype=np.int64), lens)
            m = np.bincount(rows * dim + flat, minlength=n * dim).reshape(n, dim).astype(np.float64)
            nrm = np.sqrt((m * m).sum(axis=1, keepdims=True))
            m = np.divide(m, nrm, out=m, where=nrm > 0).astype(np.float32)
            offsets = pa.array(np.arange(0, (n + 1) * dim, dim, dtype=np.int32))
            vec = pa.ListArray.from_arrays(offsets, pa.array(m.reshape(-1)), mask=b.is_null())
            cols = [rb.column(rb.schema.get_field_index(c)) for c in names] + [vec]
            yield pa.RecordBatch.from_arrays(cols, names=names + [out_col])

    return staged.mapInArrow(run, schema)


def nibble_counts(payload: Column) -> Column:
    """``array<long>`` of 16 counts: low nibble of every byte of ``payload``
    (binary, or a string taken as its UTF-8 bytes)."""
    low = F.regexp_replace(F.hex(payload), "(.)(.)", "$2")
    n = F.length(low)
    return F.array(*[(n - F.length(F.replace(low, F.lit(d), F.lit("")))).cast("long") for d in HEX_DIGITS])


def unit(counts: Column) -> Column:
    """Counts scaled to unit length as ``array<float>`` (zero stays zero).

    The norm is computed once, in the ``finish`` step of ``aggregate``
    (a lambda cannot share a sub-expression with its caller)."""
    return F.aggregate(
        counts, F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x,
        lambda ss: F.transform(counts, lambda x: F.when(ss > 0, x.cast("double") / F.sqrt(ss))
                               .otherwise(x.cast("double")).cast("float")))


def nibble_histogram_vectors(payload: Column) -> Column:
    return unit(nibble_counts(payload))


def embed_text(df: DataFrame, text_col: str, run_id: str, key: str = "screen_id", dim: int = TEXT_DIMS,
               model: tuple[str, str] = TEXT_MODEL) -> DataFrame:
    """Embedding-table rows for texts (fingerprint = SHA-256 of the text)."""
    v = with_hash_vectors(df.select(F.col(key).alias("screen_id"), F.col(text_col).alias("_text")), "_text",
                          "vector", dim)
    return v.select(
        "screen_id", F.lit(model[0]).alias("model_name"), F.lit(model[1]).alias("model_version"),
        F.lit("text").alias("embedding_kind"), "vector",
        F.lit(run_id).alias("run_id"), fingerprint(F.col("_text")).alias("source_fingerprint"))


def embed_binary(df: DataFrame, bytes_col: str, run_id: str, key: str = "screen_id",
                 model: tuple[str, str] = BYTES_MODEL) -> DataFrame:
    """Embedding-table rows for payload bytes (fingerprint of the bytes)."""
    # counts first, as a column: the normalisation reads them twice
    counted = spread(df).withColumn("_counts", nibble_counts(F.col(bytes_col)))
    return counted.select(
        F.col(key).alias("screen_id"), F.lit(model[0]).alias("model_name"), F.lit(model[1]).alias("model_version"),
        F.lit("image").alias("embedding_kind"), unit(F.col("_counts")).alias("vector"),
        F.lit(run_id).alias("run_id"), fingerprint(F.col(bytes_col)).alias("source_fingerprint"))


def embed_with(df: DataFrame, input_col: str, make_encoder: Callable[[], Callable[[list], np.ndarray]],
               key: str = "screen_id", normalize: bool = True) -> DataFrame:
    """Pluggable encoder: ``make_encoder()`` runs once per task (model load),
    the returned callable encodes a bounded part of an Arrow batch (one forward
    pass, see ``_parts``) and returns a (rows × dim) array.  Keys stay beside their vectors, so no
    positional pairing is needed."""
    key_type = df.schema[key].dataType.simpleString()
    schema = f"{key} {key_type}, vector array<float>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = make_encoder()
        for batch in (whole.slice(at, n) for whole in batches for at, n in _parts(whole.column("_input"))):
            m = np.asarray(enc(batch.column("_input").to_pylist()), dtype=np.float64)
            if normalize:
                n = np.sqrt((m * m).sum(axis=1, keepdims=True))
                m = np.divide(m, n, out=np.zeros_like(m), where=n > 0)
            offsets = pa.array(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32))
            # keys stay in Arrow: a null among them must not change the others
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.ListArray.from_arrays(offsets, pa.array(m.astype(np.float32).reshape(-1)))], [key, "vector"])

    return spread(df.select(F.col(key).alias("_key"), F.col(input_col).alias("_input"))).mapInArrow(run, schema)
