"""Operator 1 — BPE encoding and decoding.

Encoding is the backtracking algorithm: one Aho-Corasick pass over a word
gives, for every position, all vocabulary tokens that start there; the encoder
walks the word taking the longest token, accepts a token only if the merge
rules could leave it beside its left neighbour (pair-compatibility, decided
from the merge table by undoing merges), falls back to the next shorter token
and, when none is left, takes the last token back.  A position that was given
up is marked and never entered again, so the walk is linear in the word and
gives exactly the tokens that applying the merges in order would give.

Decoding is a gather: the token strings lie in one blob with an offset table
(an Arrow string array), ids index it, and a list join makes the texts.

Texts are cut into pieces as the vocabulary file asks; a bounded memo holds
pieces met before, so memory per task does not grow with the corpus.

Defined cases: null text is the empty text (no tokens, empty decoded text);
repeated rows give repeated results; an empty table gives no rows; only the id
and text columns are read, so other columns of any name do not matter; the
text is read whole, whatever its length; null ids pass through.
"""

from __future__ import annotations

import hashlib
import json
import re

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

MEMO = 300_000  # pieces in one generation of the memo; two generations are held
# texts of these characters only need no Unicode tables: they are in normal form, and which of
# them are letters, digits and white space is plain (fixed: ranges of the Unicode standard)
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ſ"
_UNPLAIN = re.compile(f"[^\\x00-\\x1b\\x20-\\x7f{LETTERS}\\xa1-\\xa9\\xab-\\xb1\\xb4\\xb6-\\xb8\\xbb\\xbf\\xd7\\xf7\\u2010-\\u2027\\u2030-\\u205e]")
_PLAIN_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\\s{LETTERS}0-9]+")
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # fixed: the vocabulary file's own pattern
_SPACE = r"\t-\r \x85\xa0  -     　"  # fixed: Unicode White_Space
_SPACES = regex.compile(f"[{_SPACE}]+")
_NOT_SPACE = "\x1c\x1d\x1e\x1f"  # str.split() cuts here, the vocabulary's white space does not
_SHIFT = 512  # symbol of a character that ends a word = its byte + _SHIFT


def byte_symbols() -> dict[str, int]:
    """Printable stand-in of each byte, as byte-level vocabularies use them: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 upwards."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def is_plain(text: str) -> bool:
    return _UNPLAIN.search(text) is None


class Memo(dict):
    """Results of ``make`` by key.  Holds at most two generations of ``limit`` keys; keys
    used lately move to the young one, the old one is forgotten when the young one is full."""

    def __init__(self, make, limit: int = MEMO):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Backtracker:
    """Exact BPE tokens of one piece (a word) by longest matches and pair checks.

    Tokens are numbered by merge rank: single symbols first, then merge results in
    the order of the merges, so of two merges the smaller number goes first."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], word_end: str | None):
        symbols = byte_symbols()
        self.own_of_byte = "".join(chr(b + 1) for b in range(256))
        end = word_end or ""

        def own(token: str) -> str:  # the token over private symbols: byte + 1, or that + _SHIFT at a word's end
            last = bool(end) and token.endswith(end)
            codes = [symbols[c] + 1 for c in (token[: -len(end)] if last else token)]
            if last:
                codes[-1] += _SHIFT
            return "".join(map(chr, codes))

        singles = [t for t in vocab if len(own(t)) == 1]
        self.names = singles + [a + b if not end or not a.endswith(end) else a + b for a, b in merges]
        number = {t: i for i, t in enumerate(self.names)}
        if len(number) != len(self.names):
            raise ValueError("two merges with one result: ranks are ambiguous")
        n = len(self.names)
        self.left, self.right = list(range(n)), list(range(n))
        self.pairs: dict[tuple[int, int], int] = {}
        for k, (a, b) in enumerate(merges, len(singles)):
            self.left[k], self.right[k] = number[a], number[b]
            self.pairs[number[a], number[b]] = k
        self.ids = [vocab[t] for t in self.names]
        self.length = [len(own(t)) for t in self.names]
        # a token that its own merges would not give back never occurs and is left out
        self.real = [True] * n
        for k in range(len(singles), n):
            a, b = self.left[k], self.right[k]
            self.real[k] = self.real[a] and self.real[b] and self.fits(a, b, k)
        self.machine = ahocorasick.Automaton()
        for k, t in enumerate(self.names):
            if self.real[k]:
                self.machine.add_word(own(t), k)
        self.machine.make_automaton()
        self.ends = bool(end)
        self.fitting = Memo(lambda pair: self.fits(*pair))

    def fits(self, a: int, b: int, limit: int | None = None) -> bool:
        """Could the merges leave ``a`` and ``b`` side by side?  Undo the merges of both at
        their common border, latest first; a pair that would have merged earlier forbids it.
        ``limit``: only merges before this rank count at first."""
        limit = len(self.names) if limit is None else limit
        while True:
            joined = self.pairs.get((a, b))
            if joined is not None and joined < limit:
                return False
            if a > b:
                limit, part = a, self.right[a]
                if part != a:
                    a = part
                    continue
                limit, part = b + 1, self.left[b]
                if part == b:
                    return True
                b = part
            else:
                limit, part = b + 1, self.left[b]
                if part != b:
                    b = part
                    continue
                limit, part = a, self.right[a]
                if part == a:
                    return True
                a = part

    def tokens(self, piece: bytes) -> list[int]:
        """Token numbers of a non-empty piece."""
        text = piece.decode("latin-1").translate(self.own_of_byte)
        if self.ends:
            text = text[:-1] + chr(piece[-1] + 1 + _SHIFT)
        n = len(text)
        starts: list[list[int]] = [[] for _ in range(n)]
        length, fitting = self.length, self.fitting
        for last, token in self.machine.iter(text):  # by end, so shortest first at each start
            starts[last + 1 - length[token]].append(token)
        if starts[0] and length[starts[0][-1]] == n:
            return [starts[0][-1]]
        closed = bytearray(n + 1)
        taken: list[int] = []
        choice: list[int] = []  # index in starts[...] of each taken token
        at, k = 0, len(starts[0]) - 1
        while at < n:
            here = starts[at]
            while k >= 0:
                token = here[k]
                if not closed[at + length[token]] and (not taken or fitting[taken[-1], token]):
                    break
                k -= 1
            if k >= 0:
                taken.append(token)
                choice.append(k)
                at += length[token]
                k = len(starts[at]) - 1 if at < n else 0
            else:
                closed[at] = 1
                if not taken:
                    raise ValueError("the vocabulary has no tokens for a byte of this text")
                at -= length[taken.pop()]
                k = choice.pop() - 1
        return taken


class Vocabulary:
    """A word vocabulary file: its normal form, its pieces, its tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.coder = Backtracker(model["vocab"], merges, model["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = pa.array([t for t, _ in sorted({**model["vocab"], **self.special}.items(), key=lambda x: x[1])])
        self.library, self.byte_of = Tokenizer.from_file(path), byte_symbols()
        self.pieces = regex.compile(_SPLIT)
        self.special_re = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.raw_ids = [i.to_bytes(4, "little") for i in self.coder.ids]
        self.piece_memo = Memo(self._piece)

    def _piece(self, piece: str) -> bytes:
        return b"".join(map(self.raw_ids.__getitem__, self.coder.tokens(piece.encode())))

    def cut(self, part: str) -> list[str]:
        """Pieces of a part in normal form.  Beyond plain texts the library's own normal form and
        cutting are used: which characters are letters depends on its Unicode version."""
        if part.isascii():
            return self.pieces.findall(part.lower())
        normal = self.library.normalizer.normalize_str(part)
        return [bytes(map(self.byte_of.__getitem__, p)).decode() for p, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def _chunk(self, chunk: str) -> bytes:
        """Ids (little-endian, 32 bits) of a text without white space."""
        out = []
        for part in self.special_re.split(chunk) if "<|" in chunk else (chunk,):
            if part in self.special:
                out.append(self.special[part].to_bytes(4, "little"))
            elif part:
                out += map(self.piece_memo.__getitem__, self.cut(part))
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if "<|" not in text and is_plain(text):
            return b"".join(map(self.piece_memo.__getitem__, _PLAIN_SPLIT.findall(text.lower())))
        chunks = [c for c in _SPACES.split(text) if c] if any(c in text for c in _NOT_SPACE) else text.split()
        return b"".join(map(self._chunk, chunks))

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Texts of several id runs (``offsets`` cut ``ids``): tokens joined by blanks."""
        runs = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), self.strings.take(pa.array(ids)))
        return pc.binary_join(runs, " ")


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary at ``path``, read once in each process."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def _slices(batch: pa.RecordBatch, nbytes: int = 4 << 20):
    """Parts of a batch with about ``nbytes`` of text each (one row at least)."""
    texts = batch.column("text").cast(pa.binary())
    ends = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).cumsum()
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + nbytes)))
        yield batch.slice(start, stop - start)
        start = stop


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """(doc_id, ids array<int>) of every row of ``docs``, in its partitions as they are; with
    ``digest`` the ids are decoded again, and decoded_sha256 is the text's hash."""

    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            for part in _slices(batch):
                runs = [vocab.encode(t or "") for t in part.column("text").to_pylist()]
                offsets = np.cumsum([0] + [len(r) // 4 for r in runs])
                flat = np.frombuffer(b"".join(runs), "<i4")
                columns = [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))]
                if digest:
                    texts = vocab.decode(flat, offsets).cast(pa.binary()).to_pylist()
                    columns.append(pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded_sha256"][: len(columns)])

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>" + (", decoded_sha256 string" if digest else ""))


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of rows with ids; null ids give the empty text."""

    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            lists = pc.fill_null(batch.column("ids"), pa.scalar([], pa.list_(pa.int32())))
            offsets = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists)))])
            texts = vocab.decode(np.asarray(lists.flatten()), offsets).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], ["doc_id", "text"])

    rows = encoded.select(encoded[id_col].alias("doc_id"), encoded[ids_col].cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every row in one pass, returning digests instead of the (large)
    ids and texts: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            for part in _slices(batch):
                runs = [vocab.encode(t or "") for t in part.column("text").to_pylist()]
                offsets = np.cumsum([0] + [len(r) // 4 for r in runs])
                texts = vocab.decode(np.frombuffer(b"".join(runs), "<i4"), offsets).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(offsets), pa.int64()),
                     pa.array([hashlib.sha256(r).hexdigest() for r in runs]),
                     pa.array([hashlib.sha256(t).hexdigest() for t in texts.to_pylist()])],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, "
                                "ids_sha256 string, decoded_sha256 string")
