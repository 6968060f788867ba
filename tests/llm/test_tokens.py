"""BPE and the token store against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tessera.llm import bpe, tokenstore
from tessera.llm.queries import BYTE_BPE, WORD_BPE
from tests.conftest import SF_SMALL


def _texts():
    rng = random.Random(7)
    alphabet = "abcdefgthein  '\n\tÉéüñßΣΩçİŸĿ'’“”1234٣½漢字かな😀!?.,<|>_́ 　\x1c\x85​"
    out = ["", " ", "It's we'll DON'T", "<|endoftext|>", "a<|startoftext|>b <|endoftext|>", "ΑΣ ΟΔΟΣ", "foo  bar \n\n baz ", "x" * 3000, "\x00\x1f a"]
    out += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    out += ["".join(rng.choice("aethionsr") for _ in range(rng.randint(1, 50))) for _ in range(800)]
    return out


@pytest.mark.parametrize("path", [WORD_BPE])
def test_encoder_and_decoder_equal_the_library(path):
    library, vocab = Tokenizer.from_file(path), bpe.vocabulary(path)
    texts = _texts()
    runs = [vocab.encode(t) for t in texts]
    wanted = library.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(r, "<u4").tolist() for r in runs] == [w.ids for w in wanted]
    offsets = np.cumsum([0] + [len(r) // 4 for r in runs])
    assert vocab.decode(np.frombuffer(b"".join(runs), "<i4"), offsets).to_pylist() == [library.decode(w.ids, skip_special_tokens=False) for w in wanted]


def test_backtracking_equals_merging_in_order():
    rng = random.Random(3)
    for _ in range(60):  # small random merge tables, words over two letters
        vocab, merges = {c: i for i, c in enumerate("ab")}, []
        while len(merges) < 8:
            a, b = rng.choice(list(vocab)), rng.choice(list(vocab))
            if a + b not in vocab and len(a + b) < 6:
                vocab[a + b] = len(vocab)
                merges.append((a, b))
        coder = bpe.Backtracker(vocab, merges, None)
        for _ in range(40):
            word = "".join(rng.choice("ab") for _ in range(rng.randint(1, 14)))
            parts = list(word)
            for a, b in merges:
                k = 0
                while k < len(parts) - 1:
                    if (parts[k], parts[k + 1]) == (a, b):
                        parts[k:k + 2] = [a + b]
                    k += 1
            assert [coder.names[t] for t in coder.tokens(word.encode())] == parts


def test_token_store_encoder_equals_the_library():
    library, coder = Tokenizer.from_file(BYTE_BPE), tokenstore.encoder(BYTE_BPE)
    texts = _texts()
    assert [np.frombuffer(coder.encode(t), coder.dtype).tolist() for t in texts] == [w.ids for w in library.encode_batch(texts, add_special_tokens=False)]


def test_round_trip_query(spark):
    from tessera.llm.queries import op1_bpe

    library = Tokenizer.from_file(WORD_BPE)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = op1_bpe(spark, SF_SMALL).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_encode_then_decode_columns(spark, edge, nothing):
    library = Tokenizer.from_file(WORD_BPE)
    encoded = bpe.encode(edge, WORD_BPE)
    got = sorted((r.doc_id or -1, r.text) for r in bpe.decode(encoded, WORD_BPE).collect())
    want = sorted((r.doc_id or -1, library.decode(library.encode(r.text or "", add_special_tokens=False).ids, skip_special_tokens=False)) for r in edge.collect())
    assert got == want
    assert bpe.encode(nothing, WORD_BPE).count() == 0 and bpe.round_trip(nothing, WORD_BPE).count() == 0
    assert bpe.round_trip(edge, WORD_BPE).count() == edge.count()


def test_token_output_query(spark):
    from tessera.llm.queries import op9_token_output

    library, start = Tokenizer.from_file(BYTE_BPE), 0
    rows = {r.doc_id: r for r in op9_token_output(spark, SF_SMALL).collect()}
    for doc in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array(library.encode(doc.text or "", add_special_tokens=False).ids + [0], "<u4")
        r = rows.pop(doc.doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not rows


def test_token_store_files(spark, edge, nothing, tmp_path):
    folder = str(tmp_path / "store")
    tokenstore.write(edge, folder, BYTE_BPE, end_id=0)
    rows = tokenstore.read(spark, folder).collect()
    assert len(rows) == edge.count()
    ordered = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((r.doc_id for r in rows), key=lambda i: (i is not None, i))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(ordered, ordered[1:]))
    one = tokenstore.fetch(spark, folder, [7]).collect()
    assert [bytes(r.ids) for r in one] == [bytes(r.ids) for r in rows if r.doc_id == 7]
    empty = str(tmp_path / "empty")
    tokenstore.write(nothing, empty, BYTE_BPE, end_id=0)
    assert tokenstore.read(spark, empty).count() == 0


def test_foreign_dictionary_is_refused(spark, edge, tmp_path):
    folder, other = str(tmp_path / "a"), str(tmp_path / "b")
    tokenstore.write(edge.where("doc_id < 6"), folder, BYTE_BPE, end_id=0)
    spark.createDataFrame([(hashlib.sha256(b"else").hexdigest(), bytearray(b"else"))], "dict_sha256 string, dictionary binary").write.parquet(f"{other}/dictionary")
    spark.read.parquet(f"{folder}/segments").write.parquet(f"{other}/segments")
    with pytest.raises(Exception, match="another dictionary"):
        tokenstore.read(spark, other).collect()


def test_fetch_reads_the_segments_in_range_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenstore, "SEGMENT_BYTES", 64)
    docs = spark.range(200).selectExpr("id AS doc_id", "concat('text number ', id, ' of some') AS text")
    folder = str(tmp_path / "store")
    tokenstore.write(docs, folder, BYTE_BPE, end_id=0)
    whole = {r.doc_id: bytes(r.ids) for r in tokenstore.read(spark, folder).collect()}
    found = tokenstore.fetch(spark, folder, [3, 150, 999])
    assert {r.doc_id: bytes(r.ids) for r in found.collect()} == {3: whole[3], 150: whole[150]}
    scan = next(line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)
    assert "first_id" in scan.split("DataFilters")[1] or "first_id" in scan.split("PushedFilters")[1]
