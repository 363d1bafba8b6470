from __future__ import annotations

import hashlib
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest

from snapledger.llm import bpe, token_files
from snapledger.llm.pieces import encode_slices
from snapledger.llm.queries import QUERIES
from tests.llm import brute

LETTERS = " \n\t\r\x0b\x0c\x1c\x85\xa0 　 ab'sS'llé1²٣#$%字漢😀́é,.;:!?×÷»<|"


def _noise(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(LETTERS) for _ in range(r.randrange(50))) for _ in range(n)]


@pytest.fixture(scope="module")
def codec():
    return bpe.default_codec()


def test_perfect_hash():
    keys = [f"k{i}".encode() for i in range(3000)]
    hashed = bpe.PerfectHash(keys)
    assert sorted(hashed.index(k) for k in keys) == list(range(3000))
    assert all(hashed.index(f"x{i}".encode()) == -1 for i in range(3000))
    assert bpe.PerfectHash([]).n == 0


def test_same_ids_as_the_library(codec):
    library = brute.byte_bpe()
    texts = [None, "", " ", "a" * 3000, "<|endoftext|>", "é à  b\xa0 c", *_noise(4000, 1)]
    at = 0
    for ids, bounds in encode_slices(pa.array(texts, pa.string()), codec.memo):
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            assert ids[a:b].tolist() == library.encode_ordinary(texts[at] or "")
            at += 1
    assert at == len(texts)


def test_byte_bpe_query(spark, tables, texts):
    library = brute.byte_bpe()
    for r in QUERIES["op6_byte_bpe"](spark, tables).collect():
        ids = np.array(library.encode_ordinary(texts[r.doc_id]), "<u4").tobytes()
        assert r.n_tokens == len(ids) // 4 and r.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_byte_bpe_edges(odd, empty, codec):
    found = bpe.decode_ids(bpe.encode_texts(odd, codec), codec)
    assert found.columns == [*odd.columns, "token_ids", "decoded"] and found.count() == odd.count()
    assert all(r.decoded.decode() == (r.text or "") for r in found.collect())
    assert bpe.encode_texts(empty, codec).collect() == []
    # A column of the result's name is replaced.
    again = bpe.encode_texts(found.select("doc_id", "text", "token_ids"), codec)
    assert again.columns == ["doc_id", "text", "token_ids"]


def _word_model():
    import public_tokenizers as public
    from tokenizers import Tokenizer

    with open(public.path("word_bpe_49k.json"), encoding="utf-8") as file:
        model = file.read()
    return model, Tokenizer.from_str(model)


def test_token_files_query(spark, tables, texts):
    _, library = _word_model()
    found = {r.doc_id: r for r in QUERIES["op3_token_files"](spark, tables).collect()}
    start = 0
    for i in sorted(texts):
        ids = np.array([*library.encode(texts[i], add_special_tokens=False).ids, 2], "<u4")
        r = found[i]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(found) == len(texts)


def test_plain_pieces_skip_the_librarys_normaliser():
    """Accented words and words with marks take the model's merges only, with the library's ids."""
    model, library = _word_model()
    assert token_files.plain_parts(b" plain") == ["plain"]
    assert token_files.plain_parts(" Éçß".encode()) == ["Ã©Ã§ÃŁ"]
    assert token_files.plain_parts(" pfté$$$".encode()) == ["pftÃ©", "$$$"]
    for other in (b"", b" ", b"it's", b".5", b" a1", b"a.b", b"<|endoftext|>", " a×".encode(), " e\u0301".encode(), " İ".encode()):
        assert token_files.plain_parts(other) is None
    r = random.Random(7)
    letters, marks = [chr(c) for c in range(0xC0, 0x100) if chr(c).isalpha()], [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    pieces = [f" {x}" for x in [*letters, *marks]]
    for _ in range(3000):
        word = r.choices([*letters, *"abcdefghijklmnopqrstuvwxyz"], k=r.randrange(9))
        pieces.append(" " * r.randrange(3) + "".join([*word, *r.choices(marks, k=r.randrange(4))]))
    pieces = [p.encode() for p in pieces]
    for piece, ids in zip(pieces, token_files.library_memo(model)()(pieces), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(piece.decode(), add_special_tokens=False).ids, piece


def test_token_files_edges(spark, odd, empty, tmp_path):
    model, library = _word_model()
    noise = [None, "", "<|endoftext|> X<|startoftext|>", "<|ENDOFTEXT|>", *_noise(1500, 2)]
    docs = spark.createDataFrame(list(enumerate(noise)), "doc_id long, text string")
    token_files.write_sequences(docs, f"{tmp_path}/n", model, 49_408)
    read = {r.doc_id: np.frombuffer(r.token_ids, "<u4").tolist() for r in token_files.read_sequences(spark, f"{tmp_path}/n").collect()}
    assert all(read[i] == library.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(noise))
    shuffled = token_files.read_shuffled(spark, f"{tmp_path}/n", seed=1).collect()
    order = [r.doc_id for r in shuffled]
    assert order != sorted(order) and sorted(order) == list(range(len(noise)))
    assert all(np.frombuffer(r.token_ids, "<u4").tolist() == read[r.doc_id] for r in shuffled)
    assert order == [r.doc_id for r in token_files.read_shuffled(spark, f"{tmp_path}/n", seed=1).collect()]
    # Large vocabularies take four bytes; null keys and repeated rows are records, too.
    token_files.write_sequences(odd, f"{tmp_path}/o", model, 100_000, end_id=99_999, max_records=2)
    back = token_files.read_sequences(spark, f"{tmp_path}/o").collect()
    assert len(back) == odd.count() and sum(r.doc_id is None for r in back) == 2
    assert all(r.token_ids[-4:] == struct.pack("<I", 99_999) for r in back)
    index = token_files.read_index(spark, f"{tmp_path}/o")
    assert index.count() == odd.count() and index.select("name").distinct().count() >= 4
    token_files.write_sequences(empty, f"{tmp_path}/e", model, 49_408)
    assert token_files.read_sequences(spark, f"{tmp_path}/e").collect() == []


def test_damage_is_found():
    good = token_files.frame(7, np.array([1, 2, 3], "<u4"), 2)
    key, ids, end = token_files.parse(memoryview(good), 0)
    assert (key, ids.tolist(), end) == (7, [1, 2, 3], len(good))
    for k in range(len(good) - 1):
        bad = bytearray(good)
        bad[k] ^= 1
        with pytest.raises((ValueError, struct.error)):
            token_files.parse(memoryview(bytes(bad)), 0)
    assert token_files.parse(memoryview(token_files.frame(None, np.array([], "<u4"), 4)), 0)[0] is None
