"""Token ids: byte-level BPE against tiktoken, bit planes against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from llm_cases import documents, odd_texts, sentence
from tokenizers import Tokenizer

from netload.llm import byte_bpe, planes
from netload.llm.vocab import ByteIds, WordIds

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LETTERS = "aAzZéÉçßİıſK Ǆé ́ \t\n\r\x0b\x0c\x1c\x85\xa0 　01９²'’sS'Stre'LL<|endoftext|></w>.!?#漢字한글가‍😀🏽\x00"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={}
    )


def strange(n):
    draw = random.Random(3)
    return ["".join(draw.choice(LETTERS) for _ in range(draw.randint(0, 30))) for _ in range(n)] + [
        "a <|endoftext|> b", "x<|endoftext|>y<|startoftext|>", "<|startoftext|>", "a  <|endoftext|> \n b ", "<| <|endoftext", "A<|ENDOFTEXT|>",
        "", "a" * 500, "=-" * 200, " " * 300, "ab" * 40, "".join(draw.choice("abc") for _ in range(900)),
    ]


def test_folds_equal_the_library(library):
    texts = strange(2000)
    ids, counts = byte_bpe.RankIds(RANKS, public_tokenizers.PATTERN).of(pa.array(texts))
    cuts = np.cumsum(counts)
    assert [ids[e - n : e].tolist() for n, e in zip(counts, cuts)] == [library.encode_ordinary(t) for t in texts]


def test_higher_order_functions_fold_alike(spark, library):
    pieces = [" the", "x", "word", "ing", "é", "漢字", "zzzzzzz", " qwertyuiop"]
    frame = spark.createDataFrame([(bytearray(p.encode()),) for p in pieces], "piece BINARY")
    got = {bytes(r.piece).decode(): r.ids for r in byte_bpe.folded(frame, library._mergeable_ranks).collect()}
    assert got == {p: library.encode_ordinary(p) for p in pieces}


def test_encoding_and_decoding_whole_columns(spark, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "FREQUENT", 20)
    docs = documents(spark, odd_texts())
    found = byte_bpe.encoded(docs, RANKS, public_tokenizers.PATTERN)
    back = found.select("doc_id", "ids", byte_bpe.decoded(found["ids"], RANKS).alias("raw")).collect()
    got = sorted(((r.doc_id, r.ids, bytes(r.raw)) for r in back), key=repr)
    assert got == sorted(((i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in odd_texts()), key=repr)
    assert byte_bpe.encoded(docs.limit(0), RANKS).count() == 0
    assert byte_bpe.digests(docs.limit(0), RANKS).count() == 0
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    want = [(i, len(ids), sha(",".join(map(str, ids)).encode()), sha(raw)) for i, ids, raw in got]
    assert sorted(map(tuple, byte_bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect()), key=repr) == sorted(want, key=repr)


def test_a_list_that_is_null_decodes_to_null(spark):
    lists = spark.createDataFrame([(1, [0, 1]), (2, None), (3, [])], "i INT, ids ARRAY<INT>")
    got = {r.i: r.raw for r in lists.select("i", byte_bpe.decoded(lists["ids"], RANKS).alias("raw")).collect()}
    assert got[2] is None and bytes(got[3]) == b"" and len(got[1]) == 2


@pytest.mark.parametrize(("kind", "name"), [(WordIds, "word_bpe_49k.json"), (ByteIds, "byte_bpe_50k.json")])
def test_remembered_pieces_give_the_ids_of_the_library(kind, name, monkeypatch):
    monkeypatch.setattr("netload.llm.vocab.REMEMBERED", 50)  # forgets again and again
    library = Tokenizer.from_file(public_tokenizers.path(name))
    known, texts = kind(public_tokenizers.path(name)), strange(600)
    for at in range(0, len(texts), 40):
        ids, counts = known.of(pa.array(texts[at : at + 40]))
        cuts = np.cumsum(counts)
        want = [library.encode(t, add_special_tokens=False).ids for t in texts[at : at + 40]]
        assert [ids[e - n : e].tolist() for n, e in zip(counts, cuts)] == want


@pytest.mark.parametrize("text", ["two  blanks \n    and code{} " * 40, "漢字{}" * 400, "x{}y-" * 300])
def test_memory_is_bounded(text, monkeypatch):
    monkeypatch.setattr("netload.llm.vocab.REMEMBERED", 100)
    monkeypatch.setattr("netload.llm.vocab.REMEMBERED_IDS", 500)
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, known = Tokenizer.from_file(path), ByteIds(path)
    for at in range(60):
        texts = [text.replace("{}", f"{at}{i}") for i in range(3)] + ["plain words"]
        ids, counts = known.of(pa.array(texts))
        cuts = np.cumsum(counts)
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert [ids[e - n : e].tolist() for n, e in zip(counts, cuts)] == want
        assert len(known._codes) <= 100 and len(known._ids) <= 500


def test_long_parts_are_not_remembered():
    known = ByteIds(public_tokenizers.path("byte_bpe_50k.json"))
    known.of(pa.array(["x" * 1000 + " short", None, ""]))
    assert len(known._codes) == 1


@pytest.mark.parametrize(("kind", "name"), [(WordIds, "word_bpe_49k.json"), (ByteIds, "byte_bpe_50k.json")])
def test_a_text_beyond_one_slice(kind, name, monkeypatch):
    monkeypatch.setattr("netload.llm.vocab.SLICE_BYTES", 40)
    library, known = Tokenizer.from_file(public_tokenizers.path(name)), kind(public_tokenizers.path(name))
    texts = ["", sentence(200), "漢字" * 60, " lead  and trail ", "é " * 90]
    ids, counts = known.of(pa.array(texts))
    cuts = np.cumsum(counts)
    assert [ids[e - n : e].tolist() for n, e in zip(counts, cuts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("bits", [1, 8])
def test_planes_round_trip(bits):
    for n in (1, 7, 8, 1000):
        ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
        packed = planes.to_planes(ids, bits)
        assert len(packed) == 32 // bits
        assert planes.from_planes(packed, n, bits).tolist() == ids.tolist()
        assert planes._restored(*planes._compressed(ids % 50000, bits), n).tolist() == (ids % 50000).tolist()


@pytest.mark.parametrize("bits", [1, 8])
def test_files_give_back_every_document(spark, tmp_path, monkeypatch, bits):
    path, library = public_tokenizers.path("byte_bpe_50k.json"), None
    library = Tokenizer.from_file(path)
    texts = [(i, t) for i, t in odd_texts() if i not in (None, 5)] + [(50 + i, sentence(9000, i)) for i in range(6)]
    planes.write_ids(documents(spark, texts), str(tmp_path / "out"), path, bits=bits)
    found = {r.doc_id: r for r in planes.read_ids(spark, str(tmp_path / "out")).collect()}
    before = 0
    for doc_id, text in sorted(texts):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], np.uint32)
        row = found.pop(doc_id)
        assert (row.start, row.n_tokens, zlib.crc32(row.ids)) == (before, len(ids), zlib.crc32(ids.tobytes()))
        before += len(ids)
    assert not found


def test_files_of_odd_and_empty_tables(spark, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = documents(spark, odd_texts())
    planes.write_ids(docs, str(tmp_path / "odd"), path)
    assert planes.read_ids(spark, str(tmp_path / "odd")).count() == docs.count()
    planes.write_ids(docs.limit(0), str(tmp_path / "none"), path)
    assert planes.read_ids(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError, match="bits"):
        planes.write_ids(docs, str(tmp_path / "bad"), path, bits=2)
