"""Each registered query over a given table: against its SQL twin, or plain Python and the untouched libraries."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm_cases import low, words
from tokenizers import Tokenizer

from netload.llm import byte_bpe
from netload.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r.doc_id, r.text or "") for r in rows)


def rows(spark, sf_dir, name, *columns):
    return sorted(map(tuple, QUERIES[name](spark, sf_dir).select(*columns).collect()), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_its_twin(spark, sf_dir, name):
    base = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        base.execute(f"CREATE VIEW {table} AS FROM '{sf_dir}/{table}.parquet'")
    found = base.execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    frame = QUERIES[name](spark, sf_dir)
    assert set(columns) == set(frame.columns)
    assert sorted(map(tuple, frame.select(columns).collect()), key=repr) == sorted(found.fetchall(), key=repr)


def test_every_query_is_numbered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_base_score(spark, sf_dir, texts):
    own = {i: words(low(t)) + [None] for i, t in texts}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in own}
    counts = Counter(w for i in own if not out[i] for w in own[i])
    total, distinct = sum(counts.values()), len(counts)
    got = QUERIES["op2_lattice_score"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.held_out, r.n_tokens, r.train_tokens) == (out[r.doc_id], len(own[r.doc_id]), total)
        assert r.n_known == sum(counts[w] > 0 for w in own[r.doc_id])
        want = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own[r.doc_id])
        assert r.base_score == pytest.approx(want, rel=1e-9) and r.score < 0


def test_quality_measures(spark, sf_dir, texts):
    from test_llm_texts import measured

    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert rows(spark, sf_dir, "op3_quality_rules", "doc_id", *columns) == sorted(((i, *measured(t)) for i, t in texts), key=repr)
    kept = rows(spark, sf_dir, "op3_quality_rules", "base_failed", "posterior", "kept")
    assert all(k == (not failed and posterior >= 0.5) for failed, posterior, k in kept)


PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}


def test_license_places(spark, sf_dir, texts):
    want = []
    for i, t in texts:
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
        places = [(k, label) for k in range(len(own)) for p, label in PHRASES.items() if tuple(own[k : k + len(p)]) == p]
        starts = [k for k, _ in places]
        want.append((i, len(own), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))))
    assert rows(spark, sf_dir, "op5_license_scan", "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(want, key=repr)
    for base, labels, score in rows(spark, sf_dir, "op5_license_scan", "base_labels", "labels", "score"):
        assert set(filter(None, base.split(","))) <= set(labels.split(",")) and 0 <= score <= 1


def test_byte_bpe(spark, sf_dir, texts):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(path), special_tokens={})
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    want = [(i, len(ids), sha(",".join(map(str, ids)).encode()), sha(t.encode())) for i, t in texts for ids in [library.encode_ordinary(t)]]
    assert rows(spark, sf_dir, "op7_byte_level_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)


def test_shards(spark, sf_dir, texts):
    got = rows(spark, sf_dir, "op8_sharding", "doc_id", "size", "text_crc32")
    assert got == sorted(((i, len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in texts), key=repr)
    shards = defaultdict(list)
    for shard, slot, law in rows(spark, sf_dir, "op8_sharding", "shard", "slot", "law"):
        shards[shard].append(slot)
        assert law == "rows"
    assert sorted(shards) == list(range(24)) and all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1


def test_written_ids(spark, sf_dir, texts):
    library, want, before = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), [], 0
    for i, t in texts:
        ids = np.array(library.encode(t, add_special_tokens=False).ids + [0], np.uint32)
        want.append((i, before, len(ids), zlib.crc32(ids.tobytes())))
        before += len(ids)
    assert rows(spark, sf_dir, "op9_bit_plane_output", "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)


def test_packed_ids(spark, sf_dir, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: np.array(library.encode(t, add_special_tokens=False).ids + [1], np.uint32) for i, t in texts}
    upto, filled = Counter(), defaultdict(list)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    for i, start, length, crc, total, sequence, offset in sorted(rows(spark, sf_dir, "op10_harmonic_packing", *columns)):
        assert (start, total) == (upto[i], len(ids[i])) and zlib.crc32(ids[i][start : start + length].tobytes()) == crc
        upto[i] += length
        filled[sequence].append((offset, length))
    assert all(upto[i] == len(own) for i, own in ids.items())
    for pieces in filled.values():
        ends = np.cumsum([n for _, n in sorted(pieces)])
        assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048
