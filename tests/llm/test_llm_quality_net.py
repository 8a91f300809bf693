"""The quality classifier: word vectors and pooling against plain Python, and held-out accuracy."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import documents, odd_texts

from netload.llm import quality_net
from netload.llm.wordhash import SLICE_BYTES

LABELS = "doc_id BIGINT, quality INT, toxic INT, score DOUBLE, features STRING"


def pieces(text):
    out, kind = [], None
    for b in text.encode():
        now = " " if b in b" \t\n\x0b\x0c\r" else "a" if chr(b).isalpha() and b < 128 or b >= 128 else "0" if 48 <= b < 58 else b
        if now != " " and now == kind:
            out[-1] += bytes([b])
        elif now != " ":
            out.append(bytes([b]))
        kind = now
    return out


def code(piece):
    return int(quality_net.words_of(pa.array([piece.decode()]))[0][0])


def test_words_are_runs_of_one_kind():
    texts = ["Don't stop!! $$$ 12ab", "", " \n", "Émile,!漢字 x", "a\x00b"]
    codes, first = quality_net.words_of(pa.array(texts))
    assert first.tolist() == list(np.cumsum([0] + [len(pieces(t)) for t in texts]))
    flat = [p for t in texts for p in pieces(t)]
    assert len(set(codes.tolist())) == len(set(flat))
    assert all((a == b) == (flat[i] == flat[j]) for i, a in enumerate(codes) for j, b in enumerate(codes))


def test_a_long_text_has_the_words_of_the_whole():
    text = " ".join(f"word{i} ..." for i in range(150_000))
    assert len(text) > SLICE_BYTES
    whole, _ = quality_net._codes(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    parts, first = quality_net.words_of(pa.array([text]))
    assert (whole == parts).all() and first.tolist() == [0, len(whole)]


def index_vector(piece):
    out = np.zeros(quality_net.DIM, int)
    for place, sign in quality_net._index(np.array([code(piece)], np.uint64)):
        out[place[0]] += sign[0]
    return out


@pytest.mark.parametrize("chunk", [3, 1 << 16])
def test_vectors_and_pooling_equal_plain_python(spark, monkeypatch, chunk):
    monkeypatch.setattr(quality_net, "CHUNK", chunk)
    texts = ["a b a c !! a", "", "a", "the the the the", "x y\nz 1 2"]
    codes, first = quality_net.words_of(pa.array(texts))
    table = np.zeros(quality_net.BUCKETS * quality_net.DIM, np.int64)
    quality_net.add_contexts(table, codes, first)
    expected = defaultdict(lambda: np.zeros(quality_net.DIM, int))
    for t in texts:
        own = pieces(t)
        for i, p in enumerate(own):
            for j in range(max(0, i - 2), min(len(own), i + 3)):
                if j != i:
                    expected[code(p) % quality_net.BUCKETS] += index_vector(own[j])
    got = table.reshape(-1, quality_net.DIM)
    assert {int(i) for i in np.flatnonzero(got.any(axis=1))} == {k for k, v in expected.items() if v.any()}
    assert all((got[k] == v).all() for k, v in expected.items())

    vectors = np.random.default_rng(0).normal(size=(quality_net.BUCKETS, quality_net.DIM)).astype(np.float32)
    features = quality_net.pooled(vectors, codes, first)
    for t, row in zip(texts, features):
        own = np.array([vectors[code(p) % quality_net.BUCKETS] for p in pieces(t)], float).reshape(-1, quality_net.DIM)
        n = len(own)
        mean = own.mean(axis=0) if n else np.zeros(quality_net.DIM)
        spread = own.std(axis=0) if n else np.zeros(quality_net.DIM)
        step = np.abs(np.diff(own, axis=0)).mean(axis=0) if n > 1 else np.zeros(quality_net.DIM)
        assert np.allclose(row, [*mean, *spread, *step, np.log1p(n)], atol=1e-4)


def test_tables_of_tasks_add_up(spark):
    docs = documents(spark, [(i, f"w{i % 7} x y{i % 3} ! z") for i in range(200)] + odd_texts())
    assert np.array_equal(quality_net.word_vectors(docs.repartition(9)), quality_net.word_vectors(docs.coalesce(1)))


def test_network_learns_and_calibrates():
    draw = np.random.default_rng(3)
    x = draw.normal(size=(4000, 5))
    y = (draw.random(4000) < 1 / (1 + np.exp(-3 * (x[:, 0] ** 2 - 1)))).astype(int)
    net = quality_net.fit(x, y, rounds=30)
    scores = net.score(x)
    assert ((scores >= 0.5) == y).mean() > 0.8
    for low in (0.1, 0.3, 0.5, 0.7):
        own = (scores >= low) & (scores < low + 0.2)
        assert abs(y[own].mean() - scores[own].mean()) < 0.12


@pytest.mark.parametrize("kinds", [[], [1], [0, 1]])
def test_odd_texts_and_labels(spark, kinds):
    docs = documents(spark, odd_texts())
    rows = [(i, k, 0, 0.5, "x") for k in kinds for i in range(-3, 12)] + [(None, 1, 0, None, None), (1, None, 0, None, None), (2, 7, 0, None, None)]
    found = quality_net.scored(docs, spark.createDataFrame(rows, LABELS))
    got = found.collect()
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    assert sorted((r.doc_id for r in got), key=repr) == sorted((i for i, _ in odd_texts()), key=repr)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1 and len({r.score for r in got if r.doc_id == 5}) == 1
    assert quality_net.scored(docs.limit(0), spark.createDataFrame(rows, LABELS)).count() == 0


def test_only_allowed_labels_teach(spark):
    docs = documents(spark, [(i, f"text {i}") for i in range(60)])
    features = docs.selectExpr("doc_id", f"unhex(repeat('00', {4 * (3 * quality_net.DIM + 1)})) AS features")
    labels = spark.createDataFrame([(i, i % 2, 0, None, None) for i in range(60)] + [(7, 0, 0, None, None), (8, 0, 0, None, None)], LABELS)
    _, known = quality_net._examples(features.union(features), labels, 1000)
    allowed = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1 and i != 7]
    assert known.tolist() == [i % 2 for i in allowed]
    assert 0 < len(quality_net._examples(features, labels, 10)[1]) <= 10


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in quality_net.op11_quality_classifier(spark, folder).collect() if r.held_out and r.doc_id in labels]
    assert len(rows) > 100
    for quality in (0, 1):
        own = [r.predicted == quality for r in rows if labels[r.doc_id] == quality]
        assert np.mean(own) > 0.9
