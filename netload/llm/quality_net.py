"""A quality classifier: random-indexing word vectors, pooled per document, under a small network with calibrated probabilities.

Random indexing: every word has a sparse signed index vector, drawn from its hash,
and its word vector is the sum of the index vectors of its neighbours over all
texts. Words share ``BUCKETS`` rows by hash, so the table of vectors has one size
whatever the corpus. A task adds up a table of its own; tables are added in Spark.

A document is the mean of its words' vectors, their spread, the mean step from
a word to the next, and the logarithm of its length. A network of one hidden layer reads that;
its weights are fitted, in numpy on the driver, to at most ``TRAIN_ROWS`` labelled documents,
a fifth of which only set the temperature that makes scores probabilities.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netload.llm.schema import documents, kept, only_text
from netload.llm.wordhash import SLICE_BYTES, SPACE, byte_codes, range_hashes, slices, text_bytes

#: Rows of the table of word vectors (a power of two), and their components (likewise).
BUCKETS, DIM = 1 << 14, 32
#: Neighbours on each side that make up a word's context.
WINDOW = 2
#: Signed ones in an index vector.
ONES = 2
#: Labelled documents that the network is fitted to, at most. Everything else reads all documents.
TRAIN_ROWS = 20_000
HIDDEN = 32
#: Words whose vectors are in memory at a time.
CHUNK = 1 << 16

_N_FEATURES = 3 * DIM + 1
_ROWS_A_BLOCK = 1 << 8
_SALTS = 16
_BLOCKS = "block int, salt int, sums binary"
_BLOCK_SCHEMA = pa.schema([("block", pa.int32()), ("salt", pa.int32()), ("sums", pa.binary())])

#: White space, letters and other scripts, digits; every other byte is a kind of its own, so "!!" is one word and ",!" are two.
_KIND = np.arange(256, dtype=np.int16) + 256
_KIND[SPACE] = 0
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2


def _codes(data: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of some texts, and the first word of each text (one more entry than texts)."""
    kind = _KIND[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[where] = True
    edge[1:-1] |= kind[1:] != kind[:-1]
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    own = kind[starts] > 0
    starts, ends = starts[own], ends[own]
    return range_hashes(byte_codes(data), starts, ends), np.searchsorted(starts, where)


def _parts(data: np.ndarray) -> Iterator[np.ndarray]:
    """Runs of up to SLICE_BYTES of one text that end before white space, or where there is none for that long, anywhere."""
    at = 0
    while at < len(data):
        stop = min(at + SLICE_BYTES, len(data))
        blank = np.flatnonzero(SPACE[data[at:stop]]) if stop < len(data) else []
        stop = at + int(blank[-1]) if len(blank) and blank[-1] else stop
        yield data[at:stop]
        at = stop


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and the first of each text. Works on parts of a long text, so memory follows its words."""
    data, where = text_bytes(texts)
    if len(texts) != 1 or len(data) <= SLICE_BYTES:
        return _codes(data, where)
    codes = np.concatenate([_codes(part, np.array([0, len(part)]))[0] for part in _parts(data)])
    return codes, np.array([0, len(codes)])


def _buckets(codes: np.ndarray) -> np.ndarray:
    return (codes & np.uint64(BUCKETS - 1)).astype(np.int64)


def _index(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Component and sign of each one in the words' index vectors."""
    out, bits = [], DIM.bit_length()  # a component and one sign
    for k in range(ONES):
        own = codes >> np.uint64(24 + bits * k)
        out.append(((own & np.uint64(DIM - 1)).astype(np.int64), 1 - 2 * (own >> np.uint64(bits - 1) & np.uint64(1)).astype(np.int64)))
    return out


def add_contexts(table: np.ndarray, codes: np.ndarray, first: np.ndarray) -> None:
    """Adds to each word's row the index vectors of the words around it in its text."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    rows, ones = _buckets(codes) * DIM, _index(codes)
    for low in range(0, len(codes), CHUNK):
        cells, signs = [], []
        for step in range(1, WINDOW + 1):
            left = np.arange(low, max(low, min(low + CHUNK, len(codes) - step)))
            left = left[text[left] == text[left + step]]
            for a, b in ((left, left + step), (left + step, left)):
                for place, sign in ones:
                    cells.append(rows[a] + place[b])
                    signs.append(sign[b])
        found = np.bincount(np.concatenate(cells), np.concatenate(signs), BUCKETS * DIM)
        table += found.astype(np.int64)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    table = np.zeros(BUCKETS * DIM, np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            add_contexts(table, *words_of(part.column("text")))
    salt = TaskContext.get().partitionId() % _SALTS
    for block, sums in enumerate(table.reshape(-1, _ROWS_A_BLOCK * DIM)):
        if sums.any():
            yield _block(block, salt, sums)


def _block(block: int, salt: int, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((block, salt, sums.tobytes()), _BLOCK_SCHEMA)], schema=_BLOCK_SCHEMA)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block and salt; the rows come in their order."""
    key, total = None, None
    for batch in batches:
        for block, salt, sums in zip(*(batch.column(c).to_pylist() for c in ("block", "salt", "sums"))):
            if key != (block, salt):
                if key:
                    yield _block(*key, total)
                key, total = (block, salt), np.zeros(_ROWS_A_BLOCK * DIM, np.int64)
            total += np.frombuffer(sums, np.int64)
    if key:
        yield _block(*key, total)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The table of word vectors, from the contexts of all words of all texts: centred rows of length one. Runs a job."""
    sums = only_text(docs).select("text").mapInArrow(_contexts, _BLOCKS)
    for salt in (F.col("salt"), F.lit(0).alias("salt")):  # hot blocks are added in two rounds
        sums = sums.select("block", salt, "sums").repartition("block", "salt").sortWithinPartitions("block", "salt")
        sums = sums.mapInArrow(_added, _BLOCKS)
    table = np.zeros((BUCKETS // _ROWS_A_BLOCK, _ROWS_A_BLOCK * DIM))
    for r in sums.collect():  # of a size that BUCKETS and DIM set
        table[r["block"]] = np.frombuffer(r["sums"], np.int64)
    table = _unit(table.reshape(BUCKETS, DIM))
    used = table.any(axis=1)
    table[used] = _unit(table[used] - table[used].mean(axis=0)) if used.any() else 0
    return table.astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(length > 0, length, 1)


def pooled(table: np.ndarray, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A row for each text: mean vector, standard deviation, mean step between neighbours, log of the number of words."""
    n = len(first) - 1
    sums = np.zeros((3, n, DIM))
    text = np.repeat(np.arange(n), np.diff(first))
    rows = _buckets(codes)
    for low in range(0, len(codes), CHUNK):
        own = text[low : low + CHUNK]
        vectors = table[rows[low : low + CHUNK + 1]]
        steps = np.zeros((len(own), DIM), np.float32)
        moves = np.abs(np.diff(vectors, axis=0))
        steps[: len(moves)] = moves * (text[low + 1 : low + 1 + len(moves)] == own[: len(moves)])[:, None]
        vectors = vectors[: len(own)]
        cuts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        for into, values in zip(sums, (vectors, np.square(vectors, dtype=np.float64), steps)):
            into[own[cuts]] += np.add.reduceat(values, cuts, axis=0, dtype=np.float64)
    count = np.diff(first)[:, None]
    some = np.maximum(count, 1)
    mean = sums[0] / some
    spread = np.sqrt(np.maximum(sums[1] / some - mean * mean, 0))
    return np.concatenate([mean, spread, sums[2] / np.maximum(count - 1, 1), np.log1p(count)], axis=1).astype(np.float32)


def _pool(table) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = pooled(table.value, *words_of(part.column("text")))
                rows = pa.array([r.tobytes() for r in found], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), rows], names=["doc_id", "features"])

    return run


@dataclass
class Network:
    """Probability of label 1 from a document's features."""

    shift: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]  # input to hidden, its bias, hidden to output, its bias
    temperature: float = 1.0

    def inputs(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.shift) / self.scale, -6, 6)

    def logits(self, features: np.ndarray) -> np.ndarray:
        w, b, v, c = self.weights
        return np.tanh(self.inputs(features) @ w + b) @ v + c

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -500, 500)))


def _loss(logits: np.ndarray, labels: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, np.where(labels > 0, -logits, logits))))


def fit(features: np.ndarray, labels: np.ndarray, rounds: int = 60, seed: int = 11) -> Network:
    """Fits by Adam on four fifths of the rows, and the temperature on the rest.

    Without rows of both labels the network is constant: the smoothed share of label 1.
    """
    n, draw = len(labels), np.random.default_rng(seed)
    width = features.shape[1]
    if n < 10 or labels.min() == labels.max():
        odds = np.log((labels.sum() + 1) / (n - labels.sum() + 1))
        return Network(np.zeros(width), np.ones(width), [np.zeros((width, 1)), np.zeros(1), np.zeros(1), odds])
    order = draw.permutation(n)
    apart, own = order[: n // 5], order[n // 5 :]
    features = features.astype(np.float64)
    net = Network(features[own].mean(axis=0), features[own].std(axis=0) + 1e-6, [
        draw.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), draw.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(()),
    ])
    x, y = net.inputs(features[own]), labels[own].astype(np.float64)
    first, second, t = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights], 0
    for _ in range(rounds):
        for rows in np.array_split(draw.permutation(len(own)), max(1, len(own) // 128)):
            w, b, v, c = net.weights
            hidden = np.tanh(x[rows] @ w + b)
            error = (1 / (1 + np.exp(-(hidden @ v + c))) - y[rows]) / len(rows)
            back = np.outer(error, v) * (1 - hidden * hidden)
            slopes = [x[rows].T @ back + 1e-4 * w, back.sum(axis=0), hidden.T @ error + 1e-4 * v, error.sum()]
            t += 1
            for k, slope in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope * slope
                net.weights[k] = net.weights[k] - 0.003 * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    logits = net.logits(features[apart])
    tried = np.exp(np.linspace(-1, 3, 81))
    net.temperature = float(min(tried, key=lambda s: (_loss(logits / s, labels[apart]), s)))
    return net


def _held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def _examples(features: DataFrame, labels: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of up to ``most`` labelled documents outside the held-out third, chosen by a hash of their id."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~_held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).filter("quality = other")
    n = known.count()
    if n > most:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * 0.98 * most / n))
    known = known.select("doc_id", "quality").orderBy(F.xxhash64("doc_id")).limit(most)
    found = features.join(F.broadcast(known), "doc_id")  # at most ``most`` rows
    found = found.groupBy("doc_id").agg(F.min("features").alias("features"), F.first("quality").alias("quality"))
    rows = sorted(map(tuple, found.collect()))
    both = np.frombuffer(b"".join(r[1] for r in rows), np.float32).reshape(-1, _N_FEATURES)
    return both, np.array([r[2] for r in rows], np.int64)


def _score(net: Network) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.frombuffer(b"".join(batch.column("features").to_pylist()), np.float32).reshape(-1, _N_FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(net.score(found))], names=["doc_id", "score"])

    return run


def scored(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """A row for each document: doc_id, held_out, score (probability of label 1) and predicted.

    Nothing but the text enters a score. Null, empty and blank texts have no words and
    share one score; a long text counts whole, taken in parts, and a run of more than 1 MiB
    without white space is cut into words of that size. Repeated rows score alike; a null doc_id is not
    held out. Labels that are null, neither 0 nor 1, or contradict each other, teach nothing; with
    labels of one kind or none every score is one number. An empty table gives no rows. Other
    columns are ignored. Runs jobs: one over all texts for the word vectors, one for the
    documents' features, written to the scratch folder, and one for the examples.
    """
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(word_vectors(docs))  # BUCKETS x DIM floats
    features = kept(only_text(docs).mapInArrow(_pool(table), "doc_id bigint, features binary"), "features")
    net = fit(*_examples(features, labels, most))
    found = features.mapInArrow(_score(net), "doc_id bigint, score double")
    return found.select("doc_id", _held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
