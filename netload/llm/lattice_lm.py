"""LM scoring by a subword lattice: a text's probability summed over all its segmentations.

The pieces are those of an existing unigram vocabulary and all single bytes, so every
word has a segmentation. Their probabilities start from the vocabulary's own scores and
are fitted to the training texts by expectation-maximisation, as all segmentations of
a word weigh in: a forward recursion in log space gives the probability of the word,
a backward one the expected count of each piece. A text is its words, each with the
blank before it, and one end; the word's log probabilities add up.

What is learnt covers all training texts. Each map task counts its distinct words once, words
are counted in Spark, and a round of fitting reads that table and brings one number for
each piece to the driver. For the base score the most frequent words (``FREQUENT_MAX``)
are looked up where texts are read, and only the others meet the counts in a join.
Words are equal if 64 bits of their hash are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netload.llm.schema import documents, kept, only_text
from netload.llm.wordhash import byte_codes, range_hashes, slices, words

#: Words whose counts go to every task, 16 bytes each.
FREQUENT_MAX = 1 << 18
ROUNDS = 2
#: Weight, in pieces, of the vocabulary's own scores against the expected counts.
PRIOR = 100_000.0
#: Bytes of words that are segmented at a time, unless one word is longer, and of texts read at a time.
_BYTES = 1 << 18
_SLICE = 4 << 20
#: Distinct words a counting task holds.
_FLUSH = 1 << 20

_U = np.uint64


class Pieces:
    """Byte strings and their log probabilities (natural); a leading blank starts a word."""

    def __init__(self, names: list[bytes], logs: np.ndarray):
        self.names, self.logs = names, logs

    @cached_property
    def _index(self) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b"".join(self.names), np.uint8)
        ends = np.cumsum([len(p) for p in self.names])
        codes = range_hashes(byte_codes(data), ends - np.array([len(p) for p in self.names]), ends)
        order = np.argsort(codes)
        return codes[order], order

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.names))

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Which piece each hash is, or -1."""
        known, order = self._index
        at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        return np.where(known[at] == codes, order[at], -1)

    def __getstate__(self):
        return self.names, self.logs

    def __setstate__(self, state):
        self.names, self.logs = state


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Pieces:
    """Pieces of a sentencepiece file without upper case, weighted by 1 / rank as its scores give it."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rank = {bytes([b]): float(model.get_piece_size()) for b in range(256)}
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
            name = model.id_to_piece(i).replace("▁", " ").encode()
            if b" " not in name[1:] and name == name.lower():
                rank[name] = min(rank.get(name, np.inf), -model.get_score(i))
    names = sorted(rank)
    weights = np.array([1 / (rank[n] + 10) for n in names])
    return Pieces(names, np.log(weights / weights.sum()))


class _Lattice:
    """All segmentations of some words, longest first; ``data`` holds the words, a blank before each, end to end."""

    def __init__(self, pieces: Pieces, data: np.ndarray, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        self.base = (np.cumsum(lengths + 1) - lengths - 1)[self.order]  # a word of n bytes has n + 1 nodes
        ends = np.cumsum(lengths)
        word = np.repeat(np.arange(len(lengths)), lengths)
        left = ends[word] - np.arange(len(data))
        codes, span = byte_codes(data), min(pieces.longest, int(lengths.max()))
        self.ids = np.full((len(data) + len(lengths), span), -1, np.int32)  # by the node where a piece ends, and its length
        for n in range(1, span + 1):
            at = np.flatnonzero(left >= n)
            self.ids[at + word[at] + n, n - 1] = pieces.find(range_hashes(codes, at, at + n))
        self.logs = np.append(pieces.logs, -np.inf)

    def _steps(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each place in the words: the nodes there, and the nodes a piece could come from."""
        for p in range(1, int(self.lengths[0]) + 1):
            here = self.base[: np.searchsorted(-self.lengths, -p, "right")] + p
            yield here, here[:, None] - np.arange(1, min(p, self.ids.shape[1]) + 1)

    def forward(self) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of reaching each node, and of each word."""
        alpha = np.zeros(len(self.ids))
        for here, before in self._steps():
            ways = alpha[before] + self.logs[self.ids[here, : before.shape[1]]]
            most = ways.max(1)
            alpha[here] = most + np.log(np.exp(ways - most[:, None]).sum(1))
        out = np.empty(len(self.order))
        out[self.order] = alpha[self.base + self.lengths]
        return alpha, out

    def expected(self, times: np.ndarray) -> np.ndarray:
        """Expected count of each piece, if the words occur ``times``."""
        alpha, total = self.forward()
        out, weight = np.zeros(len(self.logs)), np.zeros(len(self.ids))
        weight[self.base + self.lengths] = times[self.order]
        for here, before in reversed(list(self._steps())):
            ids = self.ids[here, : before.shape[1]]
            share = weight[here][:, None] * np.exp(alpha[before] + self.logs[ids] - alpha[here][:, None])
            out += np.bincount(ids.ravel() + 1, share.ravel(), len(out))[np.r_[1 : len(out), 0]]
            np.add.at(weight, before, share)
        return out[:-1]


def _spelt(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words at these places, a blank before each, end to end; and their lengths with it."""
    lengths = ends - starts + 1
    first = np.cumsum(lengths) - lengths
    at = np.repeat(starts - 1 - first, lengths) + np.arange(lengths.sum())
    out = data[np.maximum(at, 0)]
    out[first] = 32
    return out, lengths


def _lattices(pieces: Pieces, data: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[slice, _Lattice]]:
    ends, at = np.cumsum(lengths), 0
    while at < len(lengths):
        begin = ends[at] - lengths[at]
        stop = max(at + 1, int(np.searchsorted(ends, begin + _BYTES, "right")))
        yield slice(at, stop), _Lattice(pieces, data[begin : ends[stop - 1]], lengths[at:stop])
        at = stop


def word_logs(pieces: Pieces, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Log probability (natural) of each word, summed over its segmentations."""
    out = np.zeros(len(lengths))
    for part, lattice in _lattices(pieces, data, lengths):
        out[part] = lattice.forward()[1]
    return out


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.unique(codes, return_index=True, return_inverse=True)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of the texts, with their count in training texts; the end counts as the empty word."""
    held: dict[bytes, int] = {}
    texts = 0

    def out() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held.clear()
        return rows

    for batch in batches:
        texts += batch.column("learnt").true_count
        for part in slices(batch, "text", _SLICE):
            found = words(part.column("text"), lower=True)
            codes, first, which = _distinct(found.hashes())
            learnt = np.repeat(part.column("learnt").to_numpy(zero_copy_only=False), found.counts)
            raw, times = found.data.tobytes(), np.bincount(which[learnt], minlength=len(codes))
            for s, e, n in zip(found.starts[first].tolist(), found.ends[first].tolist(), times.tolist()):
                word = raw[s:e]
                held[word] = held.get(word, 0) + n
            if len(held) > _FLUSH:
                yield out()
    if texts:
        held[b""] = texts
    yield out()


def _expect(pieces: Pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(pieces.names))
        for batch in batches:
            column = batch.column("word")
            lengths = np.array([len(w) for w in column.to_pylist()], np.int64)
            data, own = _spelt(np.frombuffer(b"".join(column.to_pylist()) or b" ", np.uint8), np.cumsum(lengths) - lengths, np.cumsum(lengths))
            times = batch.column("n").to_numpy().astype(float)
            for part, lattice in _lattices(pieces, data, own):
                total += lattice.expected(times[part])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["piece", "expected"])

    return run


def fitted(counts: DataFrame, path: str, rounds: int = ROUNDS) -> tuple[Pieces, float]:
    """Pieces with fitted probabilities, and the log probability (natural) of the end; ``counts`` has word and n, the empty word being the end."""
    start = vocabulary(path)
    ends = (counts.filter("word = X''").agg(F.sum("n")).first()[0] or 0) + 1.0
    prior = np.exp(start.logs)
    pieces, rest = start, 0.0
    for _ in range(rounds):
        rows = counts.filter("word <> X''").select("word", "n").mapInArrow(_expect(pieces), "piece bigint, expected double")
        found = np.zeros(len(prior))
        for row in rows.groupBy("piece").agg(F.sum("expected").alias("expected")).collect():  # one row for each piece at most
            found[row["piece"]] = row["expected"]
        weights = found + PRIOR * prior
        rest = weights.sum() + ends
        pieces = Pieces(start.names, np.log(weights / rest))
    rest = rest or PRIOR + ends
    return pieces, float(np.log(ends / rest))


def _score(end_log: float, known: np.ndarray, times: np.ndarray, known_logs: np.ndarray):
    """Rows of ``score``: known, times and known_logs are the sorted hashes of the frequent words, their counts and log probabilities."""
    bases = np.log10(times + 1.0)

    def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[first[1:]] - total[first[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                found = words(part.column("text"), lower=True)
                codes = found.hashes()
                at = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
                is_known = known[at] == codes if len(known) else np.zeros(len(codes), bool)
                at, in_training = (at, times[at] > 0) if len(known) else (np.zeros(len(codes), np.int64), is_known)
                base = np.where(is_known, bases[at], 0.0) if len(known) else np.zeros(len(codes))
                log = np.where(is_known, known_logs[at], 0.0) if len(known) else np.zeros(len(codes))
                rare = np.flatnonzero(~is_known)
                cuts = np.searchsorted(rare, found.first).astype(np.int32)
                others = pa.ListArray.from_arrays(pa.array(cuts), pa.array(codes[rare].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(part.num_rows)), part.column("doc_id"), pa.array(found.counts.astype(np.int64) + 1),
                     pa.array(sums((is_known & in_training).astype(np.int64), found.first)), pa.array(sums(base, found.first)),
                     pa.array(sums(log, found.first) + end_log / np.log(10)), others],
                    names=["row", "doc_id", "n_tokens", "n_known", "base", "score", "rare"])
                row += part.num_rows

    return run


_SCORED = "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, base double, score double, rare array<bigint>"


def _worded(pieces: Pieces):
    """The hash of each counted word, as the texts' words have it, its count, and its log probability to base 10."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("word").to_pylist()
            lengths = np.array([len(w) for w in raw], np.int64)
            ends = np.cumsum(lengths)
            data = np.frombuffer(b"".join(raw) or b" ", np.uint8)
            codes = range_hashes(byte_codes(data), ends - lengths, ends)
            logs = word_logs(pieces, *_spelt(data, ends - lengths, ends)) / np.log(10)
            yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), batch.column("n"), pa.array(logs)], names=["code", "n", "log"])

    return run


def scored(docs: DataFrame, held_out: Column, path: str) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``: one row per document, logarithms to base 10.

    ``held_out`` is a condition on doc_id; the model and the counts learn from all
    other documents. Null, empty and blank texts have the end alone. Repeated rows are
    learnt and scored each; a null doc_id goes with the training texts unless ``held_out``
    is true for it. Without training texts the vocabulary's own scores remain. An empty
    table gives no rows. A text of any length counts whole; one unbroken word of n bytes takes some
    100 n bytes in a task. Other columns are ignored. Runs jobs that count, fit and score; counts and
    scores are written to the scratch folder.
    """
    plain = only_text(docs)
    out = F.coalesce(held_out, F.lit(False))
    counts = plain.select("text", (~out).alias("learnt")).mapInArrow(_count, "word binary, n bigint")
    counts = kept(counts.groupBy("word").agg(F.sum("n").alias("n")), "words")  # n is 0 for words of held-out texts alone
    learnt = counts.filter("n > 0")
    total, distinct = learnt.agg(F.sum("n"), F.count("*")).first()
    total, end_count = total or 0, learnt.filter("word = X''").agg(F.sum("n")).first()[0] or 0
    pieces, end_log = fitted(learnt, path)

    by_code = counts.filter("word <> X''").mapInArrow(_worded(pieces), "code bigint, n bigint, log double")
    by_code = kept(by_code, "scored-words")  # each distinct word is segmented once
    often = by_code.orderBy(F.desc("n"), "code").limit(FREQUENT_MAX).toArrow()
    order = np.argsort(often.column("code").to_numpy().view(np.uint64))
    known, times, logs = (often.column(c).to_numpy()[order] for c in ("code", "n", "log"))
    rows = kept(plain.mapInArrow(_score(end_log, known.view(np.uint64), times, logs), _SCORED), "scores")
    rare = rows.select("row", F.explode("rare").alias("code")).join(by_code, "code")
    rare = rare.groupBy("row").agg(
        F.count_if(F.col("n") > 0).alias("more"), F.sum(F.log10(F.col("n") + 1)).alias("more_base"), F.sum("log").alias("more_score")
    )
    base = F.col("base") + F.coalesce("more_base", F.lit(0.0)) + float(np.log10(end_count + 1))
    base = base - F.col("n_tokens") * float(np.log10(total + distinct + 1))
    ends = int(end_count > 0)
    return rows.join(rare, "row", "left").select(
        "doc_id", out.alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0)) + ends).cast("bigint").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"), base.alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


def op2_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return scored(documents(spark, sf_dir), held_out, public_tokenizers.path("piece_bpe_32k.model"))
