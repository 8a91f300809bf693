"""Byte-level BPE from a table of ranks: encoding and decoding of whole text columns.

A text is cut into pieces by the vocabulary's pattern, and each distinct piece is
folded once: from its single bytes, the adjacent two of the lowest rank, the
leftmost of equal ones, are merged until no two have a rank.

The pieces of the most frequent words of the corpus (``FREQUENT``) are folded by Spark's higher-order
functions over arrays of binaries, with the ranks as a literal; their ids go to every
task. That way costs some hundred microseconds a piece, so each task folds the other
pieces that it meets, once each, by the same merges over arrays of a whole slice.
Decoding concatenates the binaries of the ids.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netload.llm.schema import documents, only_text
from netload.llm.vocab import BYTE_LEVEL, ByteIds, gathered, slices_of

#: Words whose pieces are folded ahead, some 200 bytes each in every task.
FREQUENT = 1 << 16
#: Pieces of more bytes are folded one by one with a heap.
LONG = 64
_BUCKETS = 1 << 14
_NONE = np.iinfo(np.int64).max


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a piece in base 64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Merges:
    """Folds pieces by ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        pairs = {}
        for name, rank in ranks.items():
            for i in range(1, len(name)):
                a, b = ranks.get(name[:i]), ranks.get(name[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self._pairs = np.array(sorted(pairs), np.int64)
        self._ranks = np.array([pairs[k] for k in self._pairs.tolist()], np.int64)
        self._single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self._pairs, keys), len(self._pairs) - 1)
        return np.where(self._pairs[at] == keys, self._ranks[at], _NONE)

    def _one(self, piece: bytes) -> list[int]:
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts) and (rank := self.ranks.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (rank, i, len(parts[i]), len(parts[j])))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, m, n = heapq.heappop(heap)
            if parts[i] is None or len(parts[i]) != m:
                continue
            j = after[i]
            if j >= len(parts) or len(parts[j]) != n:
                continue
            parts[i], parts[j], after[i] = parts[i] + parts[j], None, after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [self.ranks[p] for p in parts if p is not None]

    def fold(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in order, and how many each piece has."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        long = np.flatnonzero(sizes > LONG).tolist()
        ids = self._single[np.frombuffer(b"".join(pieces[i] for i in np.flatnonzero(sizes <= LONG).tolist()), np.uint8)]
        word = np.repeat(np.arange(len(pieces)), np.where(sizes <= LONG, sizes, 0))
        done = [(np.full(len(own), i), own) for i in long for own in [np.array(self._one(pieces[i]), np.int64)]]
        while len(ids):
            rank = np.full(len(ids), _NONE)
            same = np.flatnonzero(word[1:] == word[:-1])
            rank[same] = self._rank(ids[same], ids[same + 1])
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.minimum.reduceat(rank, first)
            run = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(ids))))
            over = least[run] == _NONE
            done.append((word[over], ids[over]))
            at = np.flatnonzero((rank == least[run]) & ~over)
            at = at[np.append(True, run[at][1:] != run[at][:-1])] if len(at) else at  # the leftmost of each
            ids[at] = rank[at]
            keep = ~over
            keep[at + 1] = False
            ids, word = ids[keep], word[keep]
        words = np.concatenate([w for w, _ in done] or [word])
        found = np.concatenate([i for _, i in done] or [ids]).astype(np.uint32)
        return found[np.argsort(words, kind="stable")], np.bincount(words, minlength=len(pieces))


class RankIds(ByteIds):
    """Ids by a rank file; ``given`` pieces are folded ahead."""

    def __init__(self, path: str, pattern: str):
        self._merges, self._cut = Merges(load_ranks(path)), regex.compile(pattern)
        self._given: dict[bytes, list[int]] = {}
        self._forget()

    def given(self, pieces: dict[bytes, list[int]]) -> RankIds:
        self._given = pieces
        return self

    def _folded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the pieces of all texts, how many each piece has, and the pieces' lengths in bytes."""
        pieces = [p.encode() for text in texts for p in self._cut.findall(text)]
        ahead = list(map(self._given.get, pieces))
        rest = [p for p, ids in zip(pieces, ahead) if ids is None]
        found, counts = self._merges.fold(rest)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        if len(rest) == len(pieces):
            return found, counts, sizes
        n = np.array([-1 if ids is None else len(ids) for ids in ahead], np.int64)
        new = n < 0
        n[new] = counts
        ids = np.empty(n.sum(), np.uint32)
        mine = np.repeat(new, n)
        ids[mine] = found
        ids[~mine] = [i for own in ahead if own is not None for i in own]
        return ids, n, sizes

    def _joined(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = ends - starts
        ids, counts, sizes = self._folded([gathered(data, starts, lengths).tobytes().decode()])
        part = np.searchsorted(np.cumsum(lengths), np.cumsum(sizes), "left")
        return ids, np.bincount(part, counts, len(starts)).astype(np.int64)

    def _by_itself(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = [data[a:b].tobytes().decode() for a, b in zip(starts.tolist(), ends.tolist())]
        ids, counts, sizes = self._folded(texts)
        part = np.searchsorted(np.cumsum(ends - starts), np.cumsum(sizes), "left")
        return ids, np.bincount(part, counts, len(starts)).astype(np.int64)

    def _alone(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self._open(data, starts, ends)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def folded(pieces: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``piece, ids``: each binary ``piece`` of the rows folded by higher-order functions; the ranks are a literal."""
    buckets: list[dict[str, int]] = [{} for _ in range(_BUCKETS)]
    for name, rank in ranks.items():
        buckets[zlib.crc32(name) % _BUCKETS][name.hex().upper()] = rank
    table = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")

    def rank_of(name: Column) -> Column:
        return F.try_element_at(F.get(table, (F.crc32(name) % _BUCKETS).cast("int")), F.hex(name))

    def joined(parts: Column, at: Column) -> Column:
        both = F.array(F.concat(F.get(parts, at - 1), F.get(parts, at)))
        return F.concat(F.slice(parts, F.lit(1), at - 1), both, F.slice(parts, at + 2, F.size(parts)))

    def merged(parts: Column, ranked: Column) -> Column:
        least = F.array_min(ranked)
        return F.when(least.isNull(), parts).otherwise(
            _let(F.array_position(ranked, least).cast("int"), lambda at: joined(parts, at))
        )

    def step(parts: Column, _: Column) -> Column:
        pairs = F.sequence(F.lit(0), F.size(parts) - 2)
        ranked = F.transform(pairs, lambda i: rank_of(F.concat(F.get(parts, i), F.get(parts, i + 1))))
        return F.when(F.size(parts) < 2, parts).otherwise(_let(ranked, lambda r: merged(parts, r)))

    single = F.transform(F.sequence(F.lit(1), F.octet_length("piece")), lambda i: F.substr(F.col("piece"), i, F.lit(1)))
    steps = F.sequence(F.lit(1), F.octet_length("piece"))
    parts = F.aggregate(steps, single, step)
    return pieces.select("piece", F.transform(parts, rank_of).alias("ids"))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each string between two blanks stands in a slice of texts, if more than once."""
    for batch in batches:
        for part in slices_of(batch, "text"):
            counts = pc.value_counts(pc.split_pattern(part.column("text"), " ").flatten())
            often = counts.filter(pc.greater(counts.field("counts"), 1))
            yield pa.RecordBatch.from_arrays([often.field("values"), often.field("counts")], names=["word", "n"])


def folded_ahead(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> dict[bytes, list[int]]:
    """Ids of the pieces of the most frequent words, from counts over all texts; words number at most ``FREQUENT``.

    Counts are about right, as words that a slice holds once don't count; that
    changes which pieces are folded ahead, never an id.
    """
    counts = only_text(docs).select("text").mapInArrow(_counted, "word string, n bigint")
    counts = counts.filter(F.octet_length("word") < LONG).groupBy("word").agg(F.sum("n").alias("n"))
    often = [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()]
    cut, spark = regex.compile(pattern), docs.sparkSession
    pieces = sorted({p for word in often for p in cut.findall(" " + word)})
    frame = spark.createDataFrame([(bytearray(p.encode()),) for p in pieces], "piece BINARY")
    rows = folded(frame.repartition(spark.sparkContext.defaultParallelism), ranks).collect()
    return {bytes(r["piece"]): r["ids"] for r in rows}


@lru_cache(maxsize=1)
def _known(path: str, pattern: str) -> RankIds:
    return RankIds(path, pattern)


def _encode(path: str, pattern: str, given: dict[bytes, list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(path, pattern).given(given)
        for batch in batches:
            for part in slices_of(batch, "text"):
                found, counts = known.of(part.column("text"))
                cuts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(found.view(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], names=["doc_id", "ids"])

    return run


def encoded(docs: DataFrame, path: str, pattern: str = BYTE_LEVEL) -> DataFrame:
    """``doc_id, ids``: the token ids of each text by the rank file, without special tokens.

    Null and empty texts have no ids. Repeated rows and null doc_ids come back as they
    are. An empty table gives no rows. A text of any length is encoded in parts of 1 MiB or one longer part. Other columns are ignored. Runs jobs that count
    pieces and fold the frequent ones.
    """
    given = folded_ahead(docs, load_ranks(path), pattern)
    return only_text(docs).mapInArrow(_encode(path, pattern, given), "doc_id bigint, ids array<int>")


class Names:
    """The bytes of each id of a rank file, and its decimal digits, joined for lookups of many ids at once."""

    def __init__(self, path: str):
        names = {rank: name for name, rank in load_ranks(path).items()}
        self._table([names.get(i, b"") for i in range(max(names) + 1)])

    def _table(self, names: list[bytes]) -> None:
        digits = [b"%d," % i for i in range(len(names))]
        self._bytes, self._digits = (self._laid(x) for x in (names, digits))

    @staticmethod
    def _laid(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, values), np.int64, len(values))
        return np.frombuffer(b"".join(values), np.uint8), np.cumsum(lengths) - lengths, lengths

    @staticmethod
    def _of(table: tuple, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data, starts, lengths = table
        found, before = gathered(data, starts[ids], lengths[ids]), np.concatenate([[0], np.cumsum(lengths[ids])])
        return found, before[np.concatenate([[0], np.cumsum(counts)])]

    def decoded(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each run of ids."""
        found, cuts = self._of(self._bytes, ids, counts)
        raw, cuts = found.tobytes(), cuts.tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def decimals(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Each run of ids as decimal numbers joined by commas."""
        found, cuts = self._of(self._digits, ids, counts)
        raw, cuts = found.tobytes(), cuts.tolist()
        return [raw[a : max(a, b - 1)] for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def _names(path: str) -> Names:
    return Names(path)


def _runs(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return lists.flatten().to_numpy().astype(np.int64), lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)


def decoded(ids: Column, path: str) -> Column:
    """The bytes of an array of ids; they are UTF-8 if the ids are those of a text. Null for null."""

    @F.arrow_udf("binary")
    def bytes_of(lists: pa.Array) -> pa.Array:
        return pa.array(_names(path).decoded(*_runs(lists)), pa.binary(), mask=lists.is_null().to_numpy(zero_copy_only=False))

    return bytes_of(ids)


def _digests(path: str, pattern: str, given: dict[bytes, list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, names = _known(path, pattern).given(given), _names(path)
        for batch in batches:
            for part in slices_of(batch, "text"):
                ids, counts = known.of(part.column("text"))
                ids = ids.astype(np.int64)
                hexes = [[hashlib.sha256(x).hexdigest() for x in of(ids, counts)] for of in (names.decimals, names.decoded)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts), *map(pa.array, hexes)], names=_DIGESTS)

    return run


_DIGESTS = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def digests(docs: DataFrame, path: str, pattern: str = BYTE_LEVEL) -> DataFrame:
    """A row for each text: its number of ids, and the SHA-256 of the decimal ids joined by commas and of the bytes decoded from the ids.

    What ``encoded`` and ``decoded`` give, in one pass that sends no ids to the JVM.
    """
    given = folded_ahead(docs, load_ranks(path), pattern)
    kinds = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return only_text(docs).mapInArrow(_digests(path, pattern, given), kinds)


def op7_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
