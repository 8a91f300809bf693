"""Token ids on disk as bit planes: fixed-size blocks, transposed, each plane compressed with zstandard.

Layout, two Parquet tables written and read by Spark alone:

``<path>/chunks`` has a row for each block of ``BLOCK`` ids: part, chunk (its number in the
part), n_ids, the compressed planes as one binary, ``plane_bytes`` (the chunk index:
the length of each plane there; 0 for a plane of zeros), and the documents that
overlap the block: doc_ids, their starts in the part and lengths.
``<path>/parts`` says how many ids each part has and how many stand before it.

Parts follow each other in the order of doc_id, blocks within a part likewise, so
the ids of all documents form one sequence. A block is read by itself: a reader
needs neither the one before it nor a whole file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from netload.llm.schema import documents, only_text
from netload.llm.vocab import ByteIds, ids_by, slices_of
from netload.scratch import fresh_path

#: Ids in a block; a multiple of 8.
BLOCK = 1 << 16
LEVEL = 3

_CHUNKS = (
    "part int, chunk bigint, n_ids int, planes binary, plane_bytes array<int>, "
    "doc_ids array<bigint>, starts array<bigint>, lengths array<bigint>"
)
_CHUNK_SCHEMA = pa.schema([
    ("part", pa.int32()), ("chunk", pa.int64()), ("n_ids", pa.int32()), ("planes", pa.binary()),
    ("plane_bytes", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())),
    ("lengths", pa.list_(pa.int64())),
])
_PIECES = "part int, doc_id bigint, start bigint, n_tokens bigint, at bigint, ids binary"
_PIECE_SCHEMA = pa.schema([
    ("part", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("at", pa.int64()),
    ("ids", pa.binary()),
])


def to_planes(ids: np.ndarray, bits: int) -> list[bytes]:
    """The planes of unsigned 32-bit ids, lowest first: 32 of one bit each, or 4 of eight bits."""
    rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits == 8:
        return [np.ascontiguousarray(rows[:, j]).tobytes() for j in range(4)]
    return [np.packbits((rows[:, j // 8] >> (j % 8)) & 1).tobytes() for j in range(32)]


def from_planes(planes: list[bytes], n: int, bits: int) -> np.ndarray:
    rows = np.zeros((n, 4), np.uint8)
    for j, plane in enumerate(planes):
        if plane and bits == 8:
            rows[:, j] = np.frombuffer(plane, np.uint8)
        elif plane:
            rows[:, j // 8] |= np.unpackbits(np.frombuffer(plane, np.uint8), count=n) << (j % 8)
    return rows.reshape(-1).view("<u4")


def _compressed(ids: np.ndarray, bits: int) -> tuple[bytes, list[int]]:
    press = zstandard.ZstdCompressor(level=LEVEL)
    out = [press.compress(p) if any(p) else b"" for p in to_planes(ids, bits)]
    return b"".join(out), [len(p) for p in out]


def _restored(planes: bytes, plane_bytes: list[int], n: int) -> np.ndarray:
    bits = 32 // len(plane_bytes)
    unpress, at, out = zstandard.ZstdDecompressor(), 0, []
    for size in plane_bytes:
        out.append(unpress.decompress(planes[at : at + size]) if size else b"")
        at += size
    return from_planes(out, n, bits)


class _Part:
    """Ids of one part that don't fill a block yet, and the documents they belong to."""

    def __init__(self, part: int, bits: int):
        self.part, self.bits, self.chunk, self.total = part, bits, 0, 0
        self.left = np.zeros(0, np.uint32)
        self.docs: list[tuple] = []

    def add(self, doc_ids: list, lengths: list[int], ids: np.ndarray) -> None:
        for doc_id, n in zip(doc_ids, lengths):
            self.docs.append((doc_id, self.total, n))
            self.total += n
        self.left = np.concatenate([self.left, ids]) if len(self.left) else ids

    def rows(self, whole: bool = False) -> Iterator[pa.RecordBatch]:
        """The blocks that are full; all that is left, if ``whole``."""
        at, done = 0, 0
        while len(self.left) - at >= (1 if whole else BLOCK):
            ids = self.left[at : at + BLOCK]
            first = self.chunk * BLOCK
            while sum(self.docs[done][1:]) <= first:
                done += 1
            last = done
            while last < len(self.docs) and self.docs[last][1] < first + len(ids):
                last += 1
            planes, sizes = _compressed(ids, self.bits)
            doc_ids, starts, lengths = zip(*self.docs[done:last])
            row = (self.part, self.chunk, len(ids), planes, sizes, doc_ids, starts, lengths)
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _CHUNK_SCHEMA)], schema=_CHUNK_SCHEMA)
            self.chunk, at, done = self.chunk + 1, at + len(ids), last - 1
        self.left, self.docs = self.left[at:], self.docs[done:]


def _encode(vocabulary: str, end_id: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part = ids_by(ByteIds, vocabulary), _Part(TaskContext.get().partitionId(), bits)
        for batch in batches:
            for rows in slices_of(batch, "text"):
                ids, counts = known.of(rows.column("text"))
                ids = np.insert(ids, np.cumsum(counts), np.uint32(end_id))
                part.add(rows.column("doc_id").to_pylist(), (counts + 1).tolist(), ids)
                yield from part.rows()
        yield from part.rows(whole=True)

    return run


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0, bits: int = 8) -> None:
    """Writes the ids of all texts under ``path`` in ascending order of doc_id, each document closed by ``end_id``.

    ``bits`` is 1 for bit planes or 8 for byte planes. Null, empty and blank texts
    have whatever ids the vocabulary gives them and the end id. A null doc_id stands
    first. Rows with one doc_id stand together, in the order of a hash of their text.
    An empty table gives empty files. A long text lies in many blocks. Other columns are ignored. The texts are
    shuffled once, into ranges of doc_id.
    """
    if bits not in (1, 8):
        raise ValueError("bits must be 1 or 8")
    order = ["doc_id", F.xxhash64("text")]
    rows = only_text(docs).repartitionByRange(*order).sortWithinPartitions(*order)
    rows.mapInArrow(_encode(vocabulary, end_id, bits), _CHUNKS).write.parquet(f"{path}/chunks")
    spark = docs.sparkSession
    sizes = spark.read.schema(_CHUNKS).parquet(f"{path}/chunks").groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    before = F.sum("n_ids").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))  # a row for each part
    sizes.select("part", "n_ids", F.coalesce(before, F.lit(0)).alias("before")).write.parquet(f"{path}/parts")


def _decode(whole: bool):
    """The documents that lie in one block, or the pieces of those that don't."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                first = row["chunk"] * BLOCK
                until, found, ids = first + row["n_ids"], [], None
                for doc_id, start, n in zip(row["doc_ids"], row["starts"], row["lengths"]):
                    if (first <= start and start + n <= until) == whole:
                        ids = _restored(row["planes"], row["plane_bytes"], row["n_ids"]) if ids is None else ids
                        low, high = max(start, first), min(start + n, until)
                        found.append((row["part"], doc_id, start, n, low - start, ids[low - first : high - first].tobytes()))
                if found:
                    columns = zip(*found)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECE_SCHEMA)], schema=_PIECE_SCHEMA)

    return run


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids``: start counts the ids of all documents before; ids are little-endian, 32 bits each."""
    chunks = spark.read.schema(_CHUNKS).parquet(f"{path}/chunks")
    columns = ["part", "doc_id", "start", "n_tokens", "ids"]
    alone = chunks.mapInArrow(_decode(True), _PIECES).select(columns)
    pieces = chunks.mapInArrow(_decode(False), _PIECES).groupBy("part", "doc_id", "start", "n_tokens")
    pieces = pieces.agg(F.sort_array(F.collect_list(F.struct("at", "ids"))).alias("p"))
    joined = F.unhex(F.array_join(F.transform("p", lambda p: F.hex(p["ids"])), "")).alias("ids")
    rows = alone.union(pieces.select(*columns[:-1], joined))
    rows = rows.join(spark.read.parquet(f"{path}/parts").select("part", "before"), "part")
    return rows.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids")


def op9_bit_plane_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = fresh_path(spark, "ids")
    write_ids(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
