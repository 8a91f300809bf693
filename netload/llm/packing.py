"""Harmonic packing: documents as token sequences of a fixed capacity with little padding.

A piece of length l belongs to class k = capacity // l and takes one of the k equal
slots of a bin of that class, whatever else comes: a bin holds exactly k pieces, so
bins fill independently of each other and of other workers, without a search.

A document gives whole sequences first. Of the rest, a piece that would waste more
than ``1 / TOLERANCE`` of its slot is cut to the next smaller slot, capacity // (k + 1),
and what is left goes on the same way; each cut leaves less than 1 / k of the rest.
Bins still open when a worker ends (less than one for each class) are laid end to
end and cut at the capacity, so a worker pads one sequence beside its slots.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netload.llm.schema import documents, only_text
from netload.llm.vocab import WordIds, ids_by, slices_of

#: A piece fills at least 1 - 1 / TOLERANCE of its slot.
TOLERANCE = 48

_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
_SCHEMA = pa.schema([(c.split()[0], pa.int64()) for c in _PIECES.split(", ")])
_SCHEMA_IDS = _SCHEMA.append(pa.field("ids", pa.binary()))


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids."""
    out, rest = [capacity] * (n // capacity), n % capacity
    while rest:
        k = capacity // rest
        piece = rest
        if (capacity - k * rest) * TOLERANCE > capacity:
            piece = min(rest, capacity // (k + 1))
        out.append(piece)
        rest -= piece
    return out


class _Bins:
    """The open bins of one worker; ``done`` gets rows as their sequences close."""

    def __init__(self, first: int, capacity: int, with_ids: bool):
        self.next, self.capacity, self.with_ids = first, capacity, with_ids
        self.open: dict[int, list[tuple]] = {}
        self.done: list[tuple] = []

    def add(self, doc_id, start: int, ids: np.ndarray, doc_tokens: int) -> None:
        k = self.capacity // len(ids)
        bin_ = self.open.setdefault(k, [])
        bin_.append((doc_id, start, ids, doc_tokens))
        if len(bin_) == k:
            self._close(self.open.pop(k))

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            raw = ids.tobytes()
            row = (doc_id, start, len(ids), zlib.crc32(raw), doc_tokens, self.next, offset)
            self.done.append((*row, raw) if self.with_ids else row)
            offset += len(ids)
        self.next += 1

    def finish(self) -> None:
        left, room = [], self.capacity
        for k in sorted(self.open):
            for doc_id, start, ids, doc_tokens in self.open[k]:
                while len(ids):
                    part, ids = ids[:room], ids[room:]
                    left.append((doc_id, start, part, doc_tokens))
                    start, room = start + len(part), room - len(part)
                    if not room:
                        self._close(left)
                        left, room = [], self.capacity
        if left:
            self._close(left)
        self.open = {}

    def rows(self) -> pa.RecordBatch:
        schema = _SCHEMA_IDS if self.with_ids else _SCHEMA
        columns = list(zip(*self.done)) or [[]] * len(schema)
        self.done = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _pack(vocabulary: str, end_id: int, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = _Bins(TaskContext.get().partitionId() << 40, capacity, with_ids)
        known = ids_by(WordIds, vocabulary)
        for batch in batches:
            for part in slices_of(batch, "text"):
                ids, counts = known.of(part.column("text"))
                ends = np.cumsum(counts)
                for doc_id, n, end in zip(part.column("doc_id").to_pylist(), counts.tolist(), ends.tolist()):
                    own, start = np.append(ids[end - n : end], np.uint32(end_id)), 0
                    for length in cut_lengths(n + 1, capacity):
                        bins.add(doc_id, start, own[start : start + length], n + 1)
                        start += length
                yield bins.rows()
        bins.finish()
        yield bins.rows()

    return run


def packed(docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, if asked for, ``ids``.

    ``ids`` holds little-endian unsigned 32-bit ids. Packs within the tasks that read
    ``docs``: no shuffle; a task holds one slice of texts and its open bins. Sequence
    numbers name the task, so they are unique and come out the same when it runs again. Null,
    empty and blank texts have the end id alone. Repeated rows are packed like others;
    a null doc_id stays null. An empty table gives no rows. Other columns are ignored.
    """
    schema = _PIECES + ", ids binary" if with_ids else _PIECES
    return only_text(docs).mapInArrow(_pack(vocabulary, end_id, capacity, with_ids), schema)


def sequences(docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = 2048) -> DataFrame:
    """``sequence_id, doc_ids, lengths, ids``: what a trainer reads; ids without padding, at most ``capacity`` of them."""
    rows = packed(docs, vocabulary, end_id, capacity, True).groupBy("sequence_id")
    rows = rows.agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids"))).alias("p"))
    joined = F.aggregate("p", F.lit(b""), lambda all_, p: F.concat(all_, p["ids"]))
    return rows.select("sequence_id", F.col("p.doc_id").alias("doc_ids"), F.col("p.length").alias("lengths"), joined.alias("ids"))


def op10_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
