"""Substring dedup: removes every word that lies in a window repeated anywhere.

Every window of ``size`` words gets a Rabin-Karp hash; a window whose hash
occurs more than once, in any document or twice in one, is repeated, and the
words under repeated windows go. Windows are judged on the input.

What is shuffled is small: a window is filed under the smallest hash of the
word groups (``anchor`` words) inside it, which equal windows share, and
neighbouring windows share too. So one row carries a run of windows, and a run
whose group occurs nowhere else is dropped before its windows are counted.
Repeats within one text are settled where the text is read, which leaves at most
one row per text for any window, however often a line is repeated.
Equality is that of 112 hash bits (64 of the group, 48 of the window).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from netload.llm.schema import documents, kept
from netload.llm.wordhash import gram_starts, range_hashes, slices, words

_BYTES = 6
_RUNS = "row_id bigint, row_hash bigint, anchor bigint, start int, codes binary, mask bigint"
_U = np.uint64


def _smallest(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each position the smallest of the next ``width`` values, and where it first stands."""
    best, at, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        n = len(best) - step
        right = best[step:] < best[:n]
        best, at = np.where(right, best[step:], best[:n]), np.where(right, at[step:], at[:n])
        have += step
    return best, at


def _runs(size: int, anchor: int):
    schema = pa.schema([("row_id", pa.int64()), ("row_hash", pa.int64()), ("anchor", pa.int64()),
                        ("start", pa.int32()), ("codes", pa.binary()), ("mask", pa.int64())])

    def of(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = words(part.column("text"))
        text, at = gram_starts(found.first, size)
        if not len(at):
            return
        codes = found.hashes()
        grams = np.arange(len(codes) - anchor + 1)
        least, where = _smallest(range_hashes(codes, grams, grams + anchor), size - anchor + 1)
        least, where, window = least[at], where[at], range_hashes(codes, at, at + size)
        start = at - found.first[text]

        order = np.lexsort((window, text))
        same = (text[order][1:] == text[order][:-1]) & (window[order][1:] == window[order][:-1])
        again, first = np.zeros(len(at), bool), np.ones(len(at), bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        first[order[1:][same]] = False

        ids, hashes = (part.column(c) for c in ("row_id", "row_hash"))
        own = np.flatnonzero(first)
        cut = np.ones(len(own), bool)
        cut[1:] = (np.diff(own) != 1) | (np.diff(where[own]) != 0) | (np.diff(text[own]) != 0)
        heads = np.flatnonzero(cut)
        ends = np.append(heads[1:], len(own))
        raw = np.ascontiguousarray(window[own].view(np.uint8).reshape(-1, 8)[:, 8 - _BYTES :])
        offsets = np.append(heads, len(own)).astype(np.int32) * _BYTES
        blobs = pa.Array.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        lead = own[heads]
        of_text = pa.array(text[lead])
        assert len(ends) == len(heads)
        yield pa.RecordBatch.from_arrays(
            [ids.take(of_text), hashes.take(of_text), pa.array(least[lead].view(np.int64)),
             pa.array(start[lead].astype(np.int32)), blobs, pa.nulls(len(heads), pa.int64())], schema=schema)

        own = np.flatnonzero(again)
        if len(own):
            block = start[own] // 32
            heads = np.flatnonzero(np.append(True, (np.diff(block) != 0) | (np.diff(text[own]) != 0)))
            bits = np.bitwise_or.reduceat(np.int64(1) << (start[own] % 32), heads)
            of_text = pa.array(text[own[heads]])
            yield pa.RecordBatch.from_arrays(
                [ids.take(of_text), hashes.take(of_text), pa.nulls(len(heads), pa.int64()),
                 pa.array((block[heads] * 32).astype(np.int32)), pa.nulls(len(heads), pa.binary()), pa.array(bits)],
                schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield from of(part)

    return run


def repeated_windows(docs: DataFrame, size: int, anchor: int = 8) -> DataFrame:
    """``row_id, row_hash, marks``: for each text with repeated windows, where they start.

    ``docs`` has row_id, row_hash and text. A mark is (start, mask): bit i is set
    if the window from word start + i is repeated.
    """
    if not 0 < anchor <= size or size - anchor >= 63:
        raise ValueError("anchor must be at most size, and size - anchor below 63")
    runs = docs.mapInArrow(_runs(size, anchor), _RUNS)
    local = runs.filter("anchor is null").select("row_id", "row_hash", "start", "mask")
    runs = runs.filter("anchor is not null")
    common = runs.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    shared = runs.join(common, "anchor", "left_semi")
    places = F.sequence(F.lit(0), (F.octet_length("codes") / _BYTES).cast("int") - 1)
    shared = shared.select(
        "anchor", "row_id", "row_hash", "start", "codes", F.explode(places).alias("i")
    ).withColumn("code", F.expr(f"substring(codes, {_BYTES} * i + 1, {_BYTES})")).drop("codes")
    times = F.count("*").over(W.partitionBy("anchor", "code"))
    hits = shared.withColumn("times", times).filter("times > 1")
    hits = hits.groupBy("anchor", "row_id", "row_hash", "start").agg(
        F.bit_or(F.expr("shiftleft(1L, i)")).alias("mask")
    )
    marks = hits.select("row_id", "row_hash", "start", "mask").union(local)
    return marks.groupBy("row_id", "row_hash").agg(F.collect_list(F.struct("start", "mask")).alias("marks"))


def _cut(size: int):
    @F.arrow_udf("struct<n_words: bigint, n_removed: bigint, text: string>")
    def cut(texts: pa.Array, marks: pa.Array) -> pa.Array:
        n_words, n_removed, left = [], [], []
        for text, mark in zip(texts, marks):
            held = (text.as_py() or "").encode().split()
            gone = 0
            if mark.is_valid:
                own = mark.values
                start, mask = (own.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("start", "mask"))
                bits = np.arange(64)
                at = (start[:, None] + bits)[(mask[:, None] >> bits) & 1 == 1]
                edge = np.zeros(len(held) + 1, np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + size, -1)
                keep = np.cumsum(edge[:-1]) == 0
                gone = int(len(held) - keep.sum())
                n_words.append(len(held))
                held = [held[i] for i in np.flatnonzero(keep)]
            else:
                n_words.append(len(held))
            n_removed.append(gone)
            left.append(b" ".join(held).decode())
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(left, pa.string())],
            names=["n_words", "n_removed", "text"])

    return cut


def without_repeats(docs: DataFrame, size: int = 35) -> DataFrame:
    """``source_row, cut``: each row of ``docs`` as a struct, and its ``n_words, n_removed, text``.

    The text holds the words that stay, joined by one space. A null text has no
    words and comes back empty; texts of fewer than ``size`` words lose nothing. A
    row given twice repeats itself, so all its windows go. A null doc_id is a value
    like any other. Other columns are carried in ``source_row``, whatever their
    names. An empty table gives no rows. A text of any length has all its windows.
    """
    row_id, text = F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(row_id.alias("row_id"), F.xxhash64(text).alias("row_hash"), text.alias("text"),
                        F.struct("*").alias("source_row"))
    marks = repeated_windows(keyed.select("row_id", "row_hash", "text"), size)
    marks = kept(marks.withColumnsRenamed({"row_id": "m_id", "row_hash": "m_hash"}), "repeats")
    same = F.col("row_id").eqNullSafe(F.col("m_id")) & (F.col("row_hash") == F.col("m_hash"))
    return keyed.join(marks, same, "left").select("source_row", _cut(size)("text", "marks").alias("cut"))


def cut_documents(docs: DataFrame, size: int = 35) -> DataFrame:
    """The rows of ``docs`` with their columns, the text being what stays and n_chars its length.

    Nulls, ties, repeated rows, long texts and an empty table as in ``without_repeats``;
    the other columns, null or not, stay as they are.
    """
    new = {"text": F.col("cut.text"), "n_chars": F.length("cut.text").cast("bigint")}
    return without_repeats(docs, size).select(*[
        new.get(c, F.col("source_row").getField(c)).cast(kind).alias(c) for c, kind in docs.dtypes
    ])


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = without_repeats(documents(spark, sf_dir), 35)
    return rows.select(
        F.col("source_row.doc_id").cast("bigint").alias("doc_id"), "cut.n_words", "cut.n_removed",
        F.sha2(F.col("cut.text").cast("binary"), 256).alias("kept_sha256"),
    )
