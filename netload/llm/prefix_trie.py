"""A trie of conversation prefixes, as node tables behind minimal perfect hashes.

A prefix is known by a digest, folded turn by turn. Distinct digests are enumerated by
one aggregate that combines before its shuffle. Then the trie is cut into shards: a
node is heavy if more than a bound of turns lie at or below it, and each subtree under
a heavy node belongs to one shard as a whole. A shard gives each digest a
slot by a minimal perfect hash that keeps the digest in the slot and so tells foreign ones
apart, scatters counts into flat arrays by slot and adds them up through an array of
parent slots, deepest level first. Heavy nodes are few (each level has less than
``LEVEL`` of them, or one for each ``SHARD`` turns): they are added up level by level, holding two levels at a time.

A conversation, first turn or node that holds a third of all rows stays no group of
one task: turns are numbered and folded within ranges of (conversation, turn), and
what comes before a range is carried into it by one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netload.llm.schema import kept
from netload.llm.wordhash import mix
from netload.operators.prefix import numbered

#: Conversations of one family share the first turns of the family's first one.
FAMILY, MOST_SHARED = 20, 3
#: A light subtree has at most so many turns at or below its top ...
SHARD = 1 << 10
#: ... or this part of all turns, if that is more.
LEVEL = 1 << 16
#: Characters of joined ids that one row carries.
PIECE = 1 << 20

_PRIME, _BASE = (1 << 127) - 1, 0x2545F4914F6CDD1D9E3779B97F4A7C15
_NO_ENDS = hashlib.sha256(b"").hexdigest()

_STEPS = "conv bigint, d bigint, len bigint, words bigint"
_FOLDED = f"{_STEPS}, part int, i bigint, before binary, after binary, total boolean"
_PATHS = f"{_STEPS}, hi bigint, lo bigint, up_hi bigint, up_lo bigint"
_SUMS = "n_children bigint, n_leaves bigint, saved_tokens bigint"
_NODES = f"hi bigint, lo bigint, up_hi bigint, up_lo bigint, depth bigint, owner bigint, up_owner bigint, n_convs bigint, {_SUMS}"
_SCHEMAS = {
    kind: pa.schema([(name, {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}[t])
                     for name, t in map(str.split, kind.split(", "))])
    for kind in (_FOLDED, _PATHS, _NODES, "hi bigint, lo bigint, part int, at bigint, whole boolean, ids string", "hi bigint, lo bigint, ends_sha256 string")
}
_LISTS, _ENDS = [k for k in _SCHEMAS if "string" in k]


class SlotTable:
    """Slots 0 to n - 1 for n distinct 128-bit digests, by levels of arrays of twice the digests left.

    On each level, digests alone in their place stay; the others go to the next. ``find``
    compares the digest that a slot keeps, so one that was not put in has no slot.
    """

    def __init__(self, hi: np.ndarray, lo: np.ndarray):
        self.hi, self.lo = np.empty(len(hi), np.int64), np.empty(len(hi), np.int64)
        self._levels: list[np.ndarray] = []
        left, taken = np.arange(len(hi)), 0
        while len(left):
            size = max(64, 2 * len(left))
            place = self._place(hi[left], lo[left], size, len(self._levels))
            alone = np.bincount(place, minlength=size) == 1
            slot = np.where(alone, taken + np.cumsum(alone) - 1, -1)
            self._levels.append(slot)
            stays = alone[place]
            mine = slot[place[stays]]
            self.hi[mine], self.lo[mine] = hi[left[stays]], lo[left[stays]]
            left, taken = left[~stays], taken + int(alone.sum())

    @staticmethod
    def _place(hi: np.ndarray, lo: np.ndarray, size: int, level: int) -> np.ndarray:
        code = mix(hi.view(np.uint64) ^ mix(lo.view(np.uint64) + np.uint64(level + 1)))
        return (code % np.uint64(size)).astype(np.int64)

    def find(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The slot of each digest; -1 for one that has none."""
        out, left = np.full(len(hi), -1, np.int64), np.arange(len(hi))
        for level, slots in enumerate(self._levels):
            slot = slots[self._place(hi[left], lo[left], len(slots), level)]
            out[left] = slot
            left = left[slot < 0]
        known = out >= 0
        known[known] = (self.hi[out[known]] == hi[known]) & (self.lo[out[known]] == lo[known])
        return np.where(known, out, -1)


def _rows(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def _batches(rows: Iterator[tuple], kind: str, size: int = 8192) -> Iterator[pa.RecordBatch]:
    schema, held = _SCHEMAS[kind], []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _bytes(state: int) -> bytes:
    return state.to_bytes(16, "big")


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv, at, digest, words``: the turns in order, from 0 in each conversation, texts replaced by a digest and their count of words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").alias("turn"), role.alias("role"),
        F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"),
    )
    rows = kept(numbered(rows, "conv", "turn", "role", "digest").drop("turn", "role"), "turns")
    first = rows.groupBy("conv").agg(F.min("pos").alias("first"))
    return rows.join(first, "conv").select("conv", (F.col("pos") - F.col("first")).alias("at"), "digest", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of the rebuilt conversations (conv, d from 1, len, digest, words), and all conversations (conv, len)."""
    convs = turns.groupBy("conv").agg(F.count("*").alias("n"))
    shared = (F.crc32(F.col("conv").cast("string").cast("binary")) % (MOST_SHARED + 1)).alias("h")
    convs = convs.select("conv", "n", shared, (F.col("conv") - F.col("conv") % FAMILY).alias("base"))
    sizes = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(sizes, "base", "left").withColumn("k", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = convs.withColumn("len", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = kept(convs.select("conv", "base", "h", "k", "len"), "conversations")
    own = turns.join(convs, "conv").filter("at >= h").select("conv", (F.col("at") - F.col("h") + F.col("k") + 1).alias("d"), "len", "digest", "words")
    heads = turns.filter(f"at < {MOST_SHARED} AND conv % {FAMILY} = 0").select(F.col("conv").alias("base"), "at", "digest", "words")
    lent = convs.filter("k > 0").join(heads, "base").filter("at < k").select("conv", (F.col("at") + 1).alias("d"), "len", "digest", "words")
    return own.unionByName(lent), convs.select("conv", "len")


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of prefixes from the first turn in this range on, and the totals of its first and last conversation."""
    part = TaskContext.get().partitionId()

    def rows() -> Iterator[tuple]:
        runs = groupby(_rows(batches, ["conv", "d", "len", "words", "digest"]), lambda r: r[0])
        last, opened = None, True
        for conv, turns in runs:
            state, first = 0, None
            for i, (_, d, n, words, code) in enumerate(turns):
                first, before = first or d, state
                state = (state * _BASE + int.from_bytes(code, "big") + 1) % _PRIME
                yield conv, d, n, words, part, i + 1, _bytes(before), _bytes(state), False
            last = (conv, first, n, 0, part, i + 1, b"", _bytes(state), True)
            if opened:
                yield last
            opened, last = False, None if opened else last
        if last:
            yield last

    yield from _batches(rows(), _FOLDED)


def _carried(totals: DataFrame) -> dict[tuple[int, int], int]:
    """The digest with which a conversation enters each range that doesn't hold its first turn. ``totals`` has two rows a range at most."""
    states: dict[int, int] = {}
    out = {}
    for r in totals.orderBy("part", "conv").collect():
        if r["d"] > 1:
            out[r["part"], r["conv"]] = states.get(r["conv"], 0)
        into = states.get(r["conv"], 0) if r["d"] > 1 else 0
        states[r["conv"]] = (into * pow(_BASE, r["i"], _PRIME) + int.from_bytes(r["after"], "big")) % _PRIME
    return out


def _complete(carried: dict[tuple[int, int], int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            into = [carried.get(key, 0) for key in zip(batch.column("part").to_pylist(), batch.column("conv").to_pylist())]
            columns = [batch.column(c) for c in ("conv", "d", "len", "words")]
            for name, back in (("after", 0), ("before", 1)):
                codes = batch.column(name).to_pylist()
                for row, state in enumerate(into):
                    if state:
                        i = batch.column("i")[row].as_py() - back
                        codes[row] = _bytes((state * pow(_BASE, i, _PRIME) + int.from_bytes(codes[row], "big")) % _PRIME)
                halves = np.frombuffer(b"".join(codes), ">i8").astype(np.int64).reshape(-1, 2)
                columns += [pa.array(halves[:, 0]), pa.array(halves[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, schema=_SCHEMAS[_PATHS])

    return run


def paths_of(steps: DataFrame) -> DataFrame:
    """Each rebuilt turn with the digest of the prefix that it ends (hi, lo) and of the one before (up_hi, up_lo). Runs jobs."""
    laid = steps.repartitionByRange("conv", "d").sortWithinPartitions("conv", "d")
    folded = kept(laid.select("conv", "d", "len", "words", "digest").mapInArrow(_fold, _FOLDED), "folded")
    carried = _carried(folded.filter("total").select("part", "conv", "d", "i", "after"))
    return kept(folded.filter("NOT total").drop("total").mapInArrow(_complete(carried), _PATHS), "paths")


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of whole light subtrees."""
    table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
    if table is None or not table.num_rows:
        return
    col = {c: table.column(c).to_numpy() for c in table.column_names}
    slots = SlotTable(col["hi"], col["lo"])
    mine, n = slots.find(col["hi"], col["lo"]), table.num_rows
    flat = {}
    for name in ("up_hi", "up_lo", "depth", "owner", "n_convs", "words"):
        flat[name] = np.empty(n, np.int64)
        flat[name][mine] = col[name]
    parent = slots.find(flat["up_hi"], flat["up_lo"])
    under = parent >= 0  # the parent of a top is heavy and not here
    children = np.bincount(parent[under], minlength=n)
    leaves = (children == 0).astype(np.int64)
    saved = (flat["n_convs"] - 1) * flat["words"]
    order = np.argsort(-flat["depth"], kind="stable")
    cuts = np.flatnonzero(np.diff(flat["depth"][order])) + 1
    for level in np.split(order, cuts):
        level = level[under[level]]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    up_owner = pa.array(np.where(under, flat["owner"][parent], 0), pa.int64(), mask=~under)
    columns = [slots.hi, slots.lo, flat["up_hi"], flat["up_lo"], flat["depth"], flat["owner"], up_owner, flat["n_convs"], children, leaves, saved]
    yield from pa.Table.from_arrays([pa.array(c) for c in columns], schema=_SCHEMAS[_NODES]).to_batches(max_chunksize=1 << 16)


def _heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of heavy nodes from those of the light subtrees under them; rows come deepest first."""
    columns = ["hi", "lo", "up_hi", "up_lo", "depth", "owner", "n_convs", "words", "n_children", "n_leaves", "saved_tokens"]

    def rows() -> Iterator[tuple]:
        below: dict[tuple, list[int]] = {}
        for _, level in groupby(_rows(batches, columns), lambda r: r[4]):
            above: dict[tuple, list[int]] = {}
            for hi, lo, up_hi, up_lo, depth, owner, n, words, *sums in level:
                children, leaves, saved = (a + b for a, b in zip(sums, below.get((hi, lo), (0, 0, 0))))
                leaves, saved = leaves + (children == 0), saved + (n - 1) * words
                into = above.setdefault((up_hi, up_lo), [0, 0, 0])
                into[0], into[1], into[2] = into[0] + 1, into[1] + leaves, into[2] + saved
                yield hi, lo, up_hi, up_lo, depth, owner, None, n, children, leaves, saved
            below = above

    yield from _batches(rows(), _NODES)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of each node of a range, joined, in rows of up to PIECE characters; ``whole`` if no other range or row has more."""
    part = TaskContext.get().partitionId()

    def rows() -> Iterator[tuple]:
        runs, first = groupby(_rows(batches, ["hi", "lo", "conv"]), lambda r: r[:2]), True
        run = next(runs, None)
        while run:
            (hi, lo), ids = run
            at, held, size = 0, [], 0
            for _, _, conv in ids:
                held.append(str(conv))
                size += len(held[-1]) + 1
                if size > PIECE:
                    yield hi, lo, part, at, False, ",".join(held)
                    at, held, size = at + 1, [], 0
            run = next(runs, None)
            if held:
                yield hi, lo, part, at, not (first or at or run is None), ",".join(held)
            first = False

    yield from _batches(rows(), _LISTS, 16)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for (hi, lo), pieces in groupby(_rows(batches, ["hi", "lo", "ids"]), lambda r: r[:2]):
            found, comma = hashlib.sha256(), b""
            for _, _, ids in pieces:
                found.update(comma + ids.encode())
                comma = b","
            yield hi, lo, found.hexdigest()

    yield from _batches(rows(), _ENDS)


def ends_of(ends: DataFrame) -> DataFrame:
    """``hi, lo, ends_sha256`` from the conversations that end at each node (hi, lo, conv).

    A digest reads its input in order: ids are sorted and joined range by range, and
    only the joined pieces of a node that lies in several ranges meet in one task, which streams them.
    """
    laid = ends.repartitionByRange("hi", "lo", "conv").sortWithinPartitions("hi", "lo", "conv")
    lists = kept(laid.mapInArrow(_joined, _LISTS), "ends")
    alone = lists.filter("whole").select("hi", "lo", F.sha2("ids", 256).alias("ends_sha256"))
    spread = lists.filter("NOT whole").repartition("hi", "lo").sortWithinPartitions("hi", "lo", "part", "at")
    return alone.unionByName(spread.mapInArrow(_digests, _ENDS))


def trie(conversations: DataFrame, shard: int = SHARD, level: int = LEVEL) -> DataFrame:
    """A row for each distinct prefix of the rebuilt conversations, the textless root included.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. Turns stand in the order of ``turn``, null
    first; equal ones in the order of role and a digest of role and text, so repeated rows count as
    turns of their own. A null role or text is empty; blank and empty texts have no
    words. Texts of any length are hashed and counted inside Spark and never moved.
    Rows without a conv_id take no part. An empty table has no nodes. Other columns
    are ignored. Digests have 127 bits. Runs jobs that write to the scratch folder.
    """
    steps, convs = rebuilt(kept(turns_of(conversations), "turns"))
    paths = paths_of(steps)
    roots = convs.selectExpr("conv", "0L AS d", "len", "0L AS words", "0L AS hi", "0L AS lo", "-1L AS up_hi", "-1L AS up_lo")
    nodes = paths.unionByName(roots).groupBy("hi", "lo").agg(
        *[F.min(c).alias(c) for c in ("up_hi", "up_lo", "words")], F.min("d").alias("depth"), F.min("conv").alias("owner"),
        F.count("*").alias("n_convs"), F.sum(F.col("len") - F.col("d") + 1).alias("weight"),
    )
    nodes = kept(nodes, "nodes")
    total = convs.agg(F.sum(F.col("len") + 1)).first()[0] or 0
    limit = max(shard, total // level, 1)
    is_heavy = (F.col("weight") > limit) | (F.col("depth") == 0)
    heavy = kept(nodes.filter(is_heavy), "heavy")

    tops = paths.join(heavy.select("hi", "lo"), ["hi", "lo"], "left_anti").groupBy("conv").agg(F.min(F.struct("d", "hi", "lo")).alias("top"))
    light = nodes.filter(~is_heavy).join(tops.select(F.col("conv").alias("owner"), "top"), "owner")
    shards = max(int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * total // limit)
    light = kept(light.repartition(shards, "top.hi", "top.lo").drop("top", "weight").mapInArrow(_shard, _NODES), "light")

    under = light.filter("up_owner IS NULL").groupBy(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo"))
    under = under.agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    above = heavy.join(under, ["hi", "lo"], "left").fillna(0, ["n_children", "n_leaves", "saved_tokens"])
    above = kept(above.repartition(1).sortWithinPartitions(F.desc("depth")).mapInArrow(_heavy, _NODES), "above")

    owners = above.select(F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("owner").alias("heavy_owner"))
    found = light.filter("up_owner IS NULL").unionByName(above).join(owners, ["up_hi", "up_lo"], "left").withColumn("up_owner", F.col("heavy_owner"))
    found = found.drop("heavy_owner").unionByName(light.filter("up_owner IS NOT NULL"))
    ends = ends_of(paths.filter("d = len").select("hi", "lo", "conv").unionByName(roots.filter("len = 0").select("hi", "lo", "conv")))
    return found.join(ends, ["hi", "lo"], "left").select(
        F.col("owner").alias("conv_id"), "depth", F.col("up_owner").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
