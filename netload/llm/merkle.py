"""Merkle manifest of a documents table: a root for each source, one root over them, and a proof for each row.

Only every ``step``-th level is stored (checkpoint and recompute). A subtree between
two stored levels, at most ``FANOUT ** step`` nodes at its bottom, is aligned and
belongs to one group of a shuffle: building folds it to its top and stores that alone;
extracting a proof folds the stored bottom again, reads the siblings off and drops
the interior nodes. A source of any size is therefore many small groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netload.llm.schema import documents, kept
from netload.operators.prefix import numbered

FANOUT = 3
#: Levels between stored ones.
STEP = 6
_DIGITS = 64

_NODES = "tree bigint, idx bigint, n bigint, node binary"
_PATHS = "tree bigint, idx bigint, subroot binary, places array<int>, siblings array<string>"
_PROVED = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def _leaf(columns: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(_field, columns)), 256))


def _steps(n: int, step: int) -> int:
    """Levels from a stored one to the next, in a tree that has n nodes on it: fewer than ``step`` only at the top."""
    levels = 0
    while n > 1 and levels < step:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def _up(nodes: list[str]) -> list[str]:
    return [digest(*nodes[i : i + FANOUT]) for i in range(0, len(nodes), FANOUT)]


def _levels(nodes: list[str], steps: int) -> list[list[str]]:
    out = [nodes]
    for _ in range(steps):
        out.append(_up(out[-1]))
    return out


def _siblings(levels: list[list[str]]) -> list[list[str]]:
    """For each level but the last and each node on it, the other nodes of its run, joined from left to right."""
    out = []
    for nodes in levels[:-1]:
        runs = (nodes[i : i + FANOUT] for i in range(0, len(nodes), FANOUT))
        out.append(["".join(run[:k] + run[k + 1 :]) for run in runs for k in range(len(run))])
    return out


def fold(node: str, places: list[int], siblings: list[str]) -> str:
    """The root that a node and its siblings give; ``places`` says where the node stands in each run."""
    for place, others in zip(places, siblings):
        cut = place * _DIGITS
        node = digest(others[:cut], node, others[cut:])
    return node


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_NODE_SCHEMA = pa.schema([("tree", pa.int64()), ("idx", pa.int64()), ("n", pa.int64()), ("node", pa.binary())])
_PATH_SCHEMA = pa.schema([
    ("tree", pa.int64()), ("idx", pa.int64()), ("subroot", pa.binary()), ("places", pa.list_(pa.int32())),
    ("siblings", pa.list_(pa.string())),
])
_PROVED_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
    ("verified", pa.bool_()),
])


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[dict]]]:
    """Tree, number and rows of each aligned subtree; the rows come in its order."""
    for (tree, at), rows in groupby(_rows(batches), lambda r: (r["tree"], r["at"])):
        yield tree, at, list(rows)


def _build(step: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tops() -> Iterator[tuple]:
            for tree, at, rows in _subtrees(batches):
                n = rows[0]["n"]
                top = _levels([r["node"].hex() for r in rows], _steps(n, step))[-1][0]
                yield tree, at, -(-n // FANOUT**step), bytes.fromhex(top)

        yield from _batches(tops(), _NODE_SCHEMA)

    return run


def _grouped(rows: DataFrame, step: int, *within: str) -> DataFrame:
    """The rows of each aligned subtree together and in order."""
    rows = rows.withColumn("at", F.expr(f"idx div {FANOUT**step}"))
    return rows.repartition("tree", "at").sortWithinPartitions("tree", "at", *within, "idx")


@dataclass
class Stored:
    """The stored levels of some trees, lowest first; the last has one node for each tree."""

    levels: list[DataFrame]
    step: int

    @property
    def tops(self) -> DataFrame:
        return self.levels[-1].select("tree", "node")


def build(leaves: DataFrame, step: int = STEP) -> Stored:
    """Folds trees from ``tree, idx, n, node`` (idx from 0 in each tree, n its size). A job for each stored level."""
    levels = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 1
    while most > 1:
        below = _grouped(levels[-1].select("tree", "idx", "n", "node"), step)
        levels.append(kept(below.mapInArrow(_build(step), _NODES), "level"))
        most = -(-most // FANOUT**step)
    return Stored(levels, step)


def _extended(step: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def paths() -> Iterator[tuple]:
            for tree, _, (upper, *nodes) in _subtrees(batches):
                others = _siblings(_levels([r["node"].hex() for r in nodes], _steps(nodes[0]["n"], step)))
                for i, row in enumerate(nodes):
                    places, siblings = _own(others, i)
                    yield tree, row["idx"], upper["subroot"], places + upper["places"], siblings + upper["siblings"]

        yield from _batches(paths(), _PATH_SCHEMA)

    return run


def _own(others: list[list[str]], i: int) -> tuple[list[int], list[str]]:
    places, siblings = [], []
    for level in others:
        places.append(i % FANOUT)
        siblings.append(level[i])
        i //= FANOUT
    return places, siblings


def _under(upper: DataFrame, nodes: DataFrame, step: int) -> DataFrame:
    """Nodes with the path of their subtree's top as the first row of each subtree."""
    tops = upper.withColumn("idx", F.col("idx") * FANOUT**step).withColumn("kind", F.lit(0))
    return _grouped(tops.unionByName(nodes.withColumn("kind", F.lit(1)), allowMissingColumns=True), step, "kind")


def paths_below(stored: Stored, upper: DataFrame) -> DataFrame:
    """Paths to the top of the nodes on the second stored level, from those of the trees' tops."""
    for level in reversed(stored.levels[1:-1]):
        upper = kept(_under(upper, level, stored.step).mapInArrow(_extended(stored.step), _PATHS), "paths")
    return upper


def _prove(root: str, step: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def proofs() -> Iterator[tuple]:
            for _, _, (upper, *leaves) in _subtrees(batches):
                levels = _levels([r["node"].hex() for r in leaves], _steps(leaves[0]["n"], step))
                others, above = _siblings(levels), "".join(upper["siblings"])
                subroot = upper["subroot"].hex()
                for i, row in enumerate(leaves):
                    places, siblings = _own(others, i)
                    leaf = levels[0][i]
                    start = leaf if row["tampered"] is None else row["tampered"].hex()
                    found = fold(start, places + upper["places"], siblings + upper["siblings"])
                    yield row["doc_id"], leaf, subroot, root, digest(*siblings, above), found, found == root

        yield from _batches(proofs(), _PROVED_SCHEMA)

    return run


def manifest(docs: DataFrame, step: int = STEP) -> DataFrame:
    """A row for each document: leaf, subroot of its source, root, digest of its proof, and the root that its text now gives.

    Null fields are written `-` into the leaf, so null and empty texts differ; a null
    source is a source of its own and stands first; null doc_ids stand first in
    theirs. Rows of one doc_id stand in the order of their leaves, so repeated rows
    have their own places and proofs. A text of any length is hashed inside Spark and
    never moved. An empty table gives no rows. Other columns are ignored. Runs jobs.
    """
    fields = [F.col("doc_id").cast("bigint"), F.col("source"), F.col("lang"), F.col("n_chars"), F.col("text").cast("string")]
    changed = [*fields[:-1], F.replace(fields[-1], F.lit("\n"), F.lit(""))]
    even = F.crc32(F.col("doc_id").cast("bigint").cast("string")) % 2 == 0  # of a null doc_id: null, so not tampered with
    leaves = docs.select(
        fields[0].alias("doc_id"), fields[1].cast("string").alias("source"), _leaf(fields).alias("node"),
        F.when(even, _leaf(changed)).alias("tampered"),
    )
    leaves = kept(numbered(leaves, "source", "doc_id", "node"), "leaves")
    # a source is known by the position of its first row, which is never null and keeps the order of sources
    sources = leaves.groupBy("source").agg(F.min("pos").alias("tree"), F.count("*").alias("n"))
    leaves = leaves.join(sources.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of")))
    leaves = leaves.select("tree", (F.col("pos") - F.col("tree")).alias("idx"), "n", "node", "doc_id", "tampered")
    leaves = kept(leaves, "level")
    if leaves.isEmpty():
        return docs.sparkSession.createDataFrame([], _PROVED)

    low = build(leaves, step)
    subroots = numbered(low.tops, "tree").withColumnRenamed("tree", "source")
    n_sources = F.lit(subroots.count())
    subroots = kept(subroots.select(F.lit(0).cast("bigint").alias("tree"), F.col("pos").alias("idx"), n_sources.alias("n"), "node", "source"), "level")
    high = build(subroots, step)
    root = high.tops.first()["node"].hex()

    none = "array()"
    top = docs.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("tree"), F.lit(0).cast("bigint").alias("idx"), F.lit(None).cast("binary").alias("subroot"),
        F.expr(f"cast({none} as array<int>)").alias("places"), F.expr(f"cast({none} as array<string>)").alias("siblings"),
    )
    upper = kept(_under(paths_below(high, top), subroots.drop("source"), step).mapInArrow(_extended(step), _PATHS), "paths")
    upper = upper.select("idx", "places", "siblings").join(subroots.select("idx", "source", "node"), "idx")
    first = F.lit(0).cast("bigint").alias("idx")
    upper = paths_below(low, upper.select(F.col("source").alias("tree"), first, F.col("node").alias("subroot"), "places", "siblings"))
    return _under(upper, leaves, step).mapInArrow(_prove(root, step), _PROVED)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(documents(spark, sf_dir))
