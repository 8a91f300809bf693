"""Exact top-k by inner product with a pivot table.

Every vector's distances to ``PIVOTS`` pivots are computed once. For a query q and a
candidate x, no pivot's |d(q, p) - d(x, p)| exceeds d(q, x), and
2 * score = |q|^2 + |x|^2 - d(q, x)^2, so the largest of these differences bounds the
score from above. Candidates are evaluated in the order of their bounds until the
next bound lies below the k-th best score found, which makes the result exact.

The stated queries meet all vectors in blocks: queries are dealt to blocks of about
``QUERY_BLOCK``, candidates to groups by their nearest pivot and a hash, and each pair is one run that
holds its queries and streams its candidates. A run hands on k rows for a query, which
keeps the number it was packed with in all runs. A query starts with the k-th best score
among the sampled vectors, which no result can lie below, and passes over a whole batch of candidates whose
ranges of pivot distances bound them under its k-th score so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from netload.llm.schema import kept

#: Pivots, and the vectors (those with the smallest hash) that they are chosen from.
PIVOTS, SAMPLE = 24, 2048
QUERY_BLOCK, GROUP = 8192, 4096
_CHUNK = 128

_PACKED = "kind string, key int, dim int, numbers binary, ids binary, ints binary, table binary"
_PACKED_SCHEMA = pa.schema([
    ("kind", pa.string()), ("key", pa.int32()), ("dim", pa.int32()), ("numbers", pa.binary()), ("ids", pa.binary()),
    ("ints", pa.binary()), ("table", pa.binary()),
])
_FOUND = "query bigint, query_id bigint, vec_id bigint, score bigint"


def _distances(ints: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Norms and distances to the pivots, one row per vector."""
    own = ints.astype(float)
    out = np.empty((len(own), 1 + len(pivots)))
    out[:, 0] = np.einsum("ij,ij->i", own, own)
    for j, p in enumerate(pivots):
        out[:, j + 1] = np.sqrt(np.einsum("ij,ij->i", own - p, own - p))
    return out


def choose_pivots(ints: np.ndarray) -> np.ndarray:
    """Vectors far from each other: each next one is the farthest from those chosen."""
    own, chosen = ints.astype(float), []
    far = np.full(len(own), np.inf)
    while len(chosen) < min(PIVOTS, len(own)):
        new = own[int(np.argmax(far))]
        chosen.append(new)
        far = np.minimum(far, np.einsum("ij,ij->i", own - new, own - new))
    return np.array(chosen).reshape(len(chosen), own.shape[1])


def _scores(candidates: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products as exact integers."""
    size = candidates.shape[1] * float(np.abs(candidates).max(initial=0)) * float(np.abs(query).max(initial=0))
    if size < 2**53:
        return (candidates.astype(float) @ query.astype(float)).astype(np.int64)
    return candidates.astype(object) @ query.astype(object)


def _integers(vectors: pa.Array) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    return np.floor(1024 * flat).astype(np.int64).reshape(len(vectors), -1)


def _pack(pivots: dict[int, np.ndarray], query_blocks: int, groups: int):
    slices = -(-groups // PIVOTS)  # of the candidates nearest to one pivot

    def rows(kind: str, key: np.ndarray, dim: int, numbers, ids, ints, table) -> Iterator[pa.RecordBatch]:
        for k in np.unique(key):
            at = np.flatnonzero(key == k)
            row = (kind, int(k), dim, numbers[at].tobytes(), ids[at].tobytes(), ints[at].tobytes(), table[at].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _PACKED_SCHEMA)], schema=_PACKED_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                numbers, ids = part.column("number").to_numpy(), part.column("vec_id").to_numpy()
                deal = part.column("deal").to_numpy()
                ints = _integers(part.column("vector")) if dim else np.zeros((len(ids), 0), np.int64)
                table = _distances(ints, pivots.get(int(dim), np.zeros((0, int(dim)))))
                cell = table[:, 1:].argmin(1) if table.shape[1] > 1 else np.zeros(len(ids), np.int64)
                key = cell * slices + deal % slices if groups > 1 else np.zeros(len(ids), np.int64)
                yield from rows("c", key, int(dim), numbers, ids, ints, table)
                own = np.flatnonzero(part.column("query").to_numpy(zero_copy_only=False))
                yield from rows("q", deal[own] // groups % query_blocks, int(dim), numbers[own], ids[own], ints[own], table[own])

    return run


class _Search:
    """The queries of one run of one dimension and the best candidates so far."""

    def __init__(self, k: int, sample: tuple[np.ndarray, np.ndarray] | None = None):
        self.k, self.numbers, self.ids, self.ints, self.table = k, [], [], [], []
        self.best: list[list[tuple[int, int]]] = []  # (-score, vec_id), ascending
        self.least: list[float] = []  # what the k-th best score is known to reach
        self.sample, self.evaluated = sample, 0

    def add(self, numbers, ids, ints, table) -> None:
        for i in range(len(ids)):
            self.numbers.append(int(numbers[i]))
            self.ids.append(int(ids[i]))
            self.ints.append(ints[i])
            self.table.append(table[i])
            self.best.append([])
            self.least.append(self._floor(int(ids[i]), ints[i]))

    def _floor(self, query_id: int, query: np.ndarray) -> float:
        if self.sample is None:
            return -np.inf
        ids, ints = self.sample
        scores = sorted((int(s) for s in _scores(ints[ids != query_id], query)), reverse=True)
        return scores[self.k - 1] if len(scores) >= self.k else -np.inf

    def meet(self, ids, ints, table) -> None:
        if not len(ids):
            return
        near_all = np.array(self.table)
        outside = np.maximum(table[:, 1:].min(0) - near_all[:, 1:], near_all[:, 1:] - table[:, 1:].max(0)).max(1, initial=0)
        size = table[:, 0].max() + near_all[:, 0]
        reach = (size - outside * outside) / 2 + size * 1e-9 + 1  # of the best of these candidates
        for i in np.flatnonzero(reach >= np.array(self.least, float)).tolist():
            query_id, query, near = self.ids[i], self.ints[i], self.table[i]
            apart = np.abs(table[:, 1:] - near[1:]).max(1, initial=0)
            size = table[:, 0] + near[0]
            # rounding of the distances is far below a part in 10^9 of the squares
            bound = (size - apart * apart) / 2 + size * 1e-9 + 1
            best = self.best[i]
            other = ids != query_id
            alive = np.flatnonzero(other & (bound >= self.least[i]))
            alive = alive[np.argsort(-bound[alive], kind="stable")]
            for at in range(0, len(alive), _CHUNK):
                now = alive[at : at + _CHUNK]
                now = now[bound[now] >= self.least[i]]
                if not len(now):
                    break
                self.evaluated += len(now)
                best = sorted(best + [(-int(s), int(v)) for s, v in zip(_scores(ints[now], query), ids[now])])[: self.k]
                if len(best) == self.k:
                    self.least[i] = max(self.least[i], -best[-1][0])
            self.best[i] = best


def _search(k: int, samples: dict[int, tuple[np.ndarray, np.ndarray]]):
    def found(run: dict[int, _Search]) -> pa.RecordBatch:
        rows = []
        for search in run.values():
            for number, query_id, best in zip(search.numbers, search.ids, search.best):
                rows += [(number, query_id, vec_id, -score) for score, vec_id in best]
        columns = list(zip(*rows)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query", "query_id", "vec_id", "score"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, run = None, {}
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["block"], row["group"])
                if key != now:
                    if run:
                        yield found(run)
                    now, run = key, {}
                ids, dim = np.frombuffer(row["ids"], np.int64), row["dim"]
                packed = ids, np.frombuffer(row["ints"], np.int64).reshape(len(ids), dim), np.frombuffer(row["table"]).reshape(len(ids), -1)
                if row["kind"] == "q":
                    run.setdefault(dim, _Search(k, samples.get(dim))).add(np.frombuffer(row["numbers"], np.int64), *packed)
                elif dim in run:
                    run[dim].meet(*packed)
        if run:
            yield found(run)

    return each


def top_k(vectors: DataFrame, is_query: str, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the k highest integer inner products, ties to the smaller vec_id.

    ``vectors`` has vec_id and embedding; ``is_query`` is an SQL condition on vec_id.
    Components count as floor(1024 * x). Rows without a vec_id, and vectors null or with
    null or non-finite components, take no part; vectors meet only those of their own
    length. A query's candidates are all rows with another vec_id, fewer than k if there
    are no more; repeated rows are candidates and queries each. An empty table gives no rows. Other
    columns are ignored. Runs jobs that count and choose pivots.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.size("embedding").alias("dim"),
        F.col("embedding").cast("array<double>").alias("vector"), F.shiftrightunsigned(F.xxhash64("vec_id"), 1).alias("deal"),
        F.expr(is_query).alias("query"), F.monotonically_increasing_id().alias("number"),
    )
    n, n_queries = rows.agg(F.count("*"), F.count_if("query")).first()
    groups, blocks = -(-n // GROUP) or 1, -(-n_queries // QUERY_BLOCK) or 1
    sample = rows.orderBy("deal", "vec_id").limit(SAMPLE).select("vec_id", "dim", "vector").collect()
    pivots, samples = {}, {}
    for dim in {r["dim"] for r in sample}:
        own = [r for r in sample if r["dim"] == dim]
        ints = np.floor(1024 * np.array([r["vector"] for r in own], float).reshape(len(own), dim))
        pivots[dim] = choose_pivots(ints)
        samples[dim] = np.array([r["vec_id"] for r in own], np.int64), ints.astype(np.int64)
    packed = kept(rows.mapInArrow(_pack(pivots, blocks, groups), _PACKED), "vectors")
    queries = packed.filter("kind = 'q'").withColumnRenamed("key", "block")
    last = PIVOTS * -(-groups // PIVOTS) - 1 if groups > 1 else 0
    queries = queries.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(last))))
    others = packed.filter("kind = 'c'").withColumnRenamed("key", "group")
    others = others.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    met = queries.unionByName(others).repartition("block", "group")
    met = met.sortWithinPartitions("block", "group", F.desc("kind"))
    found = met.mapInArrow(_search(k, samples), _FOUND)
    rank = F.row_number().over(W.partitionBy("query", "query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 100 = 0")


#: The same rows by brute force.
OP1_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
