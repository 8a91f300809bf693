from collections import defaultdict
from math import floor

import numpy as np
import pytest

from netload.llm import pivot_search


def brute(rows, k):
    own = [(i, [floor(1024 * x) for x in v]) for i, v in rows]
    out = defaultdict(list)
    for q, (i, v) in enumerate(own):
        if i % 100 == 0:
            found = [(-sum(a * b for a, b in zip(v, w)), j) for j, w in own if j != i and len(w) == len(v)]
            out[i] += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(found)[:k])]
    return sorted(x for rows in out.values() for x in rows)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>, kind STRING, dim STRING")


def found(frame, condition="vec_id % 100 = 0", k=10):
    return sorted(map(tuple, pivot_search.top_k(frame, condition, k).collect()))


def test_equals_brute_force_with_ties_and_signs(spark, monkeypatch):
    monkeypatch.setattr(pivot_search, "GROUP", 90)
    rows = [(i, [((i * 7 + j * 13) % 17 - 8) / 16 for j in range(5)]) for i in range(-200, 400)]
    assert found(vectors(spark, [(*r, "c", None) for r in rows])) == brute(rows, 10)


def test_queries_may_reach_each_group_in_another_order(spark, monkeypatch):
    search = pivot_search._search

    def reordered(*given):
        def each(batches):
            batches = list(batches)
            rows = [row for batch in batches for row in batch.to_pylist()]
            runs = {}
            for row in rows:
                runs.setdefault((row["block"], row["group"]), {"q": [], "c": []})[row["kind"]].append(row)
            assert all(len(run["q"]) > 1 for run in runs.values() if run["c"])
            for (_, group), run in runs.items():
                own = run["q"][:: -1 if group % 2 else 1] + run["c"]
                yield from search(*given)(iter([type(batches[0]).from_pylist(own, batches[0].schema)]))

        return each

    monkeypatch.setattr(pivot_search, "GROUP", 90)
    monkeypatch.setattr(pivot_search, "_search", reordered)
    rows = [(i, [((i * 7 + j * 13) % 17 - 8) / 16 for j in range(5)]) for i in range(-300, 500)]
    rows += [(100, rows[400][1])]  # a query of two rows
    frame = vectors(spark, [(*r, "c", None) for r in rows]).repartition(4, "embedding")
    assert found(frame) == brute(rows, 10)


def test_clustered_vectors_are_mostly_eliminated():
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(40, 32))
    ints = np.floor(1024 * (centres[draw.integers(0, 40, 8000)] + 0.05 * draw.normal(size=(8000, 32)))).astype(np.int64)
    ids, queries = np.arange(8000), np.arange(0, 8000, 100)
    pivots = pivot_search.choose_pivots(ints[:2048])
    table = pivot_search._distances(ints, pivots)
    search = pivot_search._Search(10, (ids[:2048], ints[:2048]))
    search.add(ids[queries], ids[queries], ints[queries], table[queries])
    for cell in range(len(pivots)):
        own = np.flatnonzero(table[:, 1:].argmin(1) == cell)
        search.meet(ids[own], ints[own], table[own])
    assert search.evaluated < 0.5 * len(queries) * 8000
    for q, best in zip(queries, search.best):
        scores = ints @ ints[q]
        assert best == sorted((-int(s), int(j)) for j, s in enumerate(scores) if j != q)[:10]


def test_odd_vectors_take_no_part(spark):
    good = [(0, [1.0, 2.0]), (1, [0.5, -1.0]), (100, [1.0, 2.0, 3.0]), (2, [3.0, 1.0]), (200, []), (3, [])]
    bad = [(4, None), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    assert found(vectors(spark, [(*r, None, "d") for r in good + bad])) == brute(good, 10)


def test_large_components_stay_exact(spark):
    rows = [(0, [2.0**20, 1.0]), (1, [2.0**19, 3.0]), (2, [2.0**19, 5.0])]
    assert found(vectors(spark, [(*r, None, None) for r in rows]), k=1) == brute(rows, 1)


def test_repeated_rows_and_empty_table(spark):
    rows = [(0, [1.0], None, None), (1, [2.0], None, None), (1, [2.0], None, None)]
    assert found(vectors(spark, rows)) == [(0, 1, 1, 2048 * 1024), (0, 2, 1, 2048 * 1024)]
    assert found(vectors(spark, rows).limit(0)) == []


@pytest.mark.parametrize("n", [1, 5])
def test_pivots_are_spread(n):
    assert len(pivot_search.choose_pivots(np.arange(n, dtype=float).reshape(n, 1))) == n


def test_given_table(spark, sf_dir):
    import duckdb

    rows = sorted(map(tuple, pivot_search.op1_pivot_top_k(spark, sf_dir).select("query_id", "rank", "score", "vec_id").collect()))
    base = duckdb.connect()
    base.sql(f"CREATE VIEW embeddings AS FROM '{sf_dir}/embeddings.parquet'")
    assert rows == sorted(base.sql(f"SELECT query_id, rank, score, vec_id FROM ({pivot_search.OP1_SQL})").fetchall())
