"""The prefix trie against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_cases import words

from netload.llm import prefix_trie

COLUMNS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, depth STRING, owner INT, hi STRING, m MAP<STRING,INT>"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, None, {"a": 1}) for r in rows], COLUMNS)


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for *_, r, t in sorted(found)] for c, found in own.items()}
    paths = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        paths[c] = tuple(turns.get(base, [])[:h] + turns[c][h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                children[path[: d - 1]].add(path[:d])
    out, sums = [], {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[x] for x in children[node]]
        saved = (len(members[node]) - 1) * len(words(node[-1][1])) if node else 0
        sums[node] = (sum(x[0] for x in below) or 1, saved + sum(x[1] for x in below))
        ends = ",".join(map(str, sorted(c for c in members[node] if paths[c] == node)))
        out.append((
            min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(below),
            *sums[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def found(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def drawn(seed, n=150):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-60, 2 * n), n):
        for turn in range(draw.choice([0, 1, 1, 2, 3, 5, 9])):
            rows.append((c, turn, draw.choice(["user", "assistant", None]), draw.choice(["", None, "a", "b c", "b  c\n"])))
    return rows


@pytest.mark.parametrize(("shard", "level"), [(1 << 17, 1 << 20), (20, 1 << 20), (0, 1 << 20), (1, 7)])
def test_equals_plain_python(spark, shard, level):
    rows = drawn(shard + level)
    assert found(prefix_trie.trie(table(spark, rows).repartition(5), shard, level)) == brute(rows)


def test_one_long_conversation_and_one_common_start(spark, setting):
    setting(**{"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"})
    rows = [(19, t, "user", f"turn {t % 50}") for t in range(900)]
    rows += [(c, t, "user", "same start") for c in range(20, 300) for t in range(1 + (c % 7 == 0))]
    for shard in (1 << 17, 30):
        assert found(prefix_trie.trie(table(spark, rows).repartition(6), shard)) == brute(rows)


def test_odd_rows(spark):
    long = "w " * 40_000
    rows = [
        (0, None, "user", "null turn is first"), (0, 1, "user", long), (0, 2, None, None), (0, 2, "", ""), (0, 2, None, None),
        (1, 1, "ab", "c"), (2, 1, "a", "bc"), (None, 1, "user", "no conversation"), (None, None, None, None),
        (3, 5, "user", "x" * 50_000), (25, 0, "user", "no base here"), (-3, 1, "user", "below zero"), (-3, 1, "user", "below zero"),
    ]
    assert found(prefix_trie.trie(table(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert prefix_trie.trie(table(spark, drawn(1)).limit(0)).count() == 0
    assert prefix_trie.trie(table(spark, [(None, 1, "user", "x")])).count() == 0


def test_slots_are_minimal_and_know_foreign_digests():
    draw = np.random.default_rng(1)
    codes = draw.integers(-(2**63), 2**63 - 1, (20_000, 2))
    slots = prefix_trie.SlotTable(codes[:, 0], codes[:, 1])
    assert sorted(slots.find(codes[:, 0], codes[:, 1])) == list(range(20_000))
    assert (slots.find(codes[:, 1], codes[:, 0]) == -1).all()
    assert (slots.find(codes[:, 0], codes[:, 1] + 1) == -1).all()


def test_joined_ids_of_a_large_node_come_in_pieces(spark, monkeypatch):
    ends = spark.range(5000).selectExpr("7L AS hi", "8L AS lo", "id AS conv").union(spark.sql("SELECT 9L, 9L, 1L"))
    got = {r.hi: r.ends_sha256 for r in prefix_trie.ends_of(ends.repartition(6)).collect()}
    assert got == {7: hashlib.sha256(",".join(map(str, range(5000))).encode()).hexdigest(), 9: hashlib.sha256(b"1").hexdigest()}


def test_query_over_the_given_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert found(prefix_trie.op12_prefix_trie(spark, sf_dir)) == brute(map(tuple, rows))
