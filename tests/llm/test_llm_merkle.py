"""The Merkle manifest against a plain tree, and its proofs against tampering."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from llm_cases import documents, odd_texts

from netload.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    fields = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row.doc_id, row.source, row.lang, row.n_chars, text)]
    return h(*fields)


def with_proofs(nodes):
    """The root, and for each node its siblings and places on the way."""
    proofs, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for k, i in enumerate(at):
            run = level[i // 3 * 3 : i // 3 * 3 + 3]
            proofs[k].append((i % 3, run[: i % 3] + run[i % 3 + 1 :]))
            at[k] = i // 3
        level = [h(*level[i : i + 3]) for i in range(0, len(level), 3)]
    return level[0], proofs


def brute(rows):
    sources = defaultdict(list)
    for r in rows:
        sources[r.source].append((r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text), r))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        own = sorted(sources[s], key=lambda x: x[:3])
        trees.append((own, *with_proofs([x[2] for x in own])))
    root, tops = with_proofs([t[1] for t in trees])
    out = []
    for (own, subroot, proofs), top in zip(trees, tops):
        for (_, _, leaf, r), proof in zip(own, proofs):
            way = proof + top
            even = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
            x = leaf_of(r, r.text.replace("\n", "")) if even and r.text is not None else leaf
            for place, others in way:
                x = h(*others[:place], x, *others[place:])
            out.append((r.doc_id, leaf, subroot, root, h(*[s for _, o in way for s in o]), x, x == root))
    return sorted(out, key=repr)


def found(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.mark.parametrize("step", [1, 2, 6])
def test_equals_a_plain_tree(spark, step):
    draw = random.Random(step)
    texts = [(draw.randint(-50, 500), "a\nb" * draw.randint(0, 3)) for _ in range(130)] + odd_texts() + odd_texts()
    docs = documents(spark, texts)
    got = found(merkle.manifest(docs, step))
    assert got == brute(docs.collect())
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_many_sources_and_one_row(spark):
    rows = [(i, "t\n", None, f"s{i}", i) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    assert found(merkle.manifest(docs)) == brute(docs.collect())
    one = docs.limit(1)
    assert found(merkle.manifest(one)) == brute(one.collect())


def test_empty_table(spark):
    none = merkle.manifest(documents(spark, odd_texts()).limit(0))
    assert none.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert none.count() == 0


def test_no_task_holds_a_whole_source(spark):
    leaves = spark.range(20_000).selectExpr("0L AS tree", "id AS idx", "20000L AS n", "unhex(sha2(string(id), 256)) AS node")
    grouped = merkle._grouped(leaves.repartition(8), 6)
    sizes = [r["count"] for r in grouped.groupBy("tree", "at").count().collect()]
    assert max(sizes) == 729 and len(sizes) == 28


def test_query_over_the_given_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert found(merkle.op13_merkle_manifest(spark, sf_dir)) == brute(docs.collect())
