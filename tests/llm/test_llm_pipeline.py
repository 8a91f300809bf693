"""The pipeline against plain Python, stage by stage, on one small table."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
from llm_cases import documents, low, words
from tokenizers import Tokenizer

import corpus_pipeline
from netload.llm import quality_rules


def prose(draw, n):
    text = []
    while len(text) < n:
        text += [draw.choice("abcdefghij") + draw.choice("klmnopqr") * draw.randint(1, 3) + str(draw.randint(0, 99))[:0] + draw.choice("stuvwxyz") for _ in range(9)]
        text[-1] += "."
    return " ".join(text[:n])


def table():
    draw = random.Random(5)
    passage = prose(draw, 60)
    texts = [(i, prose(draw, draw.randint(80, 160))) for i in range(30)]
    texts += [(100 + i, texts[i][1] + " tail") for i in range(6)]  # near copies
    texts += [(200 + i, texts[20 + i][1]) for i in range(3)]  # exact copies
    texts += [(300 + i, prose(draw, 90) + " " + passage + " " + prose(draw, 90)) for i in range(5)]
    texts += [(400, "### $$$ " * 60), (401, "too short"), (402, None), (403, ""), (404, "same words here " * 80)]
    return texts


def components(texts):
    sets = {i: {tuple(w[k : k + 5]) for w in [words(low(t))] for k in range(len(w) - 4)} for i, t in texts}
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    return root


def without_repeats(texts, size):
    own = {i: words(t) for i, t in texts}
    times = Counter(tuple(w[k : k + size]) for w in own.values() for k in range(len(w) - size + 1))
    out = {}
    for i, w in own.items():
        gone = {j for k in range(len(w) - size + 1) if times[tuple(w[k : k + size])] > 1 for j in range(k, k + size)}
        out[i] = " ".join(x for j, x in enumerate(w) if j not in gone)
    return out


def test_every_stage_equals_plain_python(spark, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "substring dedup", "packing"]
    folder = str(tmp_path)
    documents(spark, table()).drop("m").write.parquet(f"{folder}/documents.parquet")
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        found = stage(spark, docs, folder)
        if k < 3:
            assert found.dtypes == docs.dtypes
        found.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        seen.append(docs)
    source = documents(spark, table())
    kept = {r.doc_id for r in quality_rules.judged(source).filter("kept").collect()}
    good = [(i, t) for i, t in table() if i in kept]
    assert not kept & {400, 401, 402, 403, 404} and set(range(30)) <= kept
    assert {r.doc_id for r in seen[0].collect()} == kept
    root = components(good)
    one = [(i, t) for i, t in good if root[i] == i]
    assert sorted((r.doc_id, r.text) for r in seen[1].collect()) == one
    assert not {i for i, _ in one} & {100, 101, 102, 103, 104, 105, 200, 201, 202}
    cut = without_repeats(one, 35)
    assert {r.doc_id: r.text for r in seen[2].collect()} == cut
    assert all(len(words(cut[300 + i])) == 180 for i in range(5) if 300 + i in cut)

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    packed = [seen[3].collect(), corpus_pipeline.run(spark, folder).collect()]
    for rows in packed:
        for i, text in cut.items():
            pieces = sorted((r.start, r.ids) for r in rows if r.doc_id == i)
            ids = np.frombuffer(b"".join(p for _, p in pieces), np.uint32).tolist()
            assert ids == library.encode(text, add_special_tokens=False).ids + [1]
        assert {r.doc_id for r in rows} == set(cut)
