"""Quality rules, near copies, substring dedup, packing, sharding, LM scores and license scans against plain Python."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import documents, low, odd_texts, sentence, words

from netload.llm import lattice_lm, license_scan, ngram_join, packing, quality_rules, sharding, substring_dedup


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, odd_texts())


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def rows(frame, *columns):
    return sorted(map(tuple, frame.select(*columns).collect()), key=repr)


# quality rules

def measured(text):
    text = text or ""
    own = words(text)
    times = Counter(tuple(own[i : i + 3]) for i in range(len(own) - 2))
    covered = set()
    for i in range(len(own) - 2):
        if times[tuple(own[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = Counter(line for line in text.split("\n") if words(line))
    return (
        len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), sum(lines.values()) - len(lines), len(covered),
        len(own) < 50 or 100 * len(covered) > 50 * len(own),
    )


def test_rules_measure_like_plain_python(spark, odd, none):
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = rows(quality_rules.judged(odd), "doc_id", *columns)
    assert got == sorted(((i, *measured(t)) for i, t in odd_texts()), key=repr)
    assert quality_rules.judged(none).count() == quality_rules.good_documents(none).count() == 0
    kept = quality_rules.good_documents(odd)
    assert kept.dtypes == odd.dtypes
    assert rows(kept, "doc_id") == rows(quality_rules.judged(odd).filter("kept"), "doc_id")


def test_expectation_maximisation_finds_the_reliable_rules():
    good, bad = "g" * 8, "b" * 4 + "g" * 4
    model = quality_rules.fit({good: 900, bad: 90, "gggggggb": 50})
    assert (model.odds[:4, 0] < model.odds[4:, 0].max()).all()
    assert quality_rules.fit({}).prior > 0  # no data: the prior belief


# near copies

def brute_components(texts, size, percent):
    sets = []
    for _, text in texts:
        own = words(low(text))
        sets.append({tuple(own[i : i + size]) for i in range(len(own) - size + 1)} or ({tuple(own)} if own else set()))
    root = list(range(len(sets)))
    for _ in sets:  # to a fixed point
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= percent * len(x | y):
                    root[a] = root[b] = min(root[a], root[b])
    members = {}
    for i, r in enumerate(root):
        members.setdefault(r, []).append(texts[i][0])
    out = []
    for i, (doc_id, _) in enumerate(texts):
        ids = [m for m in members[root[i]] if m is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=repr)


def near_texts():
    base = [f"t{i}" for i in range(60)]
    texts = odd_texts()
    for k in range(12):  # a chain: neighbours are near, ends are not
        texts.append((100 + k, " ".join([f"c{k}{j}" for j in range(k)] + base[k:] + [f"e{j}" for j in range(k)])))
    for k in range(40):  # a group of near copies, and texts that share a passage alone
        texts.append((200 + k, " ".join(base[:k] + ["NEW"] + base[k + 1 :])))
        texts.append((300 + k, sentence(30, 1000 * k + 500) + " " + " ".join(base[:25]) + " " + sentence(30, 1000 * k + 900)))
    return texts


@pytest.mark.parametrize("hot", [ngram_join.HOT, 8])
@pytest.mark.parametrize(("size", "percent", "least"), [(4, 85, 32), (5, 80, 2)])
def test_components_equal_brute_force(spark, monkeypatch, size, percent, least, hot):
    monkeypatch.setattr(ngram_join, "FREQUENT_LEAST", least)
    monkeypatch.setattr(ngram_join, "HOT", hot)
    monkeypatch.setattr(ngram_join, "GROUP_SETS", 16)  # groups are cut into blocks
    texts = near_texts()
    got = rows(ngram_join.near_copies(documents(spark, texts), size, percent), "doc_id", "n_shingles", "component_id")
    assert got == brute_components(texts, size, percent)


def test_one_of_each_keeps_columns_and_the_smallest_id(spark, odd, none):
    kept = ngram_join.one_of_each(odd)
    assert kept.dtypes == odd.dtypes
    assert rows(kept, "doc_id") == sorted([(i,) for i in (1, 2, 3, 4, 6, 8, 9, 10, -3, None, None)], key=repr)
    assert ngram_join.one_of_each(none).count() == ngram_join.near_copies(none).count() == 0
    with pytest.raises(ValueError, match="percent"):
        ngram_join.near_copies(none, percent=50)


def test_one_of_each_whatever_the_ids(spark):
    a, b, c, d = (sentence(100, k) for k in (0, 1000, 2000, 3000))
    texts = [
        (1, a), (None, a), (None, a + " tail"),  # rows without an id beside one with an id
        (None, b), (None, b), (None, b + " tail"),  # none has an id
        (2, c), (1, c + " tail"), (1, c),  # an id that heads another component
        (7, d), (7, d + " tail"), (7, d), (None, None), (None, ""), (None, None),
    ]
    got = [(r.doc_id, r.text) for r in ngram_join.one_of_each(documents(spark, texts)).collect()]
    heads = [(i, (t or "").removesuffix(" tail")) for i, t in got if words(t)]
    assert sorted(heads, key=repr) == sorted([(1, a), (None, b), (1, c), (7, d)], key=repr)
    assert set(got) <= set(texts) and [t for _, t in got if not words(t)].count(None) == 2 and (None, "") in got


# substring dedup

def test_repeated_windows_equal_brute_force(spark, odd, none):
    texts = odd_texts() + [(20, sentence(40) + " between " + sentence(40)), (21, "same " * 50), (22, sentence(50, 7))]
    size = 12
    windows = Counter(tuple(w[i : i + size]) for _, t in texts for w in [words(t)] for i in range(len(w) - size + 1))
    want = []
    for doc_id, text in texts:
        own = words(text)
        gone = set()
        for i in range(len(own) - size + 1):
            if windows[tuple(own[i : i + size])] > 1:
                gone |= set(range(i, i + size))
        want.append((doc_id, len(own), len(gone), " ".join(w for i, w in enumerate(own) if i not in gone)))
    cut = substring_dedup.without_repeats(documents(spark, texts), size)
    assert rows(cut, "source_row.doc_id", "cut.n_words", "cut.n_removed", "cut.text") == sorted(want, key=repr)
    assert substring_dedup.cut_documents(odd, size).dtypes == odd.dtypes
    assert substring_dedup.cut_documents(none).count() == 0


# packing

def test_pieces_cover_each_document_once(spark, odd, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = [(i, t) for i, t in odd_texts() if i not in (None, 5)]
    found = packing.packed(documents(spark, texts), path, capacity=64, with_ids=True).collect()
    by_doc, by_sequence = {}, {}
    for r in found:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    for doc_id, text in texts:
        pieces = sorted(by_doc[doc_id], key=lambda r: r.start)
        ids = np.frombuffer(b"".join(r.ids for r in pieces), np.uint32).tolist()
        assert ids == library.encode(text or "", add_special_tokens=False).ids + [1]
        assert [r.start for r in pieces] == [sum(p.length for p in pieces[:i]) for i in range(len(pieces))]
        assert {r.doc_tokens for r in pieces} == {len(ids)}
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [sum(p.length for p in pieces[:i]) for i in range(len(pieces))]
        assert sum(r.length for r in pieces) <= 64
    assert len(packing.packed(odd, path).collect()) >= odd.count()
    assert packing.packed(none, path).count() == 0
    joined = packing.sequences(documents(spark, texts), path, capacity=64).collect()
    assert sorted(len(r.ids) // 4 for r in joined) == sorted(sum(p.length for p in s) for s in by_sequence.values())


@pytest.mark.parametrize("capacity", [1, 2, 64, 2048])
def test_cuts_waste_little(capacity):
    for n in range(1, 3 * capacity + 2):
        cuts = packing.cut_lengths(n, capacity)
        assert sum(cuts) == n and min(cuts) > 0
        for piece in cuts:
            assert (capacity - capacity // piece * piece) * packing.TOLERANCE <= capacity or capacity // (capacity // piece) == piece


# sharding

def test_shards_hold_every_source_in_proportion(spark, none):
    texts = [(i, "t") for i in range(998)] + [(5, "t"), (None, "t")]
    docs = documents(spark, texts)
    found = sharding.interleaved(docs, 7).select("source_row.doc_id", "source_row.source", "shard", "slot").collect()
    assert sorted((r.doc_id for r in found), key=repr) == sorted((i for i, _ in texts), key=repr)
    sizes = Counter(r.shard for r in found)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(n))
    for source in {r.source for r in found}:
        share = Counter(r.shard for r in found if r.source == source)
        assert max(share.values()) - min(share.values()) <= 3
    again = sharding.interleaved(docs.repartition(9), 7).select("source_row.doc_id", "shard", "slot")
    assert rows(again, "doc_id", "shard", "slot") == sorted(((r.doc_id, r.shard, r.slot) for r in found), key=repr)
    assert sharding.interleaved(none, 7).count() == 0
    assert sorted(r.slot for r in sharding.interleaved(docs.limit(3), 7).collect()) == [0, 0, 0]


def test_written_shards_hold_the_rows(spark, tmp_path):
    docs = documents(spark, [(i, f"t{i}") for i in range(50)]).drop("m")
    sharding.write_shards(docs, 4, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows(back, "row.doc_id", "row.text") == rows(docs, "doc_id", "text")
    assert back.select("shard").distinct().count() == 4


# LM scores

def test_scores_equal_a_plain_forward_recursion(spark, none):
    import public_tokenizers
    from pyspark.sql import functions as F

    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = odd_texts()
    held = F.col("doc_id") % 3 == 0
    counts = Counter()
    for i, t in texts:
        if i is None or i % 3:
            counts.update([*words(low(t)), ""])
    total, distinct = sum(counts.values()), len(counts)
    table = spark.createDataFrame([(w.encode(), n) for w, n in counts.items()], "word BINARY, n BIGINT")
    pieces, end = lattice_lm.fitted(table, path)
    log = dict(zip(pieces.names, pieces.logs))
    assert sum(math.exp(x) for x in pieces.logs) + math.exp(end) == pytest.approx(1)

    def marginal(word):
        word = b" " + word.encode()
        reach = [0.0]
        for j in range(1, len(word) + 1):
            ways = [reach[i] + log[word[i:j]] for i in range(max(0, j - pieces.longest), j) if word[i:j] in log]
            most = max(ways)
            reach.append(most + math.log(sum(math.exp(w - most) for w in ways)))
        return reach[-1]

    want = []
    for i, t in texts:
        own = [*words(low(t)), ""]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
        score = (sum(marginal(w) for w in own[:-1]) + end) / math.log(10)
        want.append((i, i is not None and i % 3 == 0, len(own), sum(w in counts for w in own), total, base, score))
    found = lattice_lm.scored(documents(spark, texts), held, path).collect()
    key = lambda r: (repr(r[0]), r[5])
    for a, b in zip(sorted(map(tuple, found), key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-6)
    assert lattice_lm.scored(none, held, path).count() == 0
    untrained = lattice_lm.scored(documents(spark, [(3, "one two")]), held, path).first()
    assert (untrained.n_known, untrained.train_tokens) == (0, 0) and untrained.score < 0


def test_expected_counts_add_up_to_the_segmentations():
    names = [b" ", b"a", b"b", b"ab", b" a"]
    pieces = lattice_lm.Pieces(names, np.log([0.2] * 5))
    lattice = lattice_lm._Lattice(pieces, np.frombuffer(b" ab", np.uint8), np.array([3]))
    ways = [0.2**3, 0.2**2, 0.2**2]  # " "+a+b, " "+ab, " a"+b
    assert lattice.forward()[1][0] == pytest.approx(math.log(sum(ways)))
    share = np.array(ways) / sum(ways)
    want = [share[0] + share[1], share[0], share[0] + share[2], share[1], share[2]]
    assert lattice.expected(np.array([10.0])) == pytest.approx(10 * np.array(want))


# license scans

def test_base_places_and_templates(spark, odd, none):
    texts = [
        (1, "CC-BY and cc by\nCC: BY"), (2, "Licensed under the Apache License, Version 2.0."), (3, "general Public\tlicense all rights reserved"),
        (4, "accby general publiclicense"), (5, "The MIT license is mentioned elsewhere"), (6, None), (7, "  "),
        (8, "x " * 300 + "This work is licensed under the GNU General Public License, version 3."),
    ] + [(100 + i, "the plain text of a file") for i in range(60)]
    found = {r.doc_id: r for r in license_scan.scanned(documents(spark, texts)).collect()}
    got = {i: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for i, r in found.items()}
    assert got[1] == (7, 3, 0, 5, "cc-by")
    assert got[3] == (6, 2, 0, 3, "gpl,reserved")
    assert got[4] == (3, 0, None, None, "")
    assert got[6] == got[7] == (0, 0, None, None, "")
    assert (found[2].labels, found[2].n_base) == ("apache", 0) and found[2].score > 0.9
    assert found[5].labels in ("", "mit") and found[100].labels == ""
    assert found[8].labels == "gpl" and found[8].found[0].start == 303
    assert license_scan.scanned(odd).count() == odd.count() and license_scan.scanned(none).count() == 0
    assert "Python" not in license_scan.scanned(odd)._jdf.queryExecution().executedPlan().toString()


def test_files_of_several_licences_lose_none(spark):
    mit = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
        ' files (the "Software"), to deal in the Software without restriction. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF'
        " ANY KIND, EXPRESS OR IMPLIED, including but not limited to the warranties of merchantability."
    )
    bsd = (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
        " conditions are met: redistributions of source code must retain the above copyright notice."
    )
    apache = "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance."
    every = [sentence for _, sentence, _ in license_scan.TEMPLATES[:16]]
    texts = [(1, mit), (2, f"{mit}\n\n{bsd}"), (3, f"{apache}\n{mit}\n{bsd}"), (4, "\n".join(every))]
    texts += [(100 + i, "the plain text of a file and the use of it") for i in range(60)]
    found = {r.doc_id: r for r in license_scan.scanned(documents(spark, texts)).collect()}
    assert [found[i].labels for i in (1, 2, 3)] == ["mit,no-warranty", "bsd,mit,no-warranty", "apache,bsd,mit,no-warranty"]
    assert all(max(f.share for f in found[i].found if f.label == label) == pytest.approx(1) for i in (1, 2, 3) for label in ("mit", "no-warranty"))
    starts = np.cumsum([0] + [len(s.split()) for s in every])
    want = {(label, int(at)) for (label, *_), at in zip(license_scan.TEMPLATES[:16], starts)}
    assert want <= {(f.label, f.start) for f in found[4].found}


def test_a_whole_licence_text_is_found_where_it_stands(spark):
    whole = license_scan.TEMPLATES[-1][1]
    texts = [(1, "x " * 40 + whole), (2, " ".join(whole.split()[::-1])), (3, whole.replace("must retain", "may retain"))]
    texts += [(10 + i, "the list of conditions and the use of source code") for i in range(40)]
    found = {r.doc_id: r for r in license_scan.scanned(documents(spark, texts)).collect()}
    assert ("bsd", 40) in {(f.label, f.start) for f in found[1].found} and found[2].labels == ""
    assert not any(f.share > 0.9 and f.label == "bsd" and len(found[3].found) > 1 for f in found[3].found)


def test_thousands_of_templates_search_no_phrase_in_every_text(spark):
    templates = [(f"t{i}", f"this text is under terms number{i} of the maker{i % 70} and rules{i % 90}", (f"terms number{i}",)) for i in range(3000)]
    texts = [(i, f"file {i} this text is under terms number{i * 11} of the maker{i * 11 % 70} and rules{i * 11 % 90} end") for i in range(200)]
    texts += [(1000, "this text is under terms of the maker1 and rules1 number5"), (1001, "terms number7")]
    frame = license_scan.scanned(documents(spark, texts), templates)
    found = {r.doc_id: r for r in frame.collect()}
    assert [found[i].labels for i in range(200)] == [f"t{i * 11}" for i in range(200)]
    assert found[1000].labels == found[1001].labels == ""
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert text.count("number2999") <= 4 and "Python" not in text  # in the index and key tables alone, however many texts


def test_digest_of_whole_words(spark, sf_dir):
    first = substring_dedup.op6_substring_dedup(spark, sf_dir).orderBy("doc_id").first()
    assert len(first.kept_sha256) == len(hashlib.sha256(b"").hexdigest())
