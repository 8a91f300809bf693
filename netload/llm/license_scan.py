"""License scans by a positional rare-token index.

Templates are licence texts, and sentences by which licenses are given. The index holds each template's
words of the highest inverse document frequency, taken over all files, with their
places. Every word of a file is looked up in it by one join; hits that agree on where a template begins
are added up, weighted by that frequency. A template is a candidate where one
beginning has at least half of its weight, and found if its key phrases stand
in the file: only candidates' phrases are ever searched, so the work per text does not grow with
the number of templates, but with the hits of their rare words.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from math import log
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netload.llm.schema import documents, kept, only_text
from netload.operators.joins import bounded_broadcast

#: Phrases and labels that always count.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Label, sentence, and the phrases a file must have. Words as the scan sees them.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0", ("apache license",)),
    ("gpl", "licensed under the gnu general public license version", ("gnu general public license",)),
    ("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    ("agpl", "licensed under the gnu affero general public license", ("gnu affero general public license",)),
    ("cc-by", "licensed under cc by 4 0", ("cc by",)),
    ("cc-by", "licensed under a creative commons attribution license", ("creative commons attribution",)),
    ("cc0", "released under the creative commons cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
            " documentation files", ("permission is hereby granted", "free of charge")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that"
            " the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
            " granted", ("with or without fee is hereby granted",)),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", ("mozilla public license",)),
    ("epl", "made available under the terms of the eclipse public license", ("eclipse public license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    ("no-warranty", "the software is provided as is without warranty of any kind express or implied",
     ("without warranty of any kind",)),
    ("reserved", "copyright all rights reserved", ("all rights reserved",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
            " documentation files the software to deal in the software without restriction including without limitation the rights"
            " to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to"
            " whom the software is furnished to do so subject to the following conditions the above copyright notice and this"
            " permission notice shall be included in all copies or substantial portions of the software",
     ("permission is hereby granted", "sublicense and or sell copies")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
            " granted provided that the above copyright notice and this permission notice appear in all copies the software is"
            " provided as is and the author disclaims all warranties with regard to this software",
     ("with or without fee is hereby granted", "the author disclaims all warranties")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that"
            " the following conditions are met redistributions of source code must retain the above copyright notice this list of"
            " conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this"
            " list of conditions and the following disclaimer in the documentation and or other materials provided with the"
            " distribution", ("redistributions of source code must retain", "redistributions in binary form must reproduce")),
)

#: Words of a template that the index holds: those of the highest inverse document frequency.
RAREST = 12
#: ... and at least this share of the highest one's: a common word says nothing of a template, and stands everywhere.
RARE = 0.25
#: Candidates up to this measured size go to the texts; more meet them in a shuffle.
CANDIDATE_BYTES = 32 << 20
#: Share of a template's weight that must agree on one beginning.
LEAST = 0.5


def normal(text: Column) -> Column:
    """Words in lower case with one blank between: runs of ASCII letters and digits and of all other characters beyond ASCII."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")  # no other letters
    return F.trim(F.regexp_replace(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def _has(body: Column, phrase: str) -> Column:
    return F.contains(body, F.lit(phrase)) & F.contains(F.concat(F.lit(" "), body, F.lit(" ")), F.lit(f" {phrase} "))


def _places(body: Column, phrase: str) -> Column:
    """Where the phrase starts, words counted from 0."""
    parts = phrase.split()

    def among(words: Column) -> Column:
        here = lambda i: reduce(and_, (F.get(words, i + j) == p for j, p in enumerate(parts)))
        return F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)

    return F.get(F.transform(F.array(F.split(body, " ")), among), F.lit(0))  # the text is cut into words once


def _table(spark: SparkSession, rows: list[dict], kind: str) -> DataFrame:
    """Rows from one literal, so that no Python runs where they are read."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{kind}>>")))


def _index(spark: SparkSession, templates: Sequence, weights: dict[str, float]) -> DataFrame:
    """``word, template, place, weight, whole``: whole is the weight of the template's rarest words."""
    rows = []
    for t, (_, sentence, _) in enumerate(templates):
        words = sentence.split()
        rarest = sorted(set(words), key=lambda w: (-weights[w], w))[:RAREST]
        rarest = {w for w in rarest if weights[w] >= RARE * weights[rarest[0]]}
        whole = sum(weights[w] for w in words if w in rarest)
        rows += [dict(word=w, template=t, place=i, weight=weights[w], whole=whole) for i, w in enumerate(words) if w in rarest]
    return _table(spark, rows, "word: string, template: int, place: int, weight: double, whole: double")


def _weights(bodies: DataFrame, templates: Sequence) -> dict[str, float]:
    """Inverse document frequency, over all files, of each word of the templates."""
    vocabulary = sorted({w for _, sentence, _ in templates for w in sentence.split()})
    listed = _table(bodies.sparkSession, [dict(word=w) for w in vocabulary], "word: string")
    held = bodies.select(F.explode(F.array_distinct(F.split("body", " "))).alias("word"))
    counted = held.join(F.broadcast(listed), "word").groupBy("word").count()  # bounded by the templates, like what is collected
    files, times = bodies.count(), {r["word"]: r["count"] for r in counted.collect()}
    return {w: log((files + 1) / (times.get(w, 0) + 0.5)) for w in vocabulary}


def candidates(bodies: DataFrame, index: DataFrame) -> DataFrame:
    """``row, template, start, share``: the best beginning of each template with at least LEAST of its weight, the earliest of equal ones."""
    hits = bodies.select("row", F.posexplode(F.split("body", " ")).alias("i", "word"))
    begun = hits.join(F.broadcast(index), "word")  # bounded by the templates
    begun = begun.groupBy("row", "template", (F.col("i") - F.col("place")).alias("start")).agg(
        F.least(F.lit(1.0), F.sum("weight") / F.first("whole")).alias("share")
    )
    best = begun.filter(F.col("share") >= LEAST).groupBy("row", "template").agg(F.max(F.struct("share", -F.col("start"))).alias("best"))
    return best.select("row", "template", (-F.col("best.col2")).alias("start"), "best.share")


def scanned(docs: DataFrame, templates: Sequence = TEMPLATES) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, found``.

    ``templates`` are (label, words, key phrases), some ten thousand at most: their index goes to every task.
    ``found`` lists those found as (label, start in words, share of the weight). Base
    phrases count wherever they stand. The score is the largest share, or 0.5 if there are
    base phrases alone, else 0. Null, empty and blank texts have no words, empty labels,
    null places and score 0. Repeated rows and null doc_ids come back as they are; a text of any length
    counts whole. An empty table gives no rows. Other columns are ignored. Runs jobs: the
    words of the texts are written to the scratch folder, then weighted.
    """
    spark = docs.sparkSession
    body = normal(F.col("text"))
    bodies = kept(only_text(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", body.alias("body")), "bodies")
    full = bodies.filter("body <> ''")
    index = _index(spark, templates, _weights(full, templates))
    keys = _table(spark, [dict(template=t, label=x[0], keys=x[2]) for t, x in enumerate(templates)], "template: int, label: string, keys: array<string>")
    marked = F.concat(F.lit(" "), F.col("body"), F.lit(" "))
    held = kept(candidates(full, index), "candidates").join(F.broadcast(keys), "template")
    verified = full.select("row", "body").join(bounded_broadcast(held, CANDIDATE_BYTES), "row")
    verified = verified.filter(F.forall("keys", lambda k: F.contains(marked, F.concat(F.lit(" "), k, F.lit(" ")))))
    found = verified.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("label", "start", "share"))).alias("found"))

    spaces = F.length("body") - F.length(F.replace("body", F.lit(" "), F.lit("")))
    places = [F.when(_has(F.col("body"), p), _places(F.col("body"), p)).otherwise(F.array().cast("array<int>")) for p in BASE]
    based = [F.when(_has(F.col("body"), p), F.lit(label)) for p, label in BASE.items()]
    rows = bodies.select(
        "row", "doc_id", F.when(F.col("body") == "", 0).otherwise(spaces + 1).cast("bigint").alias("n_words"),
        F.concat(*places).alias("places"), F.array_sort(F.array_compact(F.array(*based))).alias("base"),
    ).join(found, "row", "left").withColumn("found", F.coalesce("found", F.array().cast(found.schema["found"].dataType)))
    label_list = F.array_sort(F.array_union(F.col("base"), F.transform("found", lambda x: x["label"])))
    share = F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0))
    score = F.least(F.lit(1.0), F.greatest(share, F.when(F.size("base") > 0, 0.5).otherwise(0.0)))
    return rows.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places").cast("bigint").alias("first_word"), F.array_max("places").cast("bigint").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"), F.array_join(label_list, ",").alias("labels"), score.alias("score"), "found",
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(documents(spark, sf_dir))
