"""Quality rules by weak supervision: rules vote or abstain, their accuracies are estimated, not assumed.

Each rule votes good, bad or not at all on one measured property of a text.
Expectation-maximisation over the histogram of vote patterns (at most 3 to the
number of rules, whatever the corpus size) estimates how often each rule casts
each vote on good and on bad texts. A document's verdict is the posterior
probability of being good.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from netload.llm.schema import documents, kept, only_text
from netload.llm.wordhash import gram_starts, range_hashes, slices, text_bytes, words

#: Rule: property, then (good below, bad above) or, where more is better, (good above, bad below).
RULES = {
    "symbols": ("symbol_share", 0.02, 0.10),
    "odd_words": ("odd_share", 0.15, 0.40),
    "repeats": ("repeat_share", 0.15, 0.35),
    "top_word": ("top_share", 0.20, 0.35),
    "lines": ("dup_line_share", 0.05, 0.30),
    "capitals": ("capital_share", 0.15, 0.30),
    "sentences": ("words_per_stop", 60.0, 120.0),
    "length": ("n_words", 60.0, 50.0),
}
VOTES = "bag"  # bad, abstains, good

_PROPERTIES = ["symbol_share", "odd_share", "repeat_share", "top_share", "dup_line_share", "capital_share", "words_per_stop"]
_BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_FIELDS = ", ".join([f"{c} bigint" for c in _BASE] + [f"{c} double" for c in _PROPERTIES])
_KIND = f"struct<{_FIELDS.replace(' bigint', ': bigint').replace(' double', ': double')}>"


def _mark(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(chars)] = 1
    return out


_SYMBOL, _STOP = _mark(b"#*$%&|<>"), _mark(b".!?")
_UPPER, _LOWER = _mark(bytes(range(65, 91))), _mark(bytes(range(97, 123)))
_TRAIL = _mark(bytes(range(0x80, 0xC0)))
_ODD = _mark(bytes(set(range(33, 127)) - set(range(65, 91)) - set(range(97, 123)) - set(b".,;:?!'\"()-")))


def _per_text(values: np.ndarray, where: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[where[1:]] - total[where[:-1]]


def _run_lengths(text: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorting order by (text, code), and for each sorted element how often its code stands in its text."""
    order = np.lexsort((code, text))
    new = np.append(True, (np.diff(text[order]) != 0) | (code[order][1:] != code[order][:-1]))[: len(order)]
    run = np.cumsum(new) - 1
    return order, np.bincount(run)[run] if len(run) else run


def _measure(texts: pa.Array) -> dict[str, np.ndarray]:
    data, where = text_bytes(texts)
    found = words(texts)
    n, codes = len(texts), found.hashes()
    word_text = np.repeat(np.arange(n), found.counts)

    text, at = gram_starts(found.first, 3)
    order, times = _run_lengths(text, range_hashes(codes, at, at + 3))
    covered = np.zeros(len(codes), bool)
    for j in range(3):
        covered[at[order[times > 1]] + j] = True

    _, same = _run_lengths(word_text, codes)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, word_text, same)  # sorting by text leaves the text column as it is

    ends = np.flatnonzero(data == 10)
    begin = np.unique(np.concatenate([where[:-1], ends + 1]))
    begin = begin[begin < len(data)]
    stop = np.append(begin[1:], len(data))
    stop = np.where((stop > begin) & (data[stop - 1] == 10), stop - 1, stop)
    line_words = np.searchsorted(found.starts, stop) - np.searchsorted(found.starts, begin)
    full = np.flatnonzero(line_words)
    line_text = np.searchsorted(where, begin[full], "right") - 1
    line_code = range_hashes(data.astype(np.uint64) + np.uint64(1), begin[full], stop[full])
    lines = np.bincount(line_text, minlength=n)
    order, times = _run_lengths(line_text, line_code)
    distinct = np.bincount(line_text[order], weights=1 / np.maximum(times, 1), minlength=n)
    dup_lines = lines - np.rint(distinct).astype(np.int64)

    bangs = np.zeros(len(data), np.int64)
    bangs[1:] = (data[1:] == 33) & (data[:-1] == 33)
    odd = np.concatenate([[0], np.cumsum(_ODD[data] + bangs)])
    odd_words = _per_text((odd[found.ends] - odd[found.starts] > 0).astype(np.int64), found.first)
    count = found.counts.astype(np.int64)
    upper, lower = _per_text(_UPPER[data], where), _per_text(_LOWER[data], where)
    n_symbols = _per_text(_SYMBOL[data], where)
    repeat_words = _per_text(covered.astype(np.int64), found.first)
    some = np.maximum(count, 1)
    return {
        "n_words": count, "n_symbols": n_symbols, "n_dup_lines": dup_lines, "n_repeat_words": repeat_words,
        "word_chars": np.diff(where) - _per_text(_TRAIL[data], where) - _per_text(_mark(b" \t\n\x0b\x0c\r")[data], where),
        "symbol_share": n_symbols / some, "odd_share": odd_words / some, "repeat_share": repeat_words / some,
        "top_share": top / some, "dup_line_share": dup_lines / np.maximum(lines, 1),
        "capital_share": upper / np.maximum(upper + lower, 1),
        "words_per_stop": count / (_per_text(_STOP[data], where) + 1),
    }


def _properties(texts: pa.Array) -> pa.Array:
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    found = [_measure(part.column(0)) for part in slices(batch, "text")] or [_measure(texts)]
    whole = {k: np.concatenate([f[k] for f in found]) for k in found[0]}
    return pa.StructArray.from_arrays([pa.array(whole[k]) for k in _BASE + _PROPERTIES], names=_BASE + _PROPERTIES)


def properties(text: Column) -> Column:
    """What the rules look at, as one struct."""
    return F.arrow_udf(_properties, _KIND)(text)


def _votes(found: Column) -> Column:
    """One letter per rule."""
    letters = []
    for name, good, bad in RULES.values():
        value = found.getField(name)
        is_good, is_bad = (value <= good, value > bad) if good < bad else (value >= good, value < bad)
        letters.append(F.when(is_bad, "b").when(is_good, "g").otherwise("a"))
    return F.concat(*letters)


@dataclass
class Model:
    """Log odds of good: before any vote, and what each rule's vote adds."""

    prior: float
    odds: np.ndarray  # rule x vote
    rates: np.ndarray  # class x rule x vote

    def posterior(self, votes: Column) -> Column:
        total = F.lit(self.prior)
        for i, row in enumerate(self.odds):
            letter = F.substring(votes, i + 1, 1)
            total = total + F.when(letter == "b", float(row[0])).when(letter == "a", float(row[1])).otherwise(float(row[2]))
        return 1 / (1 + F.exp(-total))


def fit(patterns: dict[str, int], rounds: int = 200) -> Model:
    """Expectation-maximisation from the counts of vote patterns.

    A few documents' worth of prior belief (a good text seldom gets a bad vote)
    names the classes, so they can't swap, and defines the model on no data.
    """
    keys = sorted(patterns)
    counts = np.array([patterns[k] for k in keys], float)
    cast = np.array([[VOTES.index(c) for c in k] for k in keys], int).reshape(len(keys), len(RULES))
    hot = np.eye(3)[cast]
    belief = 10 * np.stack([np.tile([0.4, 0.1, 0.5], (len(RULES), 1)), np.tile([0.02, 0.08, 0.9], (len(RULES), 1))])
    share, rates = np.array([0.2, 0.8]), belief / belief.sum(2, keepdims=True)
    for _ in range(rounds):
        log = np.log(share) + np.einsum("prv,crv->pc", hot, np.log(rates))
        post = np.exp(log - log.max(1, keepdims=True))
        post = post / post.sum(1, keepdims=True) * counts[:, None]
        new = (post.sum(0) + [2, 8]) / (post.sum() + 10)
        rates = np.einsum("pc,prv->crv", post, hot) + belief
        rates /= rates.sum(2, keepdims=True)
        if np.abs(new - share).max() < 1e-9:
            break
        share = new
    return Model(float(np.log(share[1] / share[0])), np.log(rates[1] / rates[0]), rates)


def _base_failed(found: Column) -> Column:
    n = found.getField("n_words")
    return (n < 50) | (100 * found.getField("n_repeat_words") > 50 * n)


def _fitted(votes: DataFrame) -> Model:
    return fit({r["votes"]: r["n"] for r in votes.groupBy("votes").agg(F.count("*").alias("n")).collect()})


def judged(docs: DataFrame) -> DataFrame:
    """One row per document: what was measured, votes, posterior and verdict.

    Null, empty and blank texts have no words and fail the base rule. Repeated
    rows are judged alike, each in its own row; a null doc_id stays null. An empty
    table gives no rows. A text of any length is measured whole, in one task. Other columns of ``docs`` are ignored. Runs one job that
    measures all texts and writes the measures to the scratch folder.
    """
    found = only_text(docs).select("doc_id", properties(F.col("text")).alias("found"))
    found = kept(found.withColumn("votes", _votes(F.col("found"))), "measures")
    good = _fitted(found).posterior(F.col("votes"))
    failed = _base_failed(F.col("found"))
    return found.select(
        "doc_id", *[F.col(f"found.{c}").alias(c) for c in _BASE], failed.alias("base_failed"), "votes",
        good.alias("posterior"), (~failed & (good >= 0.5)).alias("kept"),
    )


def _measured_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole rows with what was measured of their texts."""
    for batch in batches:
        for part in slices(batch, "text"):
            yield pa.RecordBatch.from_arrays([part.column("row"), _properties(part.column("text"))], names=["row", "found"])


def good_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    Null, empty and blank texts fail the base rule; repeated rows are judged alike;
    a null doc_id changes nothing; an empty table stays empty; a text of any length is measured whole. Measures
    each text once: rows and measures are written to the scratch folder, and what is kept
    is read from there. No row is shuffled.
    """
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kinds = StructType([rows.schema["row"], StructField("found", StructType.fromDDL(_FIELDS))])
    rows = kept(rows.mapInArrow(_measured_rows, kinds), "measured")
    good = _fitted(rows.select(_votes(F.col("found")).alias("votes"))).posterior(_votes(F.col("found")))
    return rows.filter(~_base_failed(F.col("found")) & (good >= 0.5)).select("row.*")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(documents(spark, sf_dir))
