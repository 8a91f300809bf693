"""From raw documents to packed training sequences, in four stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from netload.llm.ngram_join import one_of_each
from netload.llm.packing import packed
from netload.llm.quality_rules import good_documents
from netload.llm.substring_dedup import cut_documents
from netload.scratch import fresh_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the weighed rules keep."""
    return good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, a similarity of 0.8 or more."""
    return one_of_each(docs, size=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words under windows of 35 words that repeat."""
    return cut_documents(docs, size=35)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in sequences of 2048."""
    import public_tokenizers

    return packed(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("packing", packing),
]

#: Fitted rules, hashed word windows and a tokenizer file are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        found = stage(spark, docs, sf_dir)
        if i + 1 == len(STAGES):
            return found
        path = fresh_path(spark, f"stage-{i}")
        found.write.parquet(path)
        docs = spark.read.parquet(path)
