"""Proportional stratified interleaving: shards that all match the mixture of sources.

Within each source rows are ranked in the order of a seeded hash. Rank r of n rows
stands at the fraction (r + 1/2) / n, so sorting everything by fraction spreads
each source evenly over the whole order, and consecutive cuts of that order all
hold the sources in proportion. Cuts differ by at most one row.

Neither rank needs a group per source or one global sort: rows are laid out in ranges
of the order, and a row's rank is its place in its range and the sizes of the ranges before.
A source, a fraction or a key that many rows share lies over several ranges like any other rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netload.llm.schema import documents, kept
from netload.operators.prefix import numbered


def interleaved(docs: DataFrame, shards: int, source: str = "source", key: str = "doc_id", seed: int = 0) -> DataFrame:
    """``source_row, shard, slot``: each row of ``docs`` as a struct, its shard and its place there from 0.

    The order within a source is that of a hash of ``key`` and the seed, then of a
    hash of the whole row (but for columns with maps), so rows that tie are alike.
    A null source is a source of its own; null or repeated keys are placed like any
    other. Shards hold N/shards rows, rounded down or up; with fewer rows than shards
    some stay empty, an empty table gives no rows. A text of any length is one row. Runs jobs: rows are
    counted, and written to the scratch folder in either order.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    n = docs.count()
    whole = [c for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    rows = docs.select(
        F.struct("*").alias("source_row"), F.col(source).alias("source"),
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 1).alias("hash"),
        F.xxhash64(F.lit(seed + 1), *whole).alias("tie"),
    )
    rows = numbered(rows, "source", "hash", "tie").withColumnRenamed("pos", "at")
    sources = rows.groupBy(F.col("source").alias("of")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    rows = rows.join(sources, F.col("source").eqNullSafe(F.col("of")))
    rows = rows.withColumn("fraction", (F.col("at") - F.col("first") + 0.5) / F.col("n")).drop("at", "of", "first", "n")
    rows = numbered(rows, "fraction", "hash", "tie", "source").withColumnRenamed("pos", "rank")
    shard = F.expr(f"rank * {shards} div {max(n, 1)}")
    slot = F.expr(f"rank - (shard * {n} + {shards - 1}) div {shards}")
    return rows.withColumn("shard", shard).select("source_row", F.col("shard").cast("int").alias("shard"), slot.alias("slot"))


def write_shards(docs: DataFrame, shards: int, path: str, **options) -> None:
    """Writes ``docs`` as Parquet under ``path/shard=0`` and so on, each shard in the order of its slots over one or more files."""
    rows = interleaved(docs, shards, **options).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    rows.select("shard", "slot", F.col("source_row").alias("row")).write.partitionBy("shard").parquet(path)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = documents(spark, sf_dir).select(
        "doc_id", "source", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32")
    )
    rows = interleaved(kept(narrow, "sizes"), 24)
    return rows.select(
        "source_row.doc_id", "source_row.size", "source_row.text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source_row.source",
    )
