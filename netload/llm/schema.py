"""What every operator here asks of a documents table, and where its files go."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netload.scratch import fresh_path

#: Documents without words still have a text; documents without a text count as empty.
DOC_COLUMNS = ("doc_id", "text")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def only_text(docs: DataFrame, null_as: str | None = "") -> DataFrame:
    """``doc_id`` and ``text`` alone: other columns can't clash with what an operator adds."""
    text = F.col("text").cast("string")
    text = text if null_as is None else F.coalesce(text, F.lit(null_as))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))


def kept(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared scratch folder and read back.

    Cuts lineage: a lost executor costs a read, not the stages before. Runs a job.
    """
    path = fresh_path(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
