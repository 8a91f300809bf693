"""Scans: text lines, NDJSON, the cell dimension, the Parquet table, a delivered result.

A path is a plain file or folder, or one that a sink of ``writers`` publishes its
runs under; then the run published last is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netload import schemas
from netload.functions import moments
from netload.sources import publication


class ResultNotReady(FileNotFoundError):
    """Nothing has been published at the path."""


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(publication.resolve(spark, path))


def read_ndjson_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Schema found by an extra pass over the whole input; columns come back in name order."""
    return spark.read.json(publication.resolve(spark, path))


def declared(reader):
    """A batch or stream reader of NDJSON with the declared schema that keeps bad lines raw."""
    reader = reader.schema(schemas.with_rejects(schemas.TELEMETRY)).option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", schemas.CORRUPT)


def read_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """Declared schema, one pass. Bad lines stay, raw, in ``_corrupt_record``.

    Spark refuses a query on raw JSON that uses that column alone; select a
    data column with it.
    """
    return declared(spark.read).json(publication.resolve(spark, path))


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CELL).json(publication.resolve(spark, path))


def read_telemetry(spark: SparkSession, path: str) -> DataFrame:
    """The level-partitioned Parquet table; ``niveau`` comes from the directory names."""
    return spark.read.parquet(publication.resolve(spark, path)).drop(schemas.CORRUPT, schemas.REFUSED)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Raw text of the lines that the conversion to the table refused; reads their folder alone."""
    rows = spark.read.parquet(publication.resolve(spark, path))
    return rows.filter(F.col(schemas.REFUSED) == 1).select(F.col(schemas.CORRUPT).alias("value"))


def timed(records: DataFrame) -> DataFrame:
    """Text timestamps to TIMESTAMP, plus the UTC hour; bad text gives NULL in both."""
    stamped = records.withColumn("ts", moments.instant(F.col("ts")))
    return stamped.withColumn("heure", moments.utc_hour(F.col("ts")))


def register(records: DataFrame, name: str = "telemetrie") -> None:
    """Names the table for SQL in the caller's session."""
    records.createOrReplaceTempView(name)


def result_path(spark: SparkSession, path: str) -> str:
    """The folder of the run that was published last."""
    run = publication.current(spark, path)
    if run is None:
        raise ResultNotReady(f"no published result at {path}; run the delivery first")
    return run


def read_result(spark: SparkSession, path: str) -> DataFrame:
    """The result published last, highest rate first.

    Spark itself joins the part files and skips markers and blank lines. A run is named
    after it is complete, so a reader never takes half a write for the whole result.
    """
    rows = spark.read.schema(schemas.SATURATION).json(result_path(spark, path))
    return rows.orderBy(F.desc("taux_charge"), "cell_id", "heure")
