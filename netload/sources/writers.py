"""Sinks. Each call runs a job, and replaces what stood at its path only when the job is done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netload import schemas
from netload.sources import publication, readers


def write_lines(lines: DataFrame, path: str) -> None:
    publication.replace(lines.sparkSession, path, lines.write.text)


def write_ndjson(records: DataFrame, path: str) -> None:
    """One JSON object per line; NULL fields are left out."""
    publication.replace(records.sparkSession, path, records.write.json)


def append_ndjson(records: DataFrame, path: str) -> None:
    """Adds files to what stands at the path; a stream that follows it sees them."""
    records.write.mode("append").json(publication.resolve(records.sparkSession, path))


def write_telemetry(records: DataFrame, path: str, compact: bool = True, folders: tuple[str, ...] = ("niveau",)) -> None:
    """Parquet partitioned by ``niveau``; ``records`` already carry ts and heure.

    A rebalance evens out file sizes: unlike a plain repartition by level, it splits
    the level that holds nine rows in ten over many tasks. The splitting is adaptive
    execution's, so leave that on. Without ``compact`` rows do not move: each task
    writes at most one file per level.
    """
    rows = records.hint("rebalance", *folders) if compact else records
    publication.replace(records.sparkSession, path, rows.write.partitionBy(*folders).parquet)


def ndjson_to_parquet(spark: SparkSession, source: str, target: str, compact: bool = True) -> None:
    """Telemetry text to the Parquet table, row for row, in one pass over the source.

    A line the parser refused stays a row with NULL for what it could not read, so
    counts match the source, and keeps its raw text. Such rows lie in a folder of their own
    of the same write: ``read_telemetry`` reads all rows without the raw text,
    ``read_rejects`` the raw text alone.
    """
    rows = readers.timed(readers.read_ndjson(spark, source))
    refused = F.col(schemas.CORRUPT).isNotNull().cast("int")
    write_telemetry(rows.withColumn(schemas.REFUSED, refused), target, compact, (schemas.REFUSED, "niveau"))


def deliver(saturated: DataFrame, path: str, key: str | None = None) -> bool:
    """The seven contract columns as JSON lines, published when they are complete.

    The range-partitioned sort of the input fixes both the row order inside files and
    the order of the part files. A ``key`` that is published already is not delivered
    again: False then.
    """
    columns = saturated.select(*schemas.names(schemas.SATURATION))
    return publication.replace(saturated.sparkSession, path, columns.write.json, key)


def publish_cells(cells: DataFrame, path: str, private: tuple[str, ...] = ("_pression",)) -> None:
    """The cell dimension as JSON lines without its private columns."""
    publication.replace(cells.sparkSession, path, cells.drop(*private).write.json)
