"""Keeps the delivered saturation result up to date while telemetry files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from netload import schemas
from netload.operators import aggregates, caching
from netload.plans import load
from netload.sources import publication, readers, writers

# Fixed value: how often the dashboard refreshes.
REFRESH = "10 seconds"
# Below the target: raw text of refused lines, a folder for each micro-batch.
REJECTS = "rejets"


def telemetry_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """NDJSON files as they appear in a folder, with the declared schema; a bad line keeps its raw text."""
    reader = readers.declared(spark.readStream)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return readers.timed(reader.json(publication.resolve(spark, path)))


def refused_lines(spark: SparkSession, target: str) -> DataFrame:
    """``value, lot``: the lines refused so far and the micro-batch that each came in."""
    return spark.read.schema("value STRING, lot BIGINT").text(f"{target}/{REJECTS}")


def refresh_saturation(
    stream: DataFrame, cells: DataFrame, target: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Starts the refresh; with ``once`` it takes what is there and ends.

    A micro-batch is parsed once and has two outputs: its refused lines, in a folder
    named by its number, and the totals so far with its own added, one mergeable
    (sum, count) pair per cell and hour, so they grow with the cells and not with
    the events. Totals are published under the number of the batch and the result under
    the run of the totals: a batch replayed after a failure counts once, and
    completes what the first try left undone. ``checkpoint`` must lie in storage all
    executors share; a new one starts from nothing and wants a new ``target``.
    """
    totals = f"{checkpoint.rstrip('/')}/totaux"

    def take_in(batch: DataFrame, number: int) -> None:
        spark = cells.sparkSession
        columns = [*load.CELL_HOUR, "connexions_actives", schemas.CORRUPT]
        with caching.kept(batch.select(*columns), fill=False) as rows:
            refused = rows.filter(F.col(schemas.CORRUPT).isNotNull()).select(F.col(schemas.CORRUPT).alias("value"))
            refused.write.mode("overwrite").text(f"{target}/{REJECTS}/lot={number}")
            parts, before = load.connection_partials(rows), publication.current(spark, totals)
            if before:
                parts = aggregates.merged(parts.unionByName(spark.read.parquet(before)), *load.CELL_HOUR)
            publication.replace(spark, totals, parts.write.parquet, str(number))
        run = publication.current(spark, totals)
        result = load.saturated(load.rate_partials(spark.read.parquet(run), cells))
        writers.deliver(result, target, key=run.rpartition("/")[2])

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(take_in)
    trigger = {"availableNow": True} if once else {"processingTime": REFRESH}
    return writer.trigger(**trigger).start()
