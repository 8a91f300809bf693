"""Tables laid out by a join key once, so that later joins on it move no row."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from netload.scratch import fresh_path


def bucketed(rows: DataFrame, key: str, name: str, buckets: int | None = None) -> DataFrame:
    """The rows as a table in ``buckets`` sorted by ``key``, by default one for each shuffle partition. Runs a job.

    Two such tables with equally many buckets join on their keys, and each aggregates by its key,
    without an exchange. The write shuffles by the key itself, one file to a bucket, so it pays
    from the second use on. The files lie in the scratch folder; the session's catalog
    gets a table of a new name (``netload_<name>_...``), which the caller may drop.
    """
    spark = rows.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"netload_{name}_{uuid.uuid4().hex}"
    spread = rows.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
    spread.option("path", fresh_path(spark, name)).saveAsTable(table)
    return spark.table(table)
