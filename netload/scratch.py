"""Where queries that write a table put it."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A temporary folder stands in only when the setting is absent *and* the
    master is local, where driver and tasks share one disk. On a cluster a
    missing setting is an error: executors could not see each other's files.
    """
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{_SETTING} must name a folder all executors share")
    return _local_folder()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="netload-")


def _own_folder(spark: SparkSession) -> str:
    """What this application writes lies below one folder of its own."""
    return f"{scratch_root(spark)}/netload-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under the scratch root; never reused, so no run sees another's files."""
    return f"{_own_folder(spark)}/{uuid.uuid4().hex}/{name}"


def clear(spark: SparkSession) -> None:
    """Deletes all that this application wrote to the scratch folder.

    Lazy results still read it: call this when they have been written or collected.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def kept(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared scratch folder and read back. Runs a job."""
    path = fresh_path(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
