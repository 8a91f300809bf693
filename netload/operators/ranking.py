"""Orders, top-k reports and pages. Every order ends in a unique key, so equal
scores always come out the same way."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordered(rows: DataFrame, score: str, *tie_break: str) -> DataFrame:
    """Global descending order: a range exchange, spread over all tasks."""
    return rows.orderBy(F.desc(score), *tie_break)


def top(rows: DataFrame, k: int, score: str, *tie_break: str) -> DataFrame:
    """The k best rows; each task keeps k candidates, nothing is sorted globally."""
    return ordered(rows, score, *tie_break).limit(k)


def head(rows: DataFrame, k: int) -> DataFrame:
    """Any k rows, from as few partitions as it takes."""
    return rows.limit(k)


def page(rows: DataFrame, size: int, score: str, *tie_break: str) -> DataFrame:
    """The first ``size`` rows together with the uncapped row count, in ``total``.

    Without any row the page is one of NULLs with total 0, so the answer has its total.
    """
    total = rows.agg(F.count("*").alias("total"))
    found = top(rows, size, score, *tie_break).withColumn("total", total.scalar())
    return found.unionByName(total.filter("total = 0"), allowMissingColumns=True)
