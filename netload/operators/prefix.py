"""Positions and running totals over a global order, without one task that sees all rows.

Rows are range-partitioned by the order and written once. What stands before a
range is a sum over the ranges before it (one row each); what stands before a row
within its range is known to that range's own task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from netload.scratch import kept

#: ``monotonically_increasing_id`` numbers the rows of a partition in the bits below this one.
_ROW_BITS = 33


def laid_out(rows: DataFrame, *order: str | Column) -> DataFrame:
    """The rows in ranges of ``order``, written and read back, with ``part`` and ``row``: range and place in it.

    Rows equal in ``order`` stand as they were read, and may lie in several
    ranges, so one very frequent key doesn't fill one task. Runs a job.
    """
    keys = [*order, "_tie"]
    laid = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id()
    laid = laid.drop("_tie").withColumn("part", F.shiftright(place, _ROW_BITS).cast("int"))
    return kept(laid.withColumn("row", place.bitwiseAND((1 << _ROW_BITS) - 1)), "ranges")


def before_parts(totals: DataFrame, value: str) -> DataFrame:
    """``part, before``: the sum of ``value`` over all earlier parts; ``totals`` has one row for each part."""
    earlier = F.sum(value).over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    return totals.select("part", F.coalesce(earlier, F.lit(0)).alias("before"))


def numbered(rows: DataFrame, *order: str | Column) -> DataFrame:
    """The rows with ``pos``, their place from 0 in the whole order. Nulls stand first unless ``order`` says otherwise."""
    laid = laid_out(rows, *order)
    before = before_parts(laid.groupBy("part").agg(F.count("*").alias("n")), "n")
    found = laid.join(F.broadcast(before), "part")  # a row for each partition
    return found.withColumn("pos", F.col("before") + F.col("row")).drop("part", "row", "before")


def running_total(rows: DataFrame, value: str, *order: str | Column) -> DataFrame:
    """The rows with ``running``: the sum of ``value`` up to and with the row, in the whole order."""
    laid = laid_out(rows, *order)
    before = before_parts(laid.groupBy("part").agg(F.sum(value).alias("n")), "n")
    within = F.sum(value).over(W.partitionBy("part").orderBy("row").rowsBetween(W.unboundedPreceding, 0))
    found = laid.withColumn("_within", within).join(F.broadcast(before), "part")
    return found.withColumn("running", F.col("before") + F.col("_within")).drop("part", "row", "before", "_within")
