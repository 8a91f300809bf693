"""Reproducible pseudo-random columns and weighted choices.

A draw is a pure function of (seed, row id, tag), so a partition recomputed
after an executor loss gives the same rows. ``rand()`` would not.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netload.operators import prefix
from netload.scratch import kept

Draw = Callable[[str], Column]
#: Interval bounds that every row is given at once, some 200 KB in each task.
BOUNDS = 1 << 12


def uniform(row_id: Column, seed: int) -> Draw:
    """Independent draws in [0, 1), one per tag."""

    def draw(tag: str) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), row_id, F.lit(tag)), 11)
        return bits / F.lit(float(2**53))

    return draw


def index_below(u: Column, size: int | Column) -> Column:
    """Whole number in [0, size) from a draw."""
    return F.floor(u * size).cast("int")


def pick_weighted(u: Column, weights: Sequence[float]) -> Column:
    """Index of the first cumulative weight above ``u * total``, else the last.

    A chain of comparisons compiled into the scan's stage: no join and no
    lookup table, for the short weight lists known when the query is written.
    """
    x = u * sum(weights)
    reached, choice = 0, None
    for index, weight in enumerate(weights[:-1]):
        reached += weight
        choice = F.when(x < reached, index) if choice is None else choice.when(x < reached, index)
    last = len(weights) - 1
    return F.lit(last) if choice is None else choice.otherwise(last)


def cumulative_intervals(weights: DataFrame, order: str, weight: str, at_once: int = BOUNDS) -> DataFrame:
    """Adds the half-open interval ``[bas, haut)`` each category owns, for any number of categories.

    Up to ``at_once`` categories are added up in one task, more range by range. Counting them runs a job.
    """
    if weights.count() <= at_once:
        upper = F.sum(weight).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        running = weights.withColumn("haut", upper)
    else:
        running = prefix.running_total(weights, weight, order).withColumnRenamed("running", "haut")
    return running.withColumn("bas", F.col("haut") - F.col(weight))


def _first_above(bounds: Column, size: Column, x: Column) -> Column:
    """Index of the first of the sorted ``bounds`` (field ``haut``) above x, by halving; the last if there is none."""

    def halved(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        left = (x < F.get(bounds, middle)["haut"]) | (state["low"] >= state["high"])
        return F.struct(
            F.when(left, state["low"]).otherwise(middle + 1).alias("low"), F.when(left, middle).otherwise(state["high"]).alias("high")
        )

    steps = F.sequence(F.lit(0), F.ceil(F.log2(size + 1)).cast("int"))
    found = F.aggregate(steps, F.struct(F.lit(0).alias("low"), size.alias("high")), halved, lambda state: state["low"])
    return F.least(found, size - 1)


def pick_from_intervals(
    rows: DataFrame, intervals: DataFrame, label: str, x: str, name: str, at_once: int = BOUNDS
) -> DataFrame:
    """Adds the label whose interval holds column ``x``; beyond the last bound, the last label.

    Up to ``at_once`` bounds reach every row as one scalar-subquery array, searched by
    halving. More are cut into that many runs of neighbours: the first search finds
    the run, an equi-join brings its bounds, a second search ends it. No comparison
    join either way, and a category with a third of all draws is a skewed key
    that adaptive execution splits. Counting the intervals runs a job.
    """
    bound = F.struct(F.col("haut"), F.col("bas"), F.col(label).alias("choix"))
    n = intervals.count()
    if n <= at_once:
        bounds = intervals.agg(F.array_sort(F.collect_list(bound)).alias("b")).scalar()
        rows = rows.withColumn("_bornes", bounds)
        found = F.get("_bornes", _first_above(F.col("_bornes"), F.size("_bornes"), F.col(x)))["choix"]
        return rows.withColumn(name, found).drop("_bornes")
    ordered = prefix.numbered(intervals.select(bound.alias("b")), "b")
    runs = ordered.groupBy(F.floor(F.col("pos") / -(-n // at_once)).cast("int").alias("_run"))
    runs = kept(runs.agg(F.array_sort(F.collect_list("b")).alias("_bornes")), "runs")
    last = F.struct(F.element_at("_bornes", -1)["haut"].alias("haut"), F.col("_run"))
    rows = rows.withColumn("_tops", runs.agg(F.array_sort(F.collect_list(last))).scalar())
    run = F.get("_tops", _first_above(F.col("_tops"), F.size("_tops"), F.col(x)))["_run"]
    joined = rows.withColumn("_run", run).drop("_tops").join(runs, "_run")
    found = F.get("_bornes", _first_above(F.col("_bornes"), F.size("_bornes"), F.col(x)))["choix"]
    return joined.withColumn(name, found).drop("_run", "_bornes")
