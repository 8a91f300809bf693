"""Per-key aggregates. All use partial aggregation: a hot key reaches its
reducer as one row per map task, never as its raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netload.functions import rates


def count_by(records: DataFrame, *keys: str, name: str = "evenements") -> DataFrame:
    return records.groupBy(*keys).agg(F.count("*").alias(name))


def mean_by(records: DataFrame, key: str, measure: str, name: str) -> DataFrame:
    return records.groupBy(key).agg(F.avg(measure).alias(name))


def partials(records: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Mergeable ``(somme, nombre)`` of the measure per key."""
    return records.groupBy(*keys).agg(F.sum(measure).alias("somme"), F.count(measure).alias("nombre"))


def merged(parts: DataFrame, *keys: str) -> DataFrame:
    """Combines partials of the same key; any grouping of the parts gives the same pair."""
    return parts.groupBy(*keys).agg(F.sum("somme").alias("somme"), F.sum("nombre").alias("nombre"))


def finished(parts: DataFrame, name: str) -> DataFrame:
    """Replaces the pair by its mean, the only division of the whole computation."""
    mean = rates.mean_of(F.col("somme"), F.col("nombre")).alias(name)
    return parts.select(*[c for c in parts.columns if c not in ("somme", "nombre")], mean)


def max_by_key(records: DataFrame, key: str, measure: str, name: str) -> DataFrame:
    return records.groupBy(key).agg(F.max(measure).alias(name))


def count_where(records: DataFrame, key: str, condition: Column, name: str) -> DataFrame:
    """Rows per key that meet the condition; a key without any shows 0."""
    return records.groupBy(key).agg(F.count_if(condition).alias(name))


def stddev_by(records: DataFrame, key: str, measure: str, name: str) -> DataFrame:
    """Sample standard deviation, from mergeable moments."""
    return records.groupBy(key).agg(F.stddev_samp(measure).alias(name))


def _folded(records: DataFrame, key: str, measure: str) -> DataFrame:
    """Rows as (key, value x, count n); one row per distinct value of a key."""
    known = records.filter(F.col(measure).isNotNull())
    return known.groupBy(key, F.col(measure).alias("x")).agg(F.count("*").alias("n"))


def _middle_ranks(total: Column) -> tuple[Column, Column]:
    """Ranks, from 1, of the two values a median averages; equal for an odd total."""
    return F.floor((total + 1) / 2), F.floor(total / 2) + 1


def median_by(records: DataFrame, key: str, measure: str, name: str) -> DataFrame:
    """Exact median per key, the mean of the two middle values for an even count.

    Not mergeable, so it first folds rows into (key, value, count). What is
    ordered per key is the distinct values (milliseconds: a few thousand),
    not the rows: a key with a third of all rows stays small. For measures
    with many distinct values use ``quantiles.median_by_windows``.
    """
    ordered = Window.partitionBy(key).orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = _folded(records, key, measure).select(
        key,
        "x",
        F.sum("n").over(ordered).alias("dernier"),
        F.sum("n").over(Window.partitionBy(key)).alias("total"),
    )
    low, high = _middle_ranks(F.col("total"))
    first_reaching = lambda rank: F.min(F.when(F.col("dernier") >= rank, F.col("x")))
    return ranked.groupBy(key).agg(((first_reaching(low) + first_reaching(high)) / 2).alias(name))


def approx_median_by(records: DataFrame, key: str, measure: str, name: str, accuracy: int = 10000) -> DataFrame:
    """One-pass median with a mergeable sketch, for measures with unbounded distinct values."""
    return records.groupBy(key).agg(F.percentile_approx(measure, 0.5, accuracy).alias(name))


def shares(counts: DataFrame, volume: str, name: str = "part") -> DataFrame:
    """Each group's percentage of the grand total.

    The total is a scalar subquery: a window without partitions would pull all
    groups into one task.
    """
    total = counts.agg(F.sum(volume)).scalar()
    return counts.withColumn(name, F.try_divide(100 * F.col(volume), total))


def count_into(records: DataFrame, key: str, partitions: int, name: str = "evenements") -> DataFrame:
    """Count per key delivered in a chosen number of hash partitions.

    The counts are repartitioned, not the records: repartitioning first would
    ship every raw row and put the hot key's in one task.
    """
    return count_by(records, key, name=name).repartition(partitions, key)
