"""Bag union and distinct members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def appended(rows: DataFrame, more: DataFrame) -> DataFrame:
    """Both inputs, duplicates kept; the inputs themselves never change."""
    return rows.unionByName(more)


def is_even(value: Column) -> Column:
    return value % 2 == 0


def double_of(value: Column) -> Column:
    return value * 2


def even(rows: DataFrame, column: str) -> DataFrame:
    return rows.filter(is_even(F.col(column)))


def doubled(rows: DataFrame, column: str) -> DataFrame:
    return rows.withColumn(column, double_of(F.col(column)))


def series(rows: DataFrame, column: str, **values: Column) -> DataFrame:
    """Rows of (serie, column): each named value of each row, where it is not NULL, from one pass over the rows."""
    named = [F.struct(F.lit(name).alias("serie"), value.alias(column)) for name, value in values.items()]
    return rows.select(F.inline(F.array(*named))).filter(F.col(column).isNotNull())


def members(rows: DataFrame, group: str, member: str) -> DataFrame:
    """Distinct (group, member) pairs."""
    return rows.select(group, member).distinct()
