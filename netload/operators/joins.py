"""Equi-joins of a large fact table with a dimension.

Which plan is right depends on measured sizes and on key skew, so each
strategy is its own function and all of them return the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_UNITS = {"": 1, "b": 1, "k": 2**10, "kb": 2**10, "m": 2**20, "mb": 2**20, "g": 2**30, "gb": 2**30}
_ROW_OVERHEAD = 16


def broadcast_limit(spark: SparkSession) -> int:
    """The session's own broadcast threshold in bytes; -1 means never."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB").strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", text).groups()
    return int(number) * _UNITS[unit] if int(number) >= 0 else -1


def measured_bytes(rows: DataFrame) -> int:
    """Size of the rows in memory, by one distributed aggregate. Runs a job.

    Measured because the optimizer's figure for a derived table can be off by
    orders of magnitude (it multiplies the sizes of joined inputs).
    """
    width = F.lit(_ROW_OVERHEAD + 8 * len(rows.columns))
    for name, kind in rows.dtypes:
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0))
    return rows.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()[0]


def fits_broadcast(rows: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether the measured size is within the limit, by default the session's. Runs a job."""
    limit = broadcast_limit(rows.sparkSession) if max_bytes is None else max_bytes
    return limit >= 0 and measured_bytes(rows) <= limit


def bounded_broadcast(dimension: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """The dimension with a broadcast hint if its measured size allows, else as it is.

    Beyond the limit Spark shuffles both sides and adaptive execution splits
    skewed partitions. Runs one sizing job over the dimension.
    """
    return F.broadcast(dimension) if fits_broadcast(dimension, max_bytes) else dimension


def join_auto(fact: DataFrame, dimension: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """No hint: Catalyst and adaptive execution choose."""
    return fact.join(dimension, key, how)


def join_broadcast(
    fact: DataFrame, dimension: DataFrame, key: str, how: str = "inner", max_bytes: int | None = None
) -> DataFrame:
    """The fact table stays where it is, as long as the dimension is measured small."""
    return fact.join(bounded_broadcast(dimension, max_bytes), key, how)


def join_merge(fact: DataFrame, dimension: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Sort-merge join, for this query only: the session's settings stay untouched."""
    return fact.join(dimension.hint("merge"), key, how)


def hot_keys(fact: DataFrame, key: str, slices: int) -> DataFrame:
    """Keys with more than one ``slices``-th of the rows that have a key, and how many
    such slices (``tranches``) each fills.

    By construction there are fewer than ``slices`` keys, and fewer than twice
    ``slices`` tranches in all.
    """
    counts = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("volume"))
    total = counts.agg(F.sum("volume")).scalar()
    filled = F.ceil(F.col("volume") * slices / total).cast("int").alias("tranches")
    return counts.filter(F.col("volume") * slices > total).select(key, filled)


def join_salted(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    how: str = "inner",
    slices: int | None = None,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Shuffle join that cuts each hot key into as many parts as it fills partitions.

    For dimensions too large to broadcast. ``slices`` is the number of shuffle
    partitions to fill evenly, by default the session's. A key with a third of
    the rows spreads over a third of them; its dimension row is copied that
    often, other rows are not copied. The list of hot keys is shorter than
    ``slices``, which is what makes broadcasting it safe. The part is a hash of
    the row's own columns (``spread_by``: those that differ between rows of a
    key), so a task run again after a failure sends every row to the same place.
    """
    if how not in ("inner", "left"):
        raise ValueError("a salted join copies dimension rows, so only inner and left keep their meaning")
    if slices is None:
        slices = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(fact, key, slices))
    # A NULL key matches nothing, but in a left join its rows still need spreading.
    parts = F.when(F.col(key).isNull(), F.lit(slices)).otherwise(F.coalesce(F.col("tranches"), F.lit(1)))
    part = F.when(parts > 1, F.pmod(F.xxhash64(*(spread_by or fact.columns)), parts))
    salted_fact = fact.join(hot, key, "left").withColumn("_part", F.coalesce(part, F.lit(0)).cast("int"))
    last = F.coalesce(F.col("tranches"), F.lit(1)) - 1
    salted_dimension = dimension.join(hot, key, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), last))
    )
    joined = salted_fact.drop("tranches").join(salted_dimension.drop("tranches"), [key, "_part"], how)
    return joined.drop("_part")
