"""Quantiles from mergeable sketches: a median per hour rolls up to the day, the cell or the sector.

A KLL sketch keeps a few hundred values however many it has seen. Sketches of parts
merge into the sketch of the whole, so they are stored per fine group and
combined to any coarser one; raw rows are read once and never sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netload.scratch import kept

#: Values a sketch keeps on its lowest level.
SIZE = 800
#: Rank error that a sketch of SIZE stays under in 99 of 100 cases, as a share of its rows; in proportion to 1 / size.
ERROR = 0.0035

_AGG = {
    kind: (getattr(F, f"kll_sketch_agg_{kind}"), getattr(F, f"kll_merge_agg_{kind}"), getattr(F, f"kll_sketch_get_quantile_{kind}"), getattr(F, f"kll_sketch_get_n_{kind}"))
    for kind in ("bigint", "double")
}
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def kind_of(records: DataFrame, measure: str) -> str:
    """The sketch that a measure takes: whole numbers and doubles have one each."""
    return "bigint" if dict(records.dtypes)[measure] in _WHOLE else "double"


def sketched(records: DataFrame, keys: list[str], measure: str, size: int = SIZE) -> DataFrame:
    """One ``esquisse`` of the measure per key; NULL values are not counted."""
    kind = kind_of(records, measure)
    known = records.filter(F.col(measure).isNotNull())
    return known.groupBy(*keys).agg(_AGG[kind][0](F.col(measure).cast(kind), size).alias("esquisse"))


def merged(sketches: DataFrame, *keys: str, kind: str = "bigint") -> DataFrame:
    """The sketches of each coarser group in one; any grouping of the parts is as good."""
    return sketches.groupBy(*keys).agg(_AGG[kind][1]("esquisse").alias("esquisse"))


def quantile(sketch: Column | str, rank: float | Column, kind: str = "bigint") -> Column:
    """The value that about ``rank`` of all are up to."""
    return _AGG[kind][2](sketch, F.lit(rank) if isinstance(rank, float) else rank)


def count_of(sketch: Column | str, kind: str = "bigint") -> Column:
    """How many values went in, exactly."""
    return _AGG[kind][3](sketch)


def _near(rank: float, size: int, total: str = "total") -> Column:
    """Whether the ranks from ``below`` to ``to`` come as near ``rank`` as a sketch promises."""
    error = 3 * ERROR * SIZE / size
    return (F.col("below") <= (rank + error) * F.col(total)) & (F.col("to") >= (rank - error) * F.col(total))


def rank_checked(
    records: DataFrame, estimates: DataFrame, key: str, measure: str, rank: float = 0.5, size: int = SIZE, weight: str | None = None
) -> DataFrame:
    """Per key the exact number of values, and whether ``estimate`` stands as near ``rank`` as a sketch promises (``proche``).

    An estimate holds the ranks from the share of smaller values to that of values up
    to it. Records, each counted ``weight`` times if given, are folded to one row per key and value before they meet the estimates.
    """
    counted = F.sum(weight) if weight else F.count("*")
    folded = records.filter(F.col(measure).isNotNull()).groupBy(key, F.col(measure).alias("x")).agg(counted.alias("n"))
    found = folded.join(estimates.select(key, "estimate"), key).groupBy(key).agg(
        F.sum("n").alias("mesures"),
        F.sum(F.when(F.col("x") < F.col("estimate"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("x") <= F.col("estimate"), F.col("n")).otherwise(0)).alias("to"),
    )
    return found.select(key, "mesures", _near(rank, size, "mesures").alias("proche"))


def settled(
    records: DataFrame, estimates: DataFrame, key: str, measure: str, name: str, rank: float = 0.5, size: int = SIZE
) -> DataFrame:
    """Per key the smallest value that ``rank`` of all are up to (``name``), its rows (``mesures``), and whether
    ``estimate`` stands as near ``rank`` as a sketch promises (``proche``).

    Exact: an estimate whose rank is off gives way to the value that holds it. Records are folded to
    one row per key and value; what is ordered per key is these, as in ``aggregates.median_by``.
    Estimates come in as rows of their key that count nothing, so NULL keys meet too. NULL
    measures are rows without a rank; a key that has no others has a NULL value.
    """
    folded = records.groupBy(key, F.col(measure).alias("x")).agg(F.count("*").alias("rows"), F.count(measure).alias("n"))
    together = folded.unionByName(estimates.select(key, "estimate"), allowMissingColumns=True)
    own = Window.partitionBy(key)
    placed = together.select(
        key, "x", "n", "rows",
        F.sum("n").over(own.orderBy("x").rowsBetween(Window.unboundedPreceding, 0)).alias("reached"),
        F.sum("n").over(own).alias("total"),
        F.max("estimate").over(own).alias("estimate"),
    )
    found = placed.groupBy(key).agg(
        F.min(F.when(F.col("reached") >= rank * F.col("total"), F.col("x"))).alias(name),
        F.sum("rows").alias("mesures"),
        F.sum("n").alias("total"),
        F.sum(F.when(F.col("x") < F.col("estimate"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("x") <= F.col("estimate"), F.col("n")).otherwise(0)).alias("to"),
    )
    return found.select(key, name, "mesures", _near(rank, size).alias("proche"))


def median_by_windows(records: DataFrame, key: str, measure: str, name: str, size: int = SIZE) -> DataFrame:
    """Exact median per key, the mean of the two middle values for an even count, for measures with any number of values.

    A sketch per key gives bounds around its median; a second pass counts the rows
    below them and orders only the values between them, some percent of the
    key's, folded by value. A key whose middle falls outside, which the bounds make
    rare, is taken again with wider ones, at last all values. Neither pass moves a
    raw row if the keys are few enough for Spark to broadcast their bounds; else
    the second joins on the key. Runs jobs.
    """
    kind = kind_of(records, measure)
    known = records.filter(F.col(measure).isNotNull()).select(key, F.col(measure).cast(kind).alias("x"))
    sketches = kept(sketched(known, [key], "x", size), "sketches")
    margin, done = 4 * ERROR * SIZE / size, []
    while True:
        low, high = (F.lit(max(0.0, 0.5 - margin)), F.lit(min(1.0, 0.5 + margin)))
        bounds = sketches.select(
            F.col(key).alias("_key"), quantile("esquisse", low, kind).alias("low"), quantile("esquisse", high, kind).alias("high"),
            count_of("esquisse", kind).alias("total"),
        )
        found = kept(_between(known, kept(bounds, "bounds"), key, name), "medians")
        done.append(found.filter("whole").drop("whole"))
        missed = found.filter("NOT whole").select(F.col(key).alias("_missed"))
        if margin >= 0.5 or missed.isEmpty():
            break
        sketches = kept(sketches.join(missed, F.col(key).eqNullSafe(F.col("_missed")), "left_semi"), "sketches")
        margin *= 8
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _between(known: DataFrame, bounds: DataFrame, key: str, name: str) -> DataFrame:
    """Medians of the keys in ``bounds``; not ``whole`` if a middle value lies outside the bounds."""
    rows = known.join(bounds, F.col(key).eqNullSafe(F.col("_key"))).filter("x <= high")
    inside = F.when(F.col("x") >= F.col("low"), F.col("x"))  # NULL for all rows below
    folded = rows.groupBy(key, "total", inside.alias("x")).agg(F.count("*").alias("n"))
    ordered = Window.partitionBy(key).orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    reached = folded.withColumn("reached", F.sum("n").over(ordered))
    first, second = F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1
    holds = lambda rank: F.min(F.when((F.col("reached") >= rank) & (F.col("reached") - F.col("n") < rank), F.col("x")))
    return reached.groupBy(key).agg(holds(first).alias("a"), holds(second).alias("b")).select(
        key, ((F.col("a") + F.col("b")) / 2).alias(name), (F.col("a").isNotNull() & F.col("b").isNotNull()).alias("whole")
    )
