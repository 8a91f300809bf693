"""Reports about the data's shape: key skew, shuffle volume, storage layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netload.sources import publication, readers

# A group is an outlier when it exceeds both.
SKEW_FACTOR = 5.0
SKEW_BYTES = 256 * 1024 * 1024


def volume_by_key(records: DataFrame, key: str) -> DataFrame:
    return records.groupBy(key).agg(F.count("*").alias("volume"))


def skew_profile(volumes: DataFrame, volume: str = "volume") -> DataFrame:
    """One row: groups, total, median, p90, max, max/median ratio, heaviest group's share.

    Ranks follow the sorted list: median is element ``n div 2`` counted from 0,
    p90 element ``floor(0.9 n) - 1`` (the only one when n = 1).

    Ranks are read from a histogram of the volumes. With N rows in total there
    are at most sqrt(2 N) distinct volumes, so the ordered step, the only one
    in a single task, stays small however many keys there are.
    """
    histogram = volumes.groupBy(F.col(volume).alias("v")).agg(F.count("*").alias("k"))
    ordered = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = histogram.select(
        "v", "k", F.sum("k").over(ordered).alias("rang"), F.sum("k").over(Window.partitionBy()).alias("n")
    )
    middle = F.floor(F.col("n") / 2) + 1
    ninth = F.greatest(F.floor(F.col("n") * 9 / 10), F.lit(1))
    first_reaching = lambda rank: F.min(F.when(F.col("rang") >= rank, F.col("v")))
    return ranked.agg(
        F.sum("k").alias("groupes"),
        F.sum(F.col("v") * F.col("k")).alias("total"),
        first_reaching(middle).alias("mediane"),
        first_reaching(ninth).alias("p90"),
        F.max("v").alias("maximum"),
    ).withColumns(
        {
            "rapport": F.try_divide(F.col("maximum"), F.col("mediane")),
            "part_max": F.try_divide(100 * F.col("maximum"), F.col("total")),
        }
    )


def is_skewed(size: Column, median: Column, factor: float, threshold: int) -> Column:
    """An outlier among the groups: far above the median, and large in itself. Both strict."""
    return (size > median * factor) & (size > threshold)


def skew_flags(
    volumes: DataFrame, size: str = "octets", factor: float = SKEW_FACTOR, threshold: int = SKEW_BYTES
) -> DataFrame:
    """Each group with the median size and whether it is an outlier."""
    median = skew_profile(volumes, size).select("mediane").scalar()
    return volumes.withColumn("mediane", median).withColumn(
        "desequilibree", is_skewed(F.col(size), F.col("mediane"), factor, threshold)
    )


def partition_sizes(rows: DataFrame) -> DataFrame:
    """Rows in each partition as it stands."""
    return rows.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("lignes"))


def _sketchable(name: str, kind: str) -> Column:
    """The column as a type that distinct sketches take, equal values staying equal."""
    if kind in ("int", "bigint", "string", "binary"):
        return F.col(name)
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(name).cast("timestamp"))
    return F.col(name).cast("bigint" if kind in ("tinyint", "smallint", "boolean", "date") else "string")


def distinct_sketches(records: DataFrame, grain: list[str], candidates: list[str]) -> DataFrame:
    """Rows (``lignes``) and a mergeable sketch of the distinct values of each candidate, per group of the grain."""
    kinds = dict(records.dtypes)
    sketches = [F.hll_sketch_agg(_sketchable(c, kinds[c])).alias(f"{c}_esquisse") for c in candidates]
    return records.groupBy(*grain).agg(F.count("*").alias("lignes"), *sketches)


def coarser_sketches(sketches: DataFrame, keys: list[str], candidates: list[str]) -> DataFrame:
    """Stored sketches combined to any coarser grain, without the records."""
    unions = [F.hll_union_agg(f"{c}_esquisse").alias(f"{c}_esquisse") for c in candidates]
    return sketches.groupBy(*keys).agg(F.sum("lignes").alias("lignes"), *unions)


def distinct_estimates(sketches: DataFrame, keys: list[str], candidates: list[str]) -> DataFrame:
    """Keys, ``lignes``, and per candidate the estimated number of distinct values, as columns."""
    return sketches.select(*keys, "lignes", *[F.hll_sketch_estimate(f"{c}_esquisse").alias(c) for c in candidates])


def layout_report(
    records: DataFrame, candidates: list[str], near_unique: float = 0.5, sketches: DataFrame | None = None, screen: bool = True
) -> DataFrame:
    """For each candidate partition column: folders it would make, mean and largest
    rows per folder, and whether it has a value for every other row or more (``near_unique``).

    Exact, in the columns' own types, folded per value before any row moves. Such a column (``quasi_unique``) is no
    partition column, and its fold moves most rows. With ``screen``, sketches tell it from one pass that
    moves a sketch per task, or from stored ones, and it is listed without figures; this runs
    a job. Without, every column has its figures, and ``quasi_unique`` follows from them.
    """
    if not screen:
        report = _folders(records, candidates)
        return report.withColumn("quasi_unique", F.col("valeurs") >= near_unique * F.col("lignes")).drop("lignes")
    whole = distinct_sketches(records, [], candidates) if sketches is None else coarser_sketches(sketches, [], candidates)
    found = distinct_estimates(whole, [], candidates).first()
    apart = [c for c in candidates if found[c] and found[c] >= near_unique * found["lignes"]]
    exact = [c for c in candidates if c not in apart]
    columns = "colonne STRING, valeurs BIGINT, lignes_moyennes DOUBLE, lignes_max BIGINT, quasi_unique BOOLEAN"
    screened = records.sparkSession.createDataFrame([(c, None, None, None, True) for c in apart], columns)
    if not exact:
        return screened
    report = _folders(records, exact).drop("lignes")
    return report.withColumn("quasi_unique", F.lit(False)).unionByName(screened)


def _folders(records: DataFrame, columns: list[str]) -> DataFrame:
    """Per column its values, mean and largest rows per value, and all rows (``lignes``); NULL is a value."""
    per_value = records.groupingSets([[c] for c in columns], *columns).agg(
        F.count("*").alias("lignes"), F.coalesce(*[F.when(F.grouping(c) == 0, F.lit(c)) for c in columns]).alias("colonne")
    )
    return per_value.groupBy("colonne").agg(
        F.count("*").alias("valeurs"),
        F.try_divide(F.sum("lignes"), F.count("*")).alias("lignes_moyennes"),
        F.max("lignes").alias("lignes_max"),
        F.sum("lignes").alias("lignes"),
    )


def layout_estimate(records: DataFrame, candidates: list[str], error: float = 0.02) -> DataFrame:
    """Folders per candidate column from mergeable sketches: one pass, nothing to shuffle.

    The cheap form for near-unique columns such as a timestamp.
    """
    sketches = [F.approx_count_distinct(c, error).alias(c) for c in candidates]
    row = records.agg(F.count("*").alias("lignes"), *sketches)
    return row.unpivot(["lignes"], candidates, "colonne", "valeurs").select(
        "colonne", "valeurs", F.try_divide(F.col("lignes"), F.col("valeurs")).alias("lignes_moyennes")
    )


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file below ``path``: name, length, modification time.

    Comes from the file listing alone: without its ``content`` column this
    source opens no file. Partition folders appear as columns. Of a path that runs are
    published under, the run published last counts.
    """
    return spark.read.format("binaryFile").load(publication.resolve(spark, path)).drop("content")


def footprint(spark: SparkSession, path: str, by: str | None = None) -> DataFrame:
    """Files and bytes below ``path``, in total or per value of a partition column."""
    files = stored_files(spark, path)
    return files.groupBy(*([by] if by else [])).agg(
        F.count("*").alias("fichiers"), F.coalesce(F.sum("length"), F.lit(0)).alias("octets")
    )


def size_ratio(spark: SparkSession, larger: str, smaller: str) -> DataFrame:
    """Bytes under both paths and their ratio, one row."""
    left = footprint(spark, larger).select(F.col("octets").alias("octets_avant"))
    right = footprint(spark, smaller).select("octets").scalar()
    return left.withColumn("octets_apres", right).withColumn(
        "facteur", F.try_divide(F.col("octets_avant"), F.col("octets_apres"))
    )


def freshness(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Row count of a delivered result and when its newest file was written, one row."""
    updated = stored_files(spark, readers.result_path(spark, path)).agg(F.max("modificationTime")).scalar()
    return rows.agg(F.count("*").alias("alertes")).withColumn("derniere_maj", updated)
