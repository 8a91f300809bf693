import random

import pytest
from pyspark.sql import functions as F

from helpers import plan, values
from netload.operators import diagnostics, joins
from netload.plans.catalog import QUERIES
from netload.sources import tables


def volumes(spark, sizes):
    return spark.createDataFrame([(f"k{i}", n) for i, n in enumerate(sizes)], "cle STRING, volume BIGINT")


def expected_profile(sizes):
    """The sorted-list rule, in plain Python."""
    ordered, n = sorted(sizes), len(sizes)
    median, ninth = ordered[n // 2], ordered[int(0.9 * n) - 1]
    return (n, sum(sizes), median, ninth, ordered[-1])


@pytest.mark.parametrize("n", [1, 2, 3, 9, 10, 11, 87, 200])
def test_profile_matches_the_sorted_list(spark, n):
    rng = random.Random(n)
    sizes = [rng.randrange(1, 30) for _ in range(n)]
    row = diagnostics.skew_profile(volumes(spark, sizes)).first()
    assert tuple(row)[:5] == expected_profile(sizes)
    assert row.rapport == row.maximum / row.mediane
    assert row.part_max == pytest.approx(100 * max(sizes) / sum(sizes))


def test_profile_of_nothing(spark):
    row = diagnostics.skew_profile(volumes(spark, [])).first()
    assert row.groupes is None and row.rapport is None



MB = 1024 * 1024


@pytest.mark.parametrize("size, skewed", [(120, False), (256, False), (400, True)])
def test_skew_rule_needs_both_conditions(spark, size, skewed):
    column = diagnostics.is_skewed(F.lit(size * MB), F.lit(2 * MB), diagnostics.SKEW_FACTOR, diagnostics.SKEW_BYTES)
    assert spark.range(1).select(column).first()[0] is skewed


def test_large_but_normal_partitions_are_not_skewed(spark):
    flags = diagnostics.skew_flags(volumes(spark, [300 * MB] * 5), "volume")
    assert not any(r.desequilibree for r in flags.collect())


def test_flags_mark_the_outlier(spark):
    flags = diagnostics.skew_flags(volumes(spark, [2 * MB] * 9 + [400 * MB]), "volume")
    assert [r.volume for r in flags.collect() if r.desequilibree] == [400 * MB]


def test_adaptive_execution_splits_what_the_rule_flags(spark, setting):
    """Lower thresholds let the built-in correction show on small data."""
    setting(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="20",
        spark__sql__adaptive__enabled="true",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    fact = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997).alias("cle"), F.xxhash64("id").alias("x")
    )
    dimension = spark.range(997).withColumnRenamed("id", "cle").withColumn("s", F.col("cle") % 7)
    joined = joins.join_merge(fact, dimension, "cle")
    assert len(joined.collect()) == 60_000
    assert "skew=true" in plan(joined)


def test_layout_report_and_estimate(spark):
    rows = spark.range(1000).select(
        F.when(F.col("id") < 900, "INFO").otherwise("WARN").alias("niveau"), (F.col("id") % 24).cast("int").alias("heure"), "id"
    )
    exact = {r.colonne: r for r in diagnostics.layout_report(rows, ["niveau", "heure", "id"]).collect()}
    assert (exact["niveau"].valeurs, exact["niveau"].lignes_moyennes, exact["niveau"].lignes_max) == (2, 500.0, 900)
    assert exact["heure"].valeurs == 24 and not exact["heure"].quasi_unique
    assert tuple(exact["id"])[1:] == (None, None, None, True)  # no partition column, so not counted
    assert diagnostics.layout_report(rows, ["id"]).count() == 1
    whole = {r.colonne: r for r in diagnostics.layout_report(rows, ["niveau", "id"], near_unique=2).collect()}
    assert (whole["id"].valeurs, whole["id"].lignes_max) == (1000, 1)
    stored = diagnostics.distinct_sketches(rows, ["heure"], ["niveau", "id"])
    from_stored = {r.colonne: r for r in diagnostics.layout_report(rows, ["niveau", "id"], sketches=stored).collect()}
    assert from_stored["id"].quasi_unique and from_stored["niveau"].lignes_max == 900
    near = {r.colonne: r.valeurs for r in diagnostics.layout_estimate(rows, ["niveau", "heure", "id"]).collect()}
    assert near["niveau"] == 2 and near["heure"] == 24 and abs(near["id"] - 1000) < 100
    assert "hashpartitioning" not in plan(diagnostics.layout_estimate(rows, ["niveau", "id"]))


def test_footprint_counts_real_bytes_without_reading_them(spark, tmp_path):
    path = tmp_path / "table"
    spark.range(100).select("id", F.when(F.col("id") < 90, "INFO").otherwise("WARN").alias("niveau")).write.partitionBy(
        "niveau"
    ).parquet(str(path))
    sizes = {}
    for level in ("INFO", "WARN"):
        files = list((path / f"niveau={level}").glob("part-*"))
        sizes[level] = (len(files), sum(f.stat().st_size for f in files))
    by_level = diagnostics.footprint(spark, str(path), "niveau")
    assert {r.niveau: (r.fichiers, r.octets) for r in by_level.collect()} == sizes
    assert "content" not in plan(by_level)
    total = sum(size for _, size in sizes.values())
    ratio = diagnostics.size_ratio(spark, str(path), str(path / "niveau=INFO")).first()
    assert (ratio.octets_avant, ratio.octets_apres) == (total, sizes["INFO"][1])
    assert ratio.facteur == total / sizes["INFO"][1]


def test_partition_sizes(spark):
    assert sum(r.lignes for r in diagnostics.partition_sizes(spark.range(0, 100, 1, 5)).collect()) == 100
    assert values(diagnostics.partition_sizes(spark.range(0, 100, 1, 5)), "partition") == [(i,) for i in range(5)]


def test_layout_report_without_screen_counts_every_column(spark):
    rows = spark.range(1000).select(
        F.when(F.col("id") < 900, F.col("id")).alias("ts"), (F.col("id") / 2).cast("int").alias("half"), F.lit("x").alias("niveau")
    )
    report = diagnostics.layout_report(rows, ["ts", "half", "niveau"], screen=False)
    assert values(report) == [
        ("half", 500, 2.0, 2, True), ("niveau", 1, 1000.0, 1000, False), ("ts", 901, 1000 / 901, 100, True),
    ]
    assert values(diagnostics.layout_report(rows, ["ts"], screen=False)) == [("ts", 901, 1000 / 901, 100, True)]


def test_layout_report_query_gives_figures_for_near_unique_columns(spark, sf_dir):
    report = {r.colonne: r for r in QUERIES["layout_report"](spark, sf_dir).collect()}
    assert set(report) == {"niveau", "heure", "cell_id", "ts"}
    assert not any(v is None for r in report.values() for v in r)
    assert report["ts"].quasi_unique and report["ts"].valeurs == tables.telemetry(spark, sf_dir).select("ts").distinct().count()


def test_layout_report_moves_no_near_unique_column(spark, sf_dir):
    report = diagnostics.layout_report(tables.telemetry(spark, sf_dir), ["niveau", "heure", "cell_id", "ts"])
    moved = [line for line in plan(report).splitlines() if "Exchange hashpartitioning" in line]
    assert "niveau#" in moved[-1] and "heure#" in moved[-1] and not any("ts#" in line for line in moved)
    assert {r.colonne: r.quasi_unique for r in report.collect()} == {"niveau": False, "heure": False, "cell_id": False, "ts": True}


def test_unions_of_stored_sketches_equal_sketches_of_the_whole(spark, sf_dir):
    telemetry = tables.telemetry(spark, sf_dir)
    stored = diagnostics.distinct_sketches(telemetry, ["niveau", "heure"], ["cell_id"])
    coarse = diagnostics.coarser_sketches(stored, ["niveau"], ["cell_id"])
    direct = diagnostics.distinct_sketches(telemetry, ["niveau"], ["cell_id"])
    exact = {r.niveau: r.n for r in telemetry.groupBy("niveau").agg(F.count_distinct("cell_id").alias("n")).collect()}
    for sketches in (coarse, direct):
        for r in diagnostics.distinct_estimates(sketches, ["niveau"], ["cell_id"]).collect():
            assert abs(r.cell_id - exact[r.niveau]) <= 0.06 * exact[r.niveau]
