import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import plan, values
from netload.operators import aggregates, quantiles, caching, diagnostics, filters
from netload.plans import catalog, incidents
from netload.sources import tables


def latencies(spark, rows):
    return spark.createDataFrame(rows, "cell_id STRING, latence_ms BIGINT")


def test_mean_of_four_from_two_partitions(spark):
    rows = latencies(spark, [("c", 40), ("c", 80), ("c", 30), ("c", 50)]).repartition(2)
    assert values(aggregates.mean_by(rows, "cell_id", "latence_ms", "m")) == [("c", 50.0)]


def test_combining_partials(spark):
    parts = spark.createDataFrame([("c", 120, 2), ("c", 30, 1)], "cell_id STRING, somme BIGINT, nombre BIGINT")
    assert values(aggregates.merged(parts, "cell_id")) == [("c", 150, 3)]


def test_partials_are_not_a_mean_of_means(spark):
    rows = spark.createDataFrame(
        [("c", 0, 10), ("c", 1, 20), ("c", 1, 30), ("c", 1, 40)], "cell_id STRING, heure INT, latence_ms BIGINT"
    )
    assert values(incidents.mean_latency_from_hours(rows)) == [("c", 25.0)]


def test_group_of_nulls_has_a_null_mean(spark):
    rows = latencies(spark, [("c", None), ("d", 4), ("d", None)])
    parts = aggregates.partials(rows, ["cell_id"], "latence_ms")
    assert dict(values(aggregates.finished(parts, "m"))) == {"c": None, "d": 4.0}


def test_four_ways_to_the_same_mean(spark, sf_dir):
    rows = tables.telemetry(spark, sf_dir)
    declared = values(aggregates.mean_by(rows, "cell_id", "latence_ms", "m"))
    rolled_up = values(incidents.mean_latency_from_hours(rows))
    # Every value of a key in one list: an equivalence check on small data only.
    listed = rows.groupBy("cell_id").agg(F.collect_list("latence_ms").alias("v"))
    total = F.aggregate("v", F.lit(0).cast("bigint"), lambda a, x: a + x)
    from_lists = values(listed.select("cell_id", total / F.size("v")))
    pairs = rows.select("cell_id", "latence_ms").rdd.map(lambda r: (r[0], (r[1], 1)))
    reduced = pairs.reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1])).mapValues(lambda s: s[0] / s[1])
    assert declared == rolled_up == from_lists == sorted(reduced.collect(), key=repr)


def test_whole_record_and_projected_counts_agree(spark, sf_dir):
    rows = tables.telemetry(spark, sf_dir)
    whole = rows.rdd.map(lambda r: (r.cell_id, tuple(r))).groupByKey().mapValues(len).collect()
    assert sorted(whole) == values(aggregates.count_by(rows, "cell_id"))
    assert "ReadSchema: struct<user_id:bigint,props:string>" in plan(aggregates.count_by(rows, "cell_id"))


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_median_matches_brute_force(spark, setting, broadcast):
    setting(spark__sql__autoBroadcastJoinThreshold=broadcast)
    rng = random.Random(7)
    data = {f"c{i}": [rng.randrange(50) for _ in range(rng.randrange(1, 60))] for i in range(40)}
    data["chaude"] = [rng.randrange(500) for _ in range(3001)]
    data[None] = [4, 9]
    rows = latencies(spark, [(c, x) for c, xs in data.items() for x in xs] + [("c0", None), ("vide", None)])
    expected = {c: float(statistics.median(xs)) for c, xs in data.items()}
    assert dict(values(aggregates.median_by(rows, "cell_id", "latence_ms", "m"))) == expected
    for size in (8, 800):
        by_windows = quantiles.median_by_windows(rows, "cell_id", "latence_ms", "m", size)
        assert dict(values(by_windows)) == expected


def test_medians_of_nothing(spark):
    rows = latencies(spark, [("c", None)])
    assert aggregates.median_by(rows, "cell_id", "latence_ms", "m").isEmpty()
    assert quantiles.median_by_windows(rows, "cell_id", "latence_ms", "m").isEmpty()


def test_median_by_windows_orders_a_small_part_of_a_key(spark, monkeypatch):
    rows = spark.range(100_001).select(F.lit("c").alias("k"), (F.col("id") * 3).alias("x"))
    seen, between = [], quantiles._between

    def counted(known, bounds, key, name):
        seen.append(known.join(bounds, F.col(key) == F.col("_key")).filter("x BETWEEN low AND high").count())
        return between(known, bounds, key, name)

    monkeypatch.setattr(quantiles, "_between", counted)
    assert values(quantiles.median_by_windows(rows, "k", "x", "m")) == [("c", 150_000.0)]
    assert seen[0] < 5_000


def test_median_by_windows_widens_bounds_that_miss(spark, monkeypatch):
    rows = spark.range(2_000).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("x"))
    tried, between = [], quantiles._between

    def misses_first(known, bounds, key, name):
        tried.append(bounds.count())
        return between(known, bounds if len(tried) > 1 else bounds.withColumn("high", F.col("low")), key, name)

    monkeypatch.setattr(quantiles, "_between", misses_first)
    assert dict(values(quantiles.median_by_windows(rows, "k", "x", "m"))) == {0: 999.0, 1: 1000.0}
    assert tried == [2, 2]


def test_sketches_merge_in_any_grouping(spark):
    rows = spark.range(60_000).select((F.col("id") % 30).alias("h"), (F.col("id") % 3).alias("k"), F.hash("id").cast("bigint").alias("x"))
    fine = quantiles.sketched(rows, ["k", "h"], "x")
    for parts in (fine, quantiles.merged(fine, "k", "h"), quantiles.sketched(rows, ["k"], "x")):
        estimates = quantiles.merged(parts, "k").withColumn("estimate", quantiles.quantile("esquisse", 0.5))
        assert {r.n for r in estimates.select(quantiles.count_of("esquisse").alias("n")).collect()} == {20_000}
        checked = quantiles.rank_checked(rows, estimates, "k", "x").collect()
        assert [(r.mesures, r.proche) for r in checked] == [(20_000, True)] * 3
    wrong = estimates.withColumn("estimate", F.lit(0) + F.lit(2**29))
    assert not any(r.proche for r in quantiles.rank_checked(rows, wrong, "k", "x").collect())


def test_approximate_median_is_close(spark):
    rows = spark.range(20_001).select(F.lit("c").alias("k"), F.col("id").alias("x"))
    assert abs(aggregates.approx_median_by(rows, "k", "x", "m").first().m - 10_000) <= 4


def test_settled_puts_estimates_right_and_loses_no_key(spark):
    few = [("a", 1), ("a", 2), ("a", 2), ("a", 9), ("b", 7), ("b", None), ("c", None), (None, 4), (None, 5)]
    rows = latencies(spark, few).unionAll(spark.range(50_001).select(F.lit("hot").alias("cell_id"), F.col("id").alias("latence_ms")))
    estimates = aggregates.approx_median_by(rows, "cell_id", "latence_ms", "estimate", accuracy=20)
    assert dict(values(estimates))["hot"] != 25_000  # over ``accuracy`` rows the sketch alone is off
    found = {tuple(r)[:3]: r.proche for r in quantiles.settled(rows, estimates, "cell_id", "latence_ms", "m").collect()}
    assert set(found) == {("a", 2, 4), ("b", 7, 2), ("c", None, 1), (None, 4, 2), ("hot", 25_000, 50_001)}
    wrong = estimates.withColumn("estimate", F.lit(1) * 40_000)
    far = {r.cell_id: (r.m, r.proche) for r in quantiles.settled(rows, wrong, "cell_id", "latence_ms", "m").collect()}
    assert far["hot"] == (25_000, False) and far["a"] == (2, False) and far["c"] == (None, True)


def test_approximate_median_query_returns_the_medians(spark):
    few = [("a", 3), ("a", 5), ("a", 8), ("a", 100), (None, 6), ("z", None)]
    rows = latencies(spark, few).unionAll(spark.range(30_000).select(F.lit("hot").alias("cell_id"), (F.col("id") * 3).alias("latence_ms")))
    found = set(values(catalog.approx_median_checked(rows), "cell_id", "latence_mediane", "mesures", "proche"))
    assert found == {("a", 5, 4, True), (None, 6, 1, True), ("z", None, 1, True), ("hot", 44_997, 30_000, True)}


def test_stddev_of_one_value_is_null(spark):
    rows = latencies(spark, [("c", 1), ("d", 1), ("d", 3)])
    assert dict(values(aggregates.stddev_by(rows, "cell_id", "latence_ms", "s"))) == {"c": None, "d": 2**0.5}


def test_count_where_shows_zero(spark):
    rows = spark.createDataFrame([("c", "INFO"), ("d", "ERROR")], "cell_id STRING, niveau STRING")
    counts = aggregates.count_where(rows, "cell_id", F.col("niveau") == "ERROR", "n")
    assert dict(values(counts)) == {"c": 0, "d": 1}


def test_chosen_partition_count(spark, sf_dir):
    rows = tables.telemetry(spark, sf_dir)
    for partitions in (1, 8, 200):
        counts = aggregates.count_into(rows, "cell_id", partitions)
        assert counts.rdd.getNumPartitions() == partitions
        assert values(counts) == values(aggregates.count_by(rows, "cell_id"))
    assert plan(aggregates.count_into(rows, "cell_id", 8)).count("partial_count") == 1


def test_shares_add_up(spark):
    counts = spark.createDataFrame([("a", 3), ("b", 1)], "k STRING, n BIGINT")
    assert dict(values(aggregates.shares(counts, "n"), "k", "part")) == {"a": 75.0, "b": 25.0}
    assert "SinglePartition" not in plan(aggregates.shares(counts, "n")).split("Subquery")[0]


def test_sql_and_dataframe_agree(spark, sf_dir):
    rows = tables.telemetry(spark, sf_dir)
    counts = dict(values(incidents.top_cells_sql(rows), "cell_id", "incidents"))
    assert counts == dict(values(incidents.top_error_cells(rows, 10)))
    assert spark.table("telemetrie").count() == rows.count()


def test_kept_table_is_read_from_cache_then_released(spark, sf_dir):
    rows = tables.telemetry(spark, sf_dir)
    with caching.kept(rows) as cached:
        assert cached.is_cached
        assert "InMemoryTableScan" in plan(aggregates.count_by(cached, "cell_id"))
    assert not rows.is_cached
    assert "InMemoryTableScan" not in plan(aggregates.count_by(rows, "cell_id"))


def test_parsed_lines_are_read_once_and_used_twice(spark, sf_dir):
    lines = filters.lines_of_level(tables.lines(tables.telemetry(spark, sf_dir)), "ERROR")
    parsed = filters.parsed(lines, "cell_id STRING, event STRING")
    with caching.kept(parsed) as errors:
        by_cell = aggregates.count_by(errors, "cell_id")
        assert "InMemoryTableScan" in plan(by_cell) and "from_json" not in plan(by_cell).split("InMemoryRelation")[0]
        total = errors.count()
        assert sum(r.evenements for r in by_cell.collect()) == total
    assert total == filters.of_level(tables.telemetry(spark, sf_dir), "ERROR").count()


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(-50, 10**9)), min_size=1, max_size=40))
def test_partials_merge_in_any_grouping(spark, drawn):
    rows = spark.createDataFrame(drawn, "cell_id STRING, lot INT, latence_ms BIGINT")
    whole = aggregates.partials(rows, ["cell_id"], "latence_ms")
    by_lot = aggregates.partials(rows, ["cell_id", "lot"], "latence_ms")
    in_two_steps = aggregates.merged(
        aggregates.merged(by_lot.withColumn("paire", F.col("lot") % 2), "cell_id", "paire"), "cell_id"
    )
    assert values(aggregates.merged(by_lot, "cell_id")) == values(in_two_steps) == values(whole)
    means = dict(values(aggregates.finished(whole, "m")))
    for cell, mean in means.items():
        xs = [x for c, _, x in drawn if c == cell]
        assert mean == sum(xs) / len(xs)


def test_kept_table_is_released_after_an_error(spark):
    rows = spark.range(3)
    try:
        with caching.kept(rows, fill=False):
            raise KeyError
    except KeyError:
        pass
    assert not rows.is_cached
