import random

import pytest
from pyspark.sql import functions as F

from helpers import plan, values
from netload.operators import bucketing, joins
from netload.plans import incidents
from netload.sources import tables


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a fifth without key, some keys unknown to the dimension."""
    rng = random.Random(3)
    keys = ["chaude"] * 400 + [None] * 240 + [f"c{rng.randrange(60)}" for _ in range(560)]
    fact = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "cle STRING, x INT")
    dimension = spark.createDataFrame(
        [("chaude", "s0"), (None, "nul")] + [(f"c{i}", f"s{i % 5}") for i in range(50)], "cle STRING, secteur STRING"
    )
    return fact, dimension


@pytest.mark.parametrize("how", ["inner", "left"])
def test_every_strategy_gives_the_same_rows(skewed, setting, how):
    fact, dimension = skewed
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    expected = values(joins.join_auto(fact, dimension, "cle", how), "cle", "x", "secteur")
    assert len(expected) == (1200 if how == "left" else len([1 for e in expected if e[2]]))
    for joined in (
        joins.join_broadcast(fact, dimension, "cle", how, max_bytes=10**6),
        joins.join_merge(fact, dimension, "cle", how),
        joins.join_salted(fact, dimension, "cle", how),
        joins.join_salted(fact, dimension, "cle", how, slices=3, spread_by=["x"]),
        joins.join_salted(fact, dimension, "cle", how, slices=1),
        joins.join_salted(fact, dimension, "cle", how, slices=500),
    ):
        assert values(joined, "cle", "x", "secteur") == expected


def test_adaptive_execution_changes_no_row(skewed, setting):
    fact, dimension = skewed
    results = []
    for adaptive in ("true", "false"):
        setting(spark__sql__adaptive__enabled=adaptive, spark__sql__shuffle__partitions="200")
        results.append(values(joins.join_merge(fact, dimension, "cle")))
    assert results[0] == results[1]


def test_salted_join_cuts_the_hot_key(skewed, setting):
    fact, dimension = skewed
    setting(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false",
            spark__sql__shuffle__partitions="64")
    hot = F.col("cle") == "chaude"

    def largest(joined):
        sizes = joined.filter(hot).groupBy(F.spark_partition_id()).count()
        return sizes.agg(F.max("count")).first()[0]

    assert largest(joins.join_merge(fact, dimension, "cle")) == 400
    # A third of the rows over a third of the 64 partitions.
    assert largest(joins.join_salted(fact, dimension, "cle")) < 100


def test_salted_join_refuses_other_join_types(skewed):
    with pytest.raises(ValueError):
        joins.join_salted(*skewed, "cle", "full")


def test_hot_keys_and_their_parts(skewed):
    fact, _ = skewed
    # 400 of the 960 rows that have a key: 1.7 of 4 slices, 12.5 of 30.
    assert values(joins.hot_keys(fact, "cle", 4)) == [("chaude", 2)]
    assert values(joins.hot_keys(fact, "cle", 30)) == [("chaude", 13)]
    for slices in (3, 50, 200, 1000):
        hot = joins.hot_keys(fact, "cle", slices).collect()
        assert len(hot) < slices and sum(r.tranches for r in hot) < 2 * slices


def test_duplicate_dimension_rows_multiply_as_in_a_plain_join(spark, skewed):
    fact, dimension = skewed
    doubled = dimension.unionByName(dimension)
    plain = joins.join_auto(fact, doubled, "cle")
    assert values(joins.join_salted(fact, doubled, "cle")) == values(plain)


def test_broadcast_only_below_the_measured_size(skewed, setting):
    fact, dimension = skewed
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    size = joins.measured_bytes(dimension)
    assert size > 52 * 16
    assert "BroadcastHashJoin" in plan(joins.join_broadcast(fact, dimension, "cle", max_bytes=size))
    assert "SortMergeJoin" in plan(joins.join_broadcast(fact, dimension, "cle", max_bytes=size - 1))
    # Without an explicit limit the session's own threshold decides; here it forbids.
    assert "SortMergeJoin" in plan(joins.join_broadcast(fact, dimension, "cle"))


@pytest.mark.parametrize(
    "setting_text, limit", [("10485760", 10485760), ("10MB", 10485760), ("10485760b", 10485760), ("-1", -1), ("64k", 65536)]
)
def test_threshold_spellings(spark, setting, setting_text, limit):
    setting(spark__sql__autoBroadcastJoinThreshold=setting_text)
    assert joins.broadcast_limit(spark) == limit


def test_measured_bytes_of_nothing_and_of_nested_columns(spark):
    assert joins.measured_bytes(spark.range(0)) == 0
    nested = spark.createDataFrame([([1, 2, 3],)], "v ARRAY<INT>")
    assert joins.measured_bytes(nested) > 16


def test_merge_hint_needs_no_session_setting(spark, sf_dir):
    joined = joins.join_merge(tables.telemetry(spark, sf_dir), tables.cells(spark, sf_dir), "cell_id")
    assert "SortMergeJoin" in plan(joined)


def test_preaggregation_moves_no_raw_row(spark, sf_dir):
    text = plan(
        incidents.latency_by_sector_preaggregated(tables.telemetry(spark, sf_dir), tables.cells(spark, sf_dir))
    )
    join = text.index("Join")
    assert "partial_sum(latence_ms" in text[join:]


def test_large_join_shuffles_each_side_once(spark, sf_dir, setting):
    lineitem, orders = tables.table(spark, sf_dir, "lineitem"), tables.table(spark, sf_dir, "orders")
    small = values(incidents.revenue_by_priority(lineitem, orders))
    setting(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    large = incidents.revenue_by_priority(lineitem, orders)
    text = plan(large)
    assert "SortMergeJoin" in text
    # One exchange per side, and the last one for the five priorities.
    assert text.count("Exchange hashpartitioning") == 3
    assert values(large) == small


def test_unknown_cells(spark):
    rows = spark.createDataFrame([("CELL_0001", 10), ("CELL_9999", 30)], "cell_id STRING, latence_ms BIGINT")
    dimension = spark.createDataFrame([("CELL_0001", "s")], "cell_id STRING, secteur STRING")
    assert values(incidents.latency_by_sector(rows, dimension)) == [("s", 10.0)]
    kept = incidents.latency_by_sector_keeping_unknown(rows, dimension)
    assert set(map(tuple, kept.collect())) == {("s", 10.0), (None, 30.0)}


def test_tables_laid_out_by_the_key_join_without_an_exchange(spark, sf_dir, setting):
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    lineitem, orders = (tables.table(spark, sf_dir, name) for name in ("lineitem", "orders"))
    left = bucketing.bucketed(lineitem.select("l_orderkey", "l_extendedprice"), "l_orderkey", "lignes", 6)
    right = bucketing.bucketed(orders.select("o_orderkey", "o_orderpriority"), "o_orderkey", "commandes", 6)
    joined = incidents.revenue_by_priority(left, right)
    text = plan(joined)
    exchanges = [line for line in text.splitlines() if "Exchange" in line]
    assert len(exchanges) == 1 and "o_orderpriority" in exchanges[0]  # that of the result alone
    assert "SortMergeJoin" in text and "Bucketed: true" in text
    assert values(joined) == values(incidents.revenue_by_priority(lineitem, orders))
