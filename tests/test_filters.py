from pyspark.sql import functions as F

from helpers import plan, values
from netload.operators import filters, ranking, sets


def test_strict_limit(spark):
    rates = spark.createDataFrame([(70.0,), (70.01,), (130.0,)], "taux DOUBLE")
    assert values(filters.above(rates, "taux", 70)) == [(130.0,), (70.01,)]


def test_other_than_keeps_null(spark):
    frame = spark.createDataFrame([("CELL_0000",), ("CELL_0001",), (None,)], "cell_id STRING")
    assert filters.other_than(frame, "cell_id", "CELL_0000").count() == 2


def test_hour_parameter_is_text(spark):
    frame = spark.createDataFrame([(8,), (8,), (9,), (None,)], "heure INT")
    assert filters.at_hour(frame, "8").count() == 2
    assert filters.at_hour(frame, "08").count() == 0
    assert filters.at_hour(frame, None).count() == 4


def test_udf_and_native_filter_agree(spark):
    frame = spark.createDataFrame([(1_000_000,), (1_000_001,), (None,)], "octets BIGINT")
    native = values(filters.above(frame, "octets", 1_000_000))
    with_udf = frame.filter(filters.big_payload_udf("octets"))
    assert values(with_udf) == native == [(1_000_001,)]
    assert "ArrowEvalPython" in plan(with_udf)


def test_transformations_leave_the_source_alone(spark):
    numbers = spark.createDataFrame([(n,) for n in range(1, 7)], "x INT")
    assert values(sets.even(numbers, "x")) == [(2,), (4,), (6,)]
    assert sorted(r.x for r in sets.doubled(numbers, "x").collect()) == [2, 4, 6, 8, 10, 12]
    more = sets.appended(numbers, spark.createDataFrame([(7,), (6,)], "x INT"))
    assert sorted(r.x for r in more.collect()) == [1, 2, 3, 4, 5, 6, 6, 7]
    assert sorted(r.x for r in numbers.collect()) == [1, 2, 3, 4, 5, 6]


def test_union_matches_columns_by_name(spark):
    left = spark.createDataFrame([(1, "a")], "x INT, y STRING")
    right = spark.createDataFrame([("b", 2)], "y STRING, x INT")
    assert values(sets.appended(left, right), "x", "y") == [(1, "a"), (2, "b")]


def test_top_breaks_ties_and_page_counts_everything(spark):
    rows = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", 1)], "k STRING, n INT")
    assert [r.k for r in ranking.top(rows, 2, "n", "k").collect()] == ["c", "a"]
    page = ranking.page(rows, 3, "n", "k").collect()
    assert [(r.k, r.total) for r in page] == [("c", 4), ("a", 4), ("b", 4)]
    assert "TakeOrderedAndProject" in plan(ranking.top(rows, 2, "n", "k"))
    assert ranking.head(rows, 3).count() == 3


def test_key_value_reads_two_columns(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    pair = filters.key_value(events, "user_id", F.col("value"))
    assert "ReadSchema: struct<user_id:bigint,value:double>" in plan(pair)
