from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import values
from netload.operators import prefix
from netload.functions import draws, moments, rates, text
from netload.operators import filters

LINE = (
    '{"ts":"2026-10-24T17:28:53.601Z","cell_id":"CELL_0042","niveau":"ERROR","event":"BACKHAUL_LOSS",'
    '"connexions_actives":7,"latence_ms":120,"octets":900}'
)


def lines(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "value STRING")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_text_prefilter_misses_spaced_json(spark):
    frame = lines(spark, LINE, LINE.replace('"niveau":"ERROR"', '"niveau": "ERROR"'))
    assert filters.lines_of_level(frame, "ERROR").count() == 1
    assert filters.of_level(filters.parsed(frame), "ERROR").count() == 2


def test_negated_level_keeps_the_rest(spark):
    frame = lines(spark, LINE, LINE.replace("ERROR", "INFO"))
    assert filters.lines_not_of_level(frame, "INFO").count() == 1


def test_hour_position_and_field(spark):
    row = lines(spark, LINE).select(
        text.hour_text(F.col("value")).alias("h"), text.json_field(F.col("value"), "event").alias("e")
    ).first()
    assert (row.h, row.e) == ("17", "BACKHAUL_LOSS")


def test_blank_lines_and_lengths(spark):
    frame = lines(spark, LINE, "", "   ")
    assert filters.non_blank_lines(frame).count() == 1
    assert [r.longueur for r in filters.long_lines(frame).collect()] == [len(LINE)]


def test_record_round_trip(spark):
    parsed = filters.parsed(lines(spark, LINE))
    assert parsed.select(text.to_line(*parsed.columns)).first()[0] == LINE


def test_unparseable_line_gives_nulls(spark):
    assert list(filters.parsed(lines(spark, "not json")).first()) == [None] * 7


@pytest.mark.parametrize("number, name", [(7, "CELL_0007"), (87, "CELL_0087"), (15000, "CELL_15000")])
def test_cell_name_pads_and_never_cuts(spark, number, name):
    assert one(spark, text.cell_name(F.lit(number))) == name


def test_hour_ignores_the_session_zone(spark, setting):
    setting(spark__sql__session__timeZone="Asia/Tokyo")
    ts = moments.instant(F.lit("2026-10-24T17:28:53.601Z"))
    assert one(spark, moments.utc_hour(ts)) == 17
    assert one(spark, moments.utc_hour(moments.instant(F.lit("1969-12-31T23:59:59Z")))) == 23


def test_bad_timestamp_is_null(spark):
    assert one(spark, moments.instant(F.lit("x"))) is None


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_hours_are_utc_in_any_session(spark, setting, zone):
    setting(spark__sql__session__timeZone=zone)
    for text_, hour in [
        ("2026-10-24T08:00:00Z", 8), ("2026-10-24T08:00:00", 8), ("2026-10-24 08:30:00.5", 8), ("2026-10-24", 0),
        ("2026-10-24T08:00:00+02:00", 6), ("2026-10-24T08:00:00 UTC", 8), (" 2026-03-08T02:30:00 ", 2),
    ]:
        assert one(spark, moments.utc_hour(moments.instant(F.lit(text_)))) == hour, text_


@pytest.mark.parametrize(
    "stamp, expected",
    [
        (datetime(2024, 1, 1, 0, 0, 7, 179575), "2024-01-01T00:00:07.179Z"),
        (datetime(2024, 1, 1, 5, 6, 7, 100000), "2024-01-01T05:06:07.100Z"),
        (datetime(2024, 1, 1, 5, 6, 7), "2024-01-01T05:06:07.000Z"),
        # Skipped by New York's clocks, so a zone-aware formatter would move it.
        (datetime(2024, 3, 10, 2, 30, 0, 5000), "2024-03-10T02:30:00.005Z"),
    ],
)
def test_iso_text(spark, setting, stamp, expected):
    setting(spark__sql__session__timeZone="America/New_York")
    frame = spark.createDataFrame([(stamp,)], "ts TIMESTAMP_NTZ")
    assert frame.select(moments.iso_text(F.col("ts"))).first()[0] == expected


@pytest.mark.parametrize("rate, name", [(84.99, "ok"), (85.0, "warn"), (99.99, "warn"), (100.0, "alerte")])
def test_band(spark, rate, name):
    assert one(spark, rates.band(F.lit(rate))) == name


def test_load_rate_of_zero_or_missing_capacity(spark):
    assert one(spark, rates.load_rate(F.lit(50.0), F.lit(0))) is None
    assert one(spark, rates.load_rate(F.lit(50.0), F.lit(None).cast("bigint"))) is None
    assert one(spark, rates.load_rate(F.lit(130.0), F.lit(100))) == 130.0


def test_draws_are_uniform_and_depend_on_seed_and_tag(spark):
    first, other_seed = draws.uniform(F.col("id"), 1), draws.uniform(F.col("id"), 2)
    row = (
        spark.range(50_000)
        .select(first("a").alias("a"), first("b").alias("b"), other_seed("a").alias("c"))
        .agg(
            F.min("a"), F.max("a"), F.avg("a"), F.corr("a", "b"), F.corr("a", "c")
        )
        .first()
    )
    assert 0 <= row[0] < 0.001 and 0.999 < row[1] < 1
    assert abs(row[2] - 0.5) < 0.01 and abs(row[3]) < 0.02 and abs(row[4]) < 0.02


def _pick(weights, x):
    """Brute force: first index whose running sum exceeds x, else the last."""
    reached = 0
    for index, weight in enumerate(weights):
        reached += weight
        if x < reached:
            return index
    return len(weights) - 1


def test_both_weighted_choices_match_brute_force(spark):
    weights = [3, 0, 5, 1, 7]
    total = sum(weights)
    expected = sorted((x, _pick(weights, x)) for x in range(total + 3))

    draw = spark.range(total + 3).withColumnRenamed("id", "x")
    chained = draw.select("x", draws.pick_weighted(F.col("x") / total, weights).alias("i"))
    assert values(chained) == sorted(expected, key=repr)

    table = spark.createDataFrame(list(enumerate(weights)), "i INT, w INT")
    intervals = draws.cumulative_intervals(table, "i", "w")
    assert values(intervals, "i", "bas", "haut") == [(0, 0, 3), (1, 3, 3), (2, 3, 8), (3, 8, 9), (4, 9, 16)]
    looked_up = draws.pick_from_intervals(draw, intervals, "i", "x", "i")
    assert values(looked_up) == sorted(expected, key=repr)
    assert values(draws.cumulative_intervals(table, "i", "w", at_once=2)) == values(intervals)
    for at_once in (1, 2, 3):  # too many bounds for one array
        in_runs = draws.pick_from_intervals(draw, intervals, "i", "x", "i", at_once)
        assert values(in_runs) == sorted(expected, key=repr)


def test_running_totals_over_many_ranges(spark, setting):
    setting(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="7")
    rows = spark.range(500).select((F.col("id") * 37 % 101).alias("k"), (F.col("id") % 7 - 3).alias("w"), "id")
    found = prefix.running_total(rows, "w", "k", "id").collect()
    total = 0
    for r in sorted(found, key=lambda r: (r.k, r.id)):
        total += r.w
        assert r.running == total
    assert [r.id for r in sorted(prefix.numbered(rows, "k", "id").collect(), key=lambda r: r.pos)] == [
        r.id for r in sorted(found, key=lambda r: (r.k, r.id))
    ]
    laid = prefix.laid_out(rows.withColumn("k", F.lit(1)), "k")  # one key holds all rows
    assert max(r["count"] for r in laid.groupBy("part").count().collect()) < 300
    assert prefix.running_total(rows.limit(0), "w", "k").count() == 0
