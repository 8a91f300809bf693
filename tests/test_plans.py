"""Properties every query's plan must have, whatever the sizes of its inputs."""

import pytest

from helpers import plan
from netload.plans.catalog import QUERIES

# These write a table before they read it back; their reads are covered in test_sources_and_sinks.
WRITING = {
    "text_scan", "ndjson_declared", "ndjson_inferred", "ndjson_hours", "parquet_roundtrip", "json_roundtrip",
    "cells_published", "rejected_lines", "battery_from_kept_table", "two_uses_of_one_read", "median_from_sketches",
    "median_bytes_by_cell", "layout_from_sketches", "customer_intervals", "customer_draw",
    "bucketed_dim_join", "footprint", "storage_ratio", "freshness", "streaming_saturation",
}
READING = sorted(set(QUERIES) - WRITING)


@pytest.fixture(scope="module")
def large(spark):
    """Nothing is small enough to broadcast by estimate."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    saved = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, saved)


@pytest.mark.parametrize("name", READING)
def test_plan(large, sf_dir, name):
    text = plan(QUERIES[name](large, sf_dir))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert ("EvalPython" in text) == (name == "warn_big_udf")
    # Whole-table scans only ever read the columns in use.
    if name not in ("all_rows", "first_rows"):
        assert "event_id:bigint,ts" not in text
    # Broadcasts that remain are the ones bounded by construction.
    bounded = {"latency_by_sector_salted", "synthetic_mapping", "synthetic_saturation", "synthetic_profile"}
    assert name in bounded or "BroadcastExchange" not in text
