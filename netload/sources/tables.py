"""The given star-schema tables seen as telemetry events and a cell dimension.

Whole tables on both sides: every event becomes a telemetry row, every
customer a cell. A fifth of the events is sent to one cell, so every plan
meets a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netload import schemas
from netload.functions import moments, text
from netload.operators import projections

# Event names of each severity level.
EVENTS = {
    "INFO": ["HANDOVER_OK", "ATTACH", "SESSION_START", "SESSION_END", "PAGING_OK"],
    "WARN": ["CONGESTION", "HIGH_LATENCY", "HANDOVER_RETRY", "LOW_SIGNAL"],
    "ERROR": ["CONNECTION_DROP", "HARDWARE_FAILURE", "AUTH_FAILURE", "BACKHAUL_LOSS"],
}

HOT_SHARE_PERCENT = 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; the declared schema spares the footer-reading job."""
    return spark.read.schema(schemas.TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _event_name(level: str, index: Column) -> Column:
    names = EVENTS[level]
    return F.element_at(F.array(*[F.lit(n) for n in names]), (index % len(names) + 1).cast("int"))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as telemetry: ts, cell_id, niveau, event, three measures, heure."""
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    cents = F.round(F.col("value") * 100).cast("bigint")
    # Null-safe tests in nested, not chained, branches: in this form the optimizer
    # turns a filter on the level into one on event_type, and the scan applies it.
    error, signup = F.col("event_type").eqNullSafe("error"), F.col("event_type").eqNullSafe("signup")
    usual = text.cell_name(F.col("user_id") + 1)
    return table(spark, sf_dir, "events").select(
        "ts",
        F.when(k < HOT_SHARE_PERCENT, text.cell_name(F.lit(1))).otherwise(usual).alias("cell_id"),
        F.when(error, "ERROR").otherwise(F.when(signup, "WARN").otherwise("INFO")).alias("niveau"),
        F.when(error, _event_name("ERROR", k))
        .otherwise(F.when(signup, _event_name("WARN", k)).otherwise(_event_name("INFO", k)))
        .alias("event"),
        (cents % 2000).alias("connexions_actives"),
        (cents % 400 + 3).alias("latence_ms"),
        (k * 60000 + cents + 400).alias("octets"),
        moments.wall_hour(F.col("ts")).alias("heure"),
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` with its nation as the cell dimension, one row per cell_id."""
    key = F.col("c_custkey")
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("secteur")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(nation, "c_nationkey")
        .select(
            text.cell_name(key + 1).alias("cell_id"),
            "secteur",
            F.when(key % 4 == 3, "4G").otherwise("5G").alias("techno"),
            (key % 10 * 100 + 600).alias("capacite_max"),
            (F.lit(45.0) + (key % 1000) / F.lit(1000.0)).alias("lat"),
            (F.lit(4.0) + (key % 500) / F.lit(1000.0)).alias("lon"),
            F.concat(
                (key % 10 + 2016).cast("string"), F.lit("-0"), (key % 9 + 1).cast("string"), F.lit("-01")
            ).alias("mise_en_service"),
        )
    )


def lines(telemetry_rows: DataFrame) -> DataFrame:
    """Telemetry as raw text: one compact JSON object per row, column ``value``."""
    record = [
        moments.iso_text(F.col("ts")).alias("ts") if name == "ts" else F.col(name)
        for name in schemas.names(schemas.TELEMETRY)
    ]
    return projections.computed_once(telemetry_rows, value=text.to_line(*record)).select("value")
