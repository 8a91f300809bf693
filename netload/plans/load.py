"""The mission: hourly load rate of every cell, and the saturated ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netload import schemas
from netload.functions import rates
from netload.operators import aggregates, filters, joins, ranking

CELL_HOUR = ["cell_id", "heure"]


def connection_partials(telemetry: DataFrame) -> DataFrame:
    """Mergeable (sum, count) of active connections per cell and hour."""
    return aggregates.partials(telemetry, CELL_HOUR, "connexions_actives")


def rate_partials(parts: DataFrame, cells: DataFrame) -> DataFrame:
    """Load table from partials. ``cells`` has one row per cell_id."""
    mean = F.round(rates.mean_of(F.col("somme"), F.col("nombre")), 1)
    capacity = cells.select("cell_id", "secteur", "techno", "capacite_max")
    return (
        parts.withColumn("connexions_moy", mean)
        .join(capacity, "cell_id")
        .withColumn("taux_charge", rates.load_rate(F.col("connexions_moy"), F.col("capacite_max")))
        .select(*schemas.names(schemas.SATURATION))
    )


def load_table(telemetry: DataFrame, cells: DataFrame) -> DataFrame:
    """One row per cell and hour: mean connections, capacity, load rate.

    Aggregates before it joins. Sector, techno and capacity depend on the cell
    alone, so the result is that of joining first, but only one row per cell
    and hour meets the dimension: raw rows never move, the hot cell is folded
    inside each map task, and it works however large the dimension gets.
    """
    return rate_partials(connection_partials(telemetry), cells)


def load_table_join_first(telemetry: DataFrame, cells: DataFrame) -> DataFrame:
    """The same table by enriching every event, then grouping on four keys."""
    return (
        joins.join_broadcast(telemetry, cells, "cell_id")
        .groupBy("cell_id", "secteur", "techno", "heure")
        .agg(
            F.round(F.avg("connexions_actives"), 1).alias("connexions_moy"),
            F.max("capacite_max").alias("capacite_max"),
        )
        .withColumn("taux_charge", rates.load_rate(F.col("connexions_moy"), F.col("capacite_max")))
        .select(*schemas.names(schemas.SATURATION))
    )


def saturated(load: DataFrame, threshold: float = rates.SATURATION_THRESHOLD) -> DataFrame:
    """Rows strictly above the threshold, highest rate first."""
    return ranking.ordered(filters.above(load, "taux_charge", threshold), "taux_charge", "cell_id", "heure")


def saturated_count(load: DataFrame, threshold: float = rates.SATURATION_THRESHOLD) -> DataFrame:
    return filters.above(load, "taux_charge", threshold).agg(F.count("*").alias("cellules_saturees"))


def max_rate_by_sector(load: DataFrame) -> DataFrame:
    return aggregates.max_by_key(load, "secteur", "taux_charge", "taux_max")


def worst_hour_by_sector(load: DataFrame) -> DataFrame:
    """The sector's highest rate with its hour; equal rates give the earliest hour."""
    rated = load.filter(F.col("taux_charge").isNotNull()).select("secteur", "heure", "taux_charge")
    highest = rated.groupBy(F.col("secteur").alias("du_secteur")).agg(F.max("taux_charge").alias("taux_max"))
    same = F.col("secteur").eqNullSafe(F.col("du_secteur")) & (F.col("taux_charge") == F.col("taux_max"))
    return rated.join(highest, same).groupBy("secteur", "taux_max").agg(F.min("heure").alias("heure")).select(
        "secteur", "heure", "taux_max"
    )


def mean_rate_by_techno(load: DataFrame) -> DataFrame:
    return aggregates.mean_by(load, "techno", "taux_charge", "taux_moyen")


def battery(load: DataFrame) -> dict[str, DataFrame]:
    """The three supervision queries; give it a kept table to run them from cache."""
    return {
        "saturated_count": saturated_count(load),
        "max_load_by_sector": max_rate_by_sector(load),
        "avg_load_by_techno": mean_rate_by_techno(load),
    }
