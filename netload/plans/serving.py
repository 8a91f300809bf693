"""Views of the saturated rows for a dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netload.functions import rates, text
from netload.operators import aggregates, filters, ranking

PAGE_SIZE, TOP_SIZE = 500, 30


def page_for_hour(saturated: DataFrame, hour: str | None = None, size: int = PAGE_SIZE) -> DataFrame:
    """First ``size`` rows for the hour, with the uncapped total."""
    return ranking.page(filters.at_hour(saturated, hour), size, "taux_charge", "cell_id", "heure")


def sector_alerts(saturated: DataFrame) -> DataFrame:
    """Alerts, highest rate and distinct cells per sector, most alerts first."""
    per_sector = saturated.groupBy("secteur").agg(
        F.count("*").alias("alertes"),
        F.greatest(F.max("taux_charge"), F.lit(0.0)).alias("taux_max"),
        F.countDistinct("cell_id").alias("cellules"),
    )
    return ranking.ordered(per_sector, "alertes", "secteur")


def kpi(saturated: DataFrame) -> DataFrame:
    """One row of headline figures, with defaults when nothing is saturated."""
    worst = ranking.top(saturated, 1, "taux_charge", "cell_id", "heure").select("cell_id").scalar()
    return saturated.agg(
        F.count("*").alias("alertes"),
        F.countDistinct("secteur").alias("secteurs"),
        F.coalesce(F.max("taux_charge"), F.lit(0.0)).alias("pire_taux"),
    ).withColumns(
        {
            "cellule_critique": F.coalesce(worst, F.lit(rates.NO_CELL)),
            "bande": rates.band(F.col("pire_taux")),
        }
    )


def top_situations(saturated: DataFrame, k: int = TOP_SIZE) -> DataFrame:
    """The k worst rows with severity band, two-digit hour and bar length (at most 100)."""
    return ranking.top(saturated, k, "taux_charge", "cell_id", "heure").select(
        "cell_id",
        "secteur",
        "techno",
        text.zero_padded(F.col("heure"), 2).alias("heure_texte"),
        "taux_charge",
        F.least(F.col("taux_charge"), F.lit(100.0)).alias("barre"),
        rates.band(F.col("taux_charge")).alias("bande"),
    )


def volume_with_share(telemetry: DataFrame) -> DataFrame:
    """Events per cell with their percentage of all traffic, busiest first."""
    counts = aggregates.count_by(telemetry, "cell_id", name="volume")
    return ranking.ordered(aggregates.shares(counts, "volume"), "volume", "cell_id")


def head_share(telemetry: DataFrame) -> DataFrame:
    """The busiest cell and its percentage of all traffic."""
    counts = aggregates.count_by(telemetry, "cell_id", name="volume")
    return ranking.top(aggregates.shares(counts, "volume"), 1, "volume", "cell_id")
