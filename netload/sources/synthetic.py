"""Synthetic telemetry and cells at any size, for load tests.

Rows come from ``spark.range`` (or any column of ids) and reproducible draws,
so generation is one narrow stage with no driver-side data. The distribution
is fixed; the individual rows depend on the seed.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netload.functions import draws, moments, text
from netload.operators import joins, projections
from netload.sources.tables import EVENTS


class Sector(NamedTuple):
    nom: str
    poids: int
    cellules: int
    capacite: int
    lat: float
    lon: float
    techno: str


# Sectors with traffic weight (sum 100), number of cells, nominal
# capacity, centre and main technology.
SECTORS = [
    Sector("Lyon_PartDieu", 34, 14, 1600, 45.7606, 4.8598, "5G"),
    Sector("Lyon_Bellecour", 11, 10, 1200, 45.7578, 4.8320, "5G"),
    Sector("Villeurbanne_Charpennes", 9, 9, 1100, 45.7700, 4.8630, "5G"),
    Sector("INSA_Doua", 8, 8, 1000, 45.7821, 4.8780, "5G"),
    Sector("Lyon_Confluence", 7, 7, 1000, 45.7420, 4.8160, "5G"),
    Sector("Lyon_Guillotiere", 6, 7, 900, 45.7550, 4.8430, "4G"),
    Sector("Lyon_Vaise", 5, 6, 800, 45.7800, 4.8040, "4G"),
    Sector("Bron_Parilly", 5, 6, 800, 45.7280, 4.9070, "4G"),
    Sector("Venissieux_Centre", 4, 5, 700, 45.6970, 4.8860, "4G"),
    Sector("Ecully_Centre", 4, 5, 600, 45.7740, 4.7770, "4G"),
    Sector("Caluire_Centre", 4, 5, 600, 45.7950, 4.8460, "4G"),
    Sector("StPriest_Zone", 3, 5, 600, 45.6960, 4.9440, "4G"),
]
# Traffic weight of each hour, 0 h to 23 h; the peak is at 18 h.
HOUR_WEIGHTS = [
    0.30, 0.20, 0.15, 0.15, 0.20, 0.40, 0.90, 1.60, 2.20, 2.00, 1.70, 1.60,
    1.70, 1.60, 1.50, 1.50, 1.70, 2.10, 2.40, 2.30, 1.90, 1.50, 1.00, 0.60,
]
# Default size and seeds, the day, the share the first cell of
# the dense sector takes, and level probabilities (dense sector, elsewhere).
DEFAULT_ROWS, EVENT_SEED, CELL_SEED = 5_000_000, 20261024, 4242
DAY = "2026-10-24"
HOT_CELL_SHARE = 0.6
P_ERROR, P_WARN = (0.030, 0.012), (0.140, 0.055)

DrawSource = Callable[[Column], draws.Draw]


def _nearest(x: Column) -> Column:
    return F.floor(x + 0.5).cast("bigint")


def _hashed(seed: int) -> DrawSource:
    return lambda row_id: draws.uniform(row_id, seed)


def _first_cells() -> list[int]:
    """How many cells stand before those of each sector."""
    return [sum(s.cellules for s in SECTORS[:i]) for i in range(len(SECTORS))]


def cells(spark: SparkSession, source: DrawSource = _hashed(CELL_SEED)) -> DataFrame:
    """The cell dimension, with the private load pressure ``_pression``.

    Every fourth cell of a sector has the other technology; capacity varies by
    a fifth around the sector's, coordinates by a few hundred metres.
    """
    schema = (
        "ordre INT, nom STRING, poids INT, cellules INT, capacite INT, "
        "lat DOUBLE, lon DOUBLE, technologie STRING"
    )
    sectors = spark.createDataFrame([(i, *s) for i, s in enumerate(SECTORS)], schema)
    ranged = sectors.withColumn("bas", F.element_at(F.array(*[F.lit(n) for n in _first_cells()]), F.col("ordre") + 1))
    listed = ranged.withColumn("rang", F.explode(F.sequence(F.lit(0), F.col("cellules") - 1))).withColumn(
        "numero", F.col("bas") + F.col("rang") + 1
    )
    draw = source(F.col("numero"))
    density = F.when(F.col("ordre") == 0, 1.28).when(F.col("technologie") == "5G", 1.06).otherwise(0.86)
    other = F.when(F.col("technologie") == "5G", "4G").otherwise("5G")
    month = (draws.index_below(draw("month"), 9) + 1).cast("string")
    year = (draws.index_below(draw("year"), 10) + 2016).cast("string")
    return listed.select(
        F.round(density * (0.75 + 0.5 * draw("pressure")), 3).alias("_pression"),
        text.cell_name(F.col("numero")).alias("cell_id"),
        F.col("nom").alias("secteur"),
        F.when(F.col("rang") % 4 == 3, other).otherwise(F.col("technologie")).alias("techno"),
        _nearest(F.col("capacite") * (0.8 + 0.4 * draw("capacity"))).alias("capacite_max"),
        F.round(F.col("lat") + (draw("lat") - 0.5) * 0.012, 5).alias("lat"),
        F.round(F.col("lon") + (draw("lon") - 0.5) * 0.016, 5).alias("lon"),
        F.concat(year, F.lit("-0"), month, F.lit("-01")).alias("mise_en_service"),
    )


def _by_level(level: Column, u: Column) -> Column:
    """Event name of the level, uniform among the level's names."""

    def one(name: str) -> Column:
        names = EVENTS[name]
        return F.element_at(F.array(*[F.lit(n) for n in names]), draws.index_below(u, len(names)) + 1)

    return F.when(level == "ERROR", one("ERROR")).when(level == "WARN", one("WARN")).otherwise(one("INFO"))


def telemetry_for(ids: DataFrame, dimension: DataFrame, source: DrawSource = _hashed(EVENT_SEED)) -> DataFrame:
    """One telemetry row per row of ``ids`` (column ``id``), for cells from ``cells``.

    The dimension, 87 rows if it is that of the fixed sector list, is broadcast if its
    measured size allows; measuring runs a job over it.
    """
    draw = source(F.col("id"))
    first = [1 + n for n in _first_cells()]
    sizes = F.array(*[F.lit(s.cellules) for s in SECTORS])
    starts = F.array(*[F.lit(f) for f in first])
    position = F.col("secteur_rang") + 1
    dense = F.col("secteur_rang") == 0

    drawn = projections.computed_once(
        ids.select("id"), u_sector=draw("sector"), u_hour=draw("hour"), u_level=draw("level")
    )
    picked = projections.computed_once(
        drawn,
        secteur_rang=draws.pick_weighted(F.col("u_sector"), [s.poids for s in SECTORS]),
        heure=draws.pick_weighted(F.col("u_hour"), HOUR_WEIGHTS),
    )
    placed = picked.withColumn(
        "numero",
        F.when(dense & (draw("hot") < HOT_CELL_SHARE), F.lit(first[0])).otherwise(
            F.element_at(starts, position) + draws.index_below(draw("cell"), F.element_at(sizes, position))
        ),
    )
    hour_weight = F.element_at(F.array(*[F.lit(w) for w in HOUR_WEIGHTS]), F.col("heure") + 1)
    p_error = F.when(dense, P_ERROR[0]).otherwise(P_ERROR[1])
    p_warn = F.when(dense, P_WARN[0]).otherwise(P_WARN[1])
    u = F.col("u_level")
    leveled = placed.select(
        "id",
        text.cell_name(F.col("numero")).alias("cell_id"),
        "heure",
        (hour_weight / max(HOUR_WEIGHTS)).alias("facteur"),
        F.when(dense, 70.0).otherwise(25.0).alias("base"),
        F.when(u < p_error, "ERROR").when(u < p_error + p_warn, "WARN").otherwise("INFO").alias("niveau"),
    )
    enriched = joins.join_broadcast(leveled, dimension.select("cell_id", "capacite_max", "_pression"), "cell_id")
    factor = F.col("facteur")
    # The laws of latency, connections and payload, in the specified order of operands.
    latency = F.col("base") * (0.4 + 1.2 * factor) * (0.5 + draw("lat1") * draw("lat2") * 3)
    connections = F.col("capacite_max") * F.col("_pression") * (0.20 + 0.85 * factor) * (0.75 + 0.5 * draw("conn"))
    payload = 400 + F.floor(draw("size1") * draw("size2") * draw("size3") * 6_000_000)
    # One operator per costly column: all in one projection would compile to a
    # method too long for the JIT and run interpreted.
    stamped = projections.computed_once(
        enriched,
        ts=moments.iso_from_parts(
            DAY, F.col("heure"), draws.index_below(draw("minute"), 60),
            draws.index_below(draw("second"), 60), draws.index_below(draw("millis"), 1000),
        ),
    )
    named = projections.computed_once(stamped, event=_by_level(F.col("niveau"), draw("event")))
    return named.select(
        "ts",
        "cell_id",
        "niveau",
        "event",
        F.greatest(F.lit(0), _nearest(connections)).cast("bigint").alias("connexions_actives"),
        F.greatest(F.lit(3), _nearest(latency)).cast("bigint").alias("latence_ms"),
        payload.cast("bigint").alias("octets"),
    )


def telemetry(spark: SparkSession, rows: int = DEFAULT_ROWS, seed: int = EVENT_SEED) -> DataFrame:
    """``rows`` telemetry rows; the same seed always gives the same rows."""
    return telemetry_for(spark.range(rows), cells(spark), _hashed(seed))
