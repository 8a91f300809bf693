"""Counting and latency questions over events, from text, columns or SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netload.functions import text
from netload.operators import aggregates, filters, joins, ranking
from netload.sources import readers


def errors_by_event(telemetry: DataFrame) -> DataFrame:
    counts = aggregates.count_by(filters.of_level(telemetry, "ERROR"), "event", name="incidents")
    return ranking.ordered(counts, "incidents", "event")


def errors_by_event_from_text(lines: DataFrame) -> DataFrame:
    """The same from raw lines: text test first, then one field of the survivors."""
    errors = filters.lines_of_level(lines, "ERROR")
    event = errors.select(text.json_field(F.col("value"), "event").alias("event"))
    return ranking.ordered(aggregates.count_by(event, "event", name="incidents"), "incidents", "event")


def top_error_cells(telemetry: DataFrame, k: int = 5) -> DataFrame:
    counts = aggregates.count_by(filters.of_level(telemetry, "ERROR"), "cell_id", name="incidents")
    return ranking.top(counts, k, "incidents", "cell_id")


def chained_count(lines: DataFrame) -> DataFrame:
    """Non-INFO lines, parsed, slower than 50 ms, outside the reserved cell: how many."""
    others = filters.lines_not_of_level(lines, "INFO")
    slow = filters.above(filters.parsed(others, "cell_id STRING, latence_ms BIGINT"), "latence_ms", 50)
    return filters.other_than(slow, "cell_id", "CELL_0000").agg(F.count("*").alias("retenus"))


def events_by_hour_from_text(lines: DataFrame) -> DataFrame:
    """Events per hour, cut out of the line by position."""
    hours = lines.select(text.hour_text(F.col("value")).alias("heure_texte"))
    return aggregates.count_by(hours, "heure_texte")


def slowest_warn_cells(telemetry: DataFrame, k: int = 5) -> DataFrame:
    per_cell = filters.of_level(telemetry, "WARN").groupBy("cell_id").agg(
        F.count("*").alias("evenements"), F.round(F.avg("latence_ms"), 1).alias("latence_moy")
    )
    return ranking.top(per_cell, k, "latence_moy", "cell_id")


def top_cells_sql(telemetry: DataFrame, level: str = "ERROR", k: int = 10) -> DataFrame:
    """The SQL form, over the registered view, with bound parameters."""
    readers.register(telemetry)
    return telemetry.sparkSession.sql(
        """
        SELECT cell_id, COUNT(*) AS incidents, ROUND(AVG(latence_ms)) AS latence_moyenne
        FROM telemetrie
        WHERE niveau = :niveau
        GROUP BY cell_id
        ORDER BY incidents DESC, cell_id
        LIMIT :k
        """,
        args={"niveau": level, "k": k},
    )


def mean_latency_from_hours(telemetry: DataFrame) -> DataFrame:
    """Daily mean per cell rolled up from hourly partials."""
    hourly = aggregates.partials(telemetry, ["cell_id", "heure"], "latence_ms")
    return aggregates.finished(aggregates.merged(hourly, "cell_id"), "latence_moyenne")


def _mean_latency_by_sector(enriched: DataFrame) -> DataFrame:
    return aggregates.mean_by(enriched, "secteur", "latence_ms", "latence_moyenne")


def latency_by_sector(telemetry: DataFrame, cells: DataFrame, join=joins.join_auto, **options) -> DataFrame:
    """Mean latency per sector, every event enriched by the given join strategy."""
    fact = filters.key_value(telemetry, "cell_id", "latence_ms")
    return _mean_latency_by_sector(join(fact, cells.select("cell_id", "secteur"), "cell_id", **options))


def latency_by_sector_salted(telemetry: DataFrame, cells: DataFrame, **options) -> DataFrame:
    """Salted shuffle join; the timestamp comes along because it spreads a hot cell's rows evenly."""
    fact = telemetry.select("cell_id", "latence_ms", "ts")
    return _mean_latency_by_sector(
        joins.join_salted(fact, cells.select("cell_id", "secteur"), "cell_id", **options)
    )


def latency_by_sector_preaggregated(telemetry: DataFrame, cells: DataFrame) -> DataFrame:
    """The same, folded to one partial per cell before the join: no skew, no raw-row shuffle."""
    per_cell = aggregates.partials(telemetry, ["cell_id"], "latence_ms")
    enriched = per_cell.join(cells.select("cell_id", "secteur"), "cell_id")
    return aggregates.finished(aggregates.merged(enriched, "secteur"), "latence_moyenne")


def latency_by_sector_keeping_unknown(telemetry: DataFrame, cells: DataFrame) -> DataFrame:
    """Left join: events of cells outside the dimension stay, under a NULL sector.

    Folded to one partial per cell before the join, like the inner form above.
    """
    per_cell = aggregates.partials(telemetry, ["cell_id"], "latence_ms")
    enriched = per_cell.join(cells.select("cell_id", "secteur"), "cell_id", "left")
    return aggregates.finished(aggregates.merged(enriched, "secteur"), "latence_moyenne")


def revenue_by_priority(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Join with a dimension as long as the fact's key set, so normally no broadcast.

    Lines are folded per order first: that exchange is already partitioned on
    the join key, so the join adds none on this side, and an order holding a
    large part of the lines arrives as one row per map task.
    """
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    per_order = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("lignes"), F.sum(cents).alias("centimes")
    )
    return (
        per_order.join(orders.select("o_orderkey", "o_orderpriority"), "o_orderkey")
        .groupBy("o_orderpriority")
        .agg(F.sum("lignes").alias("lignes"), F.sum("centimes").alias("centimes"))
    )
