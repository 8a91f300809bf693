"""Every named query over the given tables: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netload import schemas
from netload.functions import draws, text
from netload.operators import aggregates, bucketing, caching, diagnostics, filters, joins, quantiles, ranking, sets
from netload.plans import incidents, load, serving
from netload.scratch import fresh_path, kept
from netload.sources import readers, synthetic, tables, writers
from netload.streaming import refresh

Query = Callable[[SparkSession, str], DataFrame]

LAYOUT_CANDIDATES = ["niveau", "heure", "cell_id", "ts"]

# Multiplier and offset per tag of the arithmetic draws below; any SQL engine
# can repeat them, unlike a hash.
DRAW_MODULUS = 10007
DRAW_CONSTANTS = {
    "sector": (7919, 11), "hour": (6101, 23), "hot": (4409, 37), "cell": (3571, 41), "level": (9973, 53),
    "event": (2203, 61), "minute": (1231, 71), "second": (8161, 83), "millis": (5147, 97),
    "lat1": (4793, 101), "lat2": (6961, 113), "conn": (3307, 127), "size1": (2749, 139),
    "size2": (9161, 151), "size3": (1987, 163), "pressure": (5501, 173), "capacity": (7121, 181),
    "month": (6607, 191), "year": (8837, 199), "lat": (2917, 211), "lon": (4001, 223),
}
PICK_FACTOR = 7919
# Categories from which the customers' weights take the ways for many.
MANY = 128


def _telemetry(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(tables.telemetry(spark, sf_dir))


def _lines(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(tables.lines(tables.telemetry(spark, sf_dir)))


def _both(query: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(tables.telemetry(spark, sf_dir), tables.cells(spark, sf_dir))


def _load(query: Callable[[DataFrame], DataFrame]) -> Query:
    return _both(lambda telemetry, cells: query(load.load_table(telemetry, cells)))


def _saturated(query: Callable[[DataFrame], DataFrame]) -> Query:
    return _load(lambda table: query(load.saturated(table)))


def _rounded(rows: DataFrame, column: str, digits: int = 6) -> DataFrame:
    """Cuts the last bits, which depend on the order of floating-point additions."""
    return rows.withColumn(column, F.round(column, digits))


def even_double_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ids kept when even, doubled, and with one more id appended, tagged by series.

    One scan gives all three series, a second one the id to append.
    """
    ids = tables.table(spark, sf_dir, "events").select(F.col("event_id").alias("valeur"))
    following = ids.agg((F.max("valeur") + 1).alias("valeur")).select(F.lit("plus").alias("serie"), "valeur")
    value = F.col("valeur")
    tagged = sets.series(ids, "valeur", pairs=F.when(sets.is_even(value), value), doubles=sets.double_of(value), plus=value)
    return sets.appended(tagged, following)


def hour_intervals(telemetry: DataFrame) -> DataFrame:
    """The hours with their volume as weight and the interval each one owns."""
    weights = aggregates.count_by(telemetry, "heure", name="poids")
    return draws.cumulative_intervals(weights, "heure", "poids")


def weighted_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws an hour for every event, weighted by the hourly volumes, and counts the draws."""
    intervals = hour_intervals(tables.telemetry(spark, sf_dir))
    total = intervals.agg(F.max("haut")).scalar()
    ids = tables.table(spark, sf_dir, "events").select(
        F.pmod(F.col("event_id") * PICK_FACTOR, total).alias("x")
    )
    drawn = draws.pick_from_intervals(ids, intervals, "heure", "x", "heure")
    return aggregates.count_by(drawn, "heure", name="tirages")


def _customer_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with the number of their orders; none for some."""
    orders = tables.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("poids"))
    customers = tables.table(spark, sf_dir, "customer").select("c_custkey")
    return customers.join(orders, "c_custkey", "left").fillna(0, "poids")


def customer_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers with their orders as weight and the interval each one owns."""
    return draws.cumulative_intervals(_customer_weights(spark, sf_dir), "c_custkey", "poids", at_once=MANY)


def customer_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws a customer for every event, weighted by their orders, and counts the draws."""
    intervals = kept(customer_intervals(spark, sf_dir), "intervalles")
    total = intervals.agg(F.max("haut")).scalar()
    ids = tables.table(spark, sf_dir, "events").select(F.pmod(F.col("event_id") * PICK_FACTOR, total).alias("x"))
    drawn = draws.pick_from_intervals(ids, intervals, "c_custkey", "x", "c_custkey", at_once=MANY)
    return aggregates.count_by(drawn, "c_custkey", name="tirages")


def median_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians by cell and by sector, both merged from one stored table of sketches per cell and hour.

    Per group the number of measures and whether the merged sketch's median stands within its rank error.
    """
    telemetry, cells = tables.telemetry(spark, sf_dir), tables.cells(spark, sf_dir).select("cell_id", "secteur")
    stored = kept(quantiles.sketched(telemetry, ["cell_id", "heure"], "latence_ms"), "esquisses")
    folded = kept(aggregates.count_by(telemetry, "cell_id", "latence_ms"), "valeurs").join(cells, "cell_id", "left")
    answers = []
    for level, key, sketches in (("cellule", "cell_id", stored), ("secteur", "secteur", stored.join(cells, "cell_id"))):
        estimates = quantiles.merged(sketches, key).withColumn("estimate", quantiles.quantile("esquisse", 0.5))
        checked = quantiles.rank_checked(folded, estimates, key, "latence_ms", weight="evenements")
        answers.append(checked.select(F.lit(level).alias("niveau"), F.col(key).alias("cle"), "mesures", "proche"))
    return answers[0].unionByName(answers[1])


def approx_median_checked(telemetry: DataFrame) -> DataFrame:
    """Median per cell, the lower of two middle values: the one-pass estimate, put right where its rank is off.

    With it the cell's rows, and whether the estimate stands within its rank error, whatever a cell's size.
    """
    estimates = aggregates.approx_median_by(telemetry, "cell_id", "latence_ms", "estimate")
    return quantiles.settled(telemetry, estimates, "cell_id", "latence_ms", "latence_mediane")


def layout_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values per level, exact, and whether the union of stored sketches per level and hour is near them."""
    telemetry, columns = tables.telemetry(spark, sf_dir), ["heure", "cell_id", "ts"]
    stored = kept(diagnostics.distinct_sketches(telemetry, ["niveau", "heure"], columns), "esquisses")
    coarse = diagnostics.coarser_sketches(stored, ["niveau"], columns)
    near = diagnostics.distinct_estimates(coarse, ["niveau"], columns)
    exact = telemetry.groupBy("niveau").agg(*[F.count_distinct(c).alias(f"{c}_exact") for c in columns])
    close = [(F.abs(F.col(c) - F.col(f"{c}_exact")) <= 0.06 * F.col(f"{c}_exact")).alias(f"{c}_proche") for c in columns]
    return exact.join(near, "niveau").select("niveau", "lignes", *[f"{c}_exact" for c in columns], *close)


def bucketed_dim_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``large_dim_join`` over tables that are laid out by the order key beforehand."""
    lineitem = tables.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice")
    orders = tables.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return incidents.revenue_by_priority(
        bucketing.bucketed(lineitem, "l_orderkey", "lignes"), bucketing.bucketed(orders, "o_orderkey", "commandes")
    )


def skewed_cells(telemetry: DataFrame) -> DataFrame:
    """Cells with over five times the median number of events, and over 100."""
    volumes = diagnostics.volume_by_key(telemetry, "cell_id")
    return diagnostics.skew_flags(volumes, "volume", threshold=100)


def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line whose latency ends in 0 is cut short; counts the table's rows and the lines refused beside it."""
    whole = tables.lines(tables.telemetry(spark, sf_dir))
    cut = F.expr("substring(value, 1, length(value) - 5)")
    latency = text.json_field(F.col("value"), "latence_ms").cast("bigint")
    source, target = fresh_path(spark, "telemetrie"), fresh_path(spark, "parquet")
    writers.write_lines(whole.select(F.when(latency % 10 == 0, cut).otherwise(F.col("value")).alias("value")), source)
    writers.ndjson_to_parquet(spark, source, target)
    read = readers.read_telemetry(spark, target).filter("octets IS NOT NULL")
    refused = readers.read_rejects(spark, target)
    read = read.select(F.lit(False).alias("rejetee"), F.lit(0).alias("longueur"), "octets")
    refused = refused.select(F.lit(True).alias("rejetee"), F.length("value").alias("longueur"), F.lit(None).alias("octets"))
    return read.union(refused).groupBy("rejetee").agg(
        F.count("*").alias("lignes"), F.sum("longueur").alias("caracteres_bruts"), F.count("octets").alias("octets_lus")
    )


def _written_lines(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_path(spark, "telemetrie")
    writers.write_lines(tables.lines(tables.telemetry(spark, sf_dir)), path)
    return path


def _written_table(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    source, target = _written_lines(spark, sf_dir), fresh_path(spark, "parquet")
    writers.ndjson_to_parquet(spark, source, target)
    return source, target


def _delivered(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_path(spark, "saturation")
    writers.deliver(_saturated(lambda rows: rows)(spark, sf_dir), path)
    return path


def text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = readers.read_lines(spark, _written_lines(spark, sf_dir))
    return incidents.errors_by_event_from_text(filters.non_blank_lines(lines))


def _level_totals(records: DataFrame) -> DataFrame:
    return records.groupBy("niveau").agg(
        F.count("*").alias("evenements"),
        F.max("latence_ms").alias("latence_max"),
        F.sum("octets").alias("octets"),
    )


def ndjson_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _level_totals(readers.read_ndjson(spark, _written_lines(spark, sf_dir)))


def ndjson_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _level_totals(readers.read_ndjson_inferred(spark, _written_lines(spark, sf_dir)))


def ndjson_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour per event parsed from the text timestamps."""
    records = readers.timed(readers.read_ndjson(spark, _written_lines(spark, sf_dir)))
    return aggregates.count_by(records, "heure")


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, target = _written_table(spark, sf_dir)
    return filters.level_measure_projection(readers.read_telemetry(spark, target), "ERROR", "latence_ms", 100)


def footprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per level read back, and whether the listing shows files and bytes for it."""
    _, target = _written_table(spark, sf_dir)
    files = diagnostics.footprint(spark, target, "niveau").select(
        "niveau", (F.col("fichiers") > 0).alias("a_des_fichiers"), (F.col("octets") > 0).alias("a_des_octets")
    )
    return aggregates.count_by(readers.read_telemetry(spark, target), "niveau").join(files, "niveau")


def storage_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows on both sides of the conversion, and whether the table takes less room."""
    source, target = _written_table(spark, sf_dir)
    rows = readers.read_telemetry(spark, target).agg(F.count("*").alias("lignes_apres"))
    lines = readers.read_lines(spark, source).agg(F.count("*")).scalar()
    smaller = diagnostics.size_ratio(spark, source, target).select(F.col("facteur") > 1).scalar()
    return rows.withColumns({"lignes_avant": lines, "plus_petit": smaller})


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_result(spark, _delivered(spark, sf_dir))


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts delivered, and whether the report dates them to this delivery (whole seconds)."""
    began = datetime.now(UTC).replace(microsecond=0)
    path = _delivered(spark, sf_dir)
    report = diagnostics.freshness(spark, path, readers.read_result(spark, path))
    return report.select("alertes", (F.col("derniere_maj") >= F.lit(began)).alias("a_jour"))


def first_rows(telemetry: DataFrame) -> DataFrame:
    """How many of any three rows the table has."""
    found = ranking.head(telemetry, 3)
    return found.join(telemetry, found.columns, "left_semi").agg(F.count("*").alias("lignes"))


def partition_sizes(telemetry: DataFrame) -> DataFrame:
    """All rows, as the sum over the partitions that hold them."""
    sizes = diagnostics.partition_sizes(telemetry)
    return sizes.agg(F.sum("lignes").alias("lignes"), (F.count("*") > 0).alias("a_des_partitions"))


def layout_estimate(telemetry: DataFrame) -> DataFrame:
    """Exact folders per candidate, and whether the sketch is within three times its stated error."""
    exact = telemetry.agg(*[F.count_distinct(c).alias(c) for c in LAYOUT_CANDIDATES])
    exact = exact.unpivot([], LAYOUT_CANDIDATES, "colonne", "exactes")
    estimate = diagnostics.layout_estimate(telemetry, LAYOUT_CANDIDATES).select("colonne", "valeurs")
    near = F.abs(F.col("valeurs") - F.col("exactes")) <= 0.06 * F.col("exactes")
    return exact.join(estimate, "colonne").select("colonne", "exactes", near.alias("proche"))


def latency_by_sector_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as measures of their customers' cells; cells that no event names are unknown."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    orders = tables.table(spark, sf_dir, "orders").select(
        text.cell_name(F.col("o_custkey") + 1).alias("cell_id"), (cents % 400 + 3).alias("latence_ms")
    )
    seen = tables.telemetry(spark, sf_dir).select("cell_id").distinct()
    known = tables.cells(spark, sf_dir).join(seen, "cell_id", "left_semi")
    return incidents.latency_by_sector_keeping_unknown(orders, known)


def cells_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension with a private column added, published without it and read back."""
    path = fresh_path(spark, "cellules")
    private = tables.cells(spark, sf_dir).withColumn("_pression", F.col("capacite_max") / 1000)
    writers.publish_cells(private, path)
    return readers.read_cells(spark, path)


def streaming_saturation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship result, computed by a stream over the events written as NDJSON."""
    target = fresh_path(spark, "saturation")
    stream = refresh.telemetry_stream(spark, _written_lines(spark, sf_dir))
    run = refresh.refresh_saturation(
        stream, tables.cells(spark, sf_dir), target, fresh_path(spark, "checkpoint"), once=True
    )
    run.awaitTermination()
    return readers.read_result(spark, target)


def arithmetic_draws(row_id: Column) -> draws.Draw:
    """Draws any SQL engine can repeat; less random than the hashed ones."""

    def draw(tag: str) -> Column:
        factor, offset = DRAW_CONSTANTS[tag]
        return F.pmod(row_id * factor + offset, F.lit(DRAW_MODULUS)) / F.lit(float(DRAW_MODULUS))

    return draw


def battery_from_kept_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three supervision queries from one load table, kept until their answers are written."""
    table = load.load_table(tables.telemetry(spark, sf_dir), tables.cells(spark, sf_dir))

    def answer(table: DataFrame) -> DataFrame:
        answers = load.battery(table)
        return union_of_answers(
            ("saturated_count", answers["saturated_count"], F.lit("toutes"), F.col("cellules_saturees")),
            ("max_load_by_sector", answers["max_load_by_sector"], F.col("secteur"), F.col("taux_max")),
            ("avg_load_by_techno", answers["avg_load_by_techno"], F.col("techno"), F.round("taux_moyen", 6)),
        )

    return caching.answered(table, answer)


def two_uses_of_one_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and errors per cell from one kept read."""
    read = tables.telemetry(spark, sf_dir).select("cell_id", "niveau")

    def answer(read: DataFrame) -> DataFrame:
        errors = aggregates.count_by(filters.of_level(read, "ERROR"), "cell_id")
        return union_of_answers(
            ("evenements", aggregates.count_by(read, "cell_id"), F.col("cell_id"), F.col("evenements")),
            ("erreurs", errors, F.col("cell_id"), F.col("evenements")),
        )

    return caching.answered(read, answer)


def union_of_answers(*answers: tuple[str, DataFrame, Column, Column]) -> DataFrame:
    """Several answers as rows of (requete, cle, valeur)."""
    rows = [f.select(F.lit(n).alias("requete"), k.alias("cle"), v.cast("double").alias("valeur")) for n, f, k, v in answers]
    return reduce(DataFrame.unionAll, rows)


def _event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))


def synthetic_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One synthetic telemetry row per event id, from the arithmetic draws."""
    dimension = synthetic.cells(spark, arithmetic_draws)
    return synthetic.telemetry_for(_event_ids(spark, sf_dir), dimension, arithmetic_draws)


def synthetic_saturation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship query over those rows and the synthetic cells."""
    rows = readers.timed(synthetic_mapping(spark, sf_dir))
    return load.saturated(load.load_table(rows, synthetic.cells(spark, arithmetic_draws)))


def synthetic_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the hashed synthetic events give each level the share of its probability, within five standard errors."""
    rows = synthetic.telemetry_for(_event_ids(spark, sf_dir), synthetic.cells(spark))
    dense = synthetic.SECTORS[0].nom
    placed = rows.join(synthetic.cells(spark).select("cell_id", "secteur"), "cell_id")
    placed = placed.select((F.col("secteur") == dense).alias("dense"), "niveau")
    counts = placed.groupBy("dense").agg(
        F.count("*").alias("n"), *[F.count_if(F.col("niveau") == level).alias(level) for level in ("ERROR", "WARN")]
    )
    near = []
    for level, (inside, elsewhere) in (("ERROR", synthetic.P_ERROR), ("WARN", synthetic.P_WARN)):
        p = F.when(F.col("dense"), inside).otherwise(elsewhere)
        near.append((F.abs(F.col(level) - p * F.col("n")) <= 5 * F.sqrt(p * F.col("n")) + 1).alias(f"{level.lower()}_proche"))
    return counts.select("dense", *near)


def _over_lineitem(query: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(
        tables.table(spark, sf_dir, "lineitem"), tables.table(spark, sf_dir, "orders")
    )


def _by_sector(join) -> Query:
    return _both(lambda telemetry, cells: incidents.latency_by_sector(telemetry, cells, join))


QUERIES: dict[str, Query] = {
    # Counting
    "error_by_event": _telemetry(incidents.errors_by_event),
    "error_by_event_from_text": _lines(incidents.errors_by_event_from_text),
    "error_by_cell_top5": _telemetry(incidents.top_error_cells),
    "integers_even_double_union": even_double_union,
    "filter_chain_count": _lines(incidents.chained_count),
    "line_length_over_100": _lines(filters.long_lines),
    "events_by_hour_from_text": _lines(incidents.events_by_hour_from_text),
    "count_by_cell": _telemetry(lambda t: aggregates.count_by(t, "cell_id")),
    "count_by_cell_repartitioned": _telemetry(lambda t: aggregates.count_into(t, "cell_id", 8)),
    "total_count": _telemetry(lambda t: t.agg(F.count("*").alias("evenements"))),
    # Means and other statistics
    "avg_latency_by_cell": _telemetry(
        lambda t: aggregates.mean_by(t, "cell_id", "latence_ms", "latence_moyenne")
    ),
    "avg_latency_from_partials": _telemetry(incidents.mean_latency_from_hours),
    "max_latency_by_cell": _telemetry(
        lambda t: aggregates.max_by_key(t, "cell_id", "latence_ms", "latence_max")
    ),
    "max_bytes_by_cell": _telemetry(lambda t: aggregates.max_by_key(t, "cell_id", "octets", "octets_max")),
    "errors_by_cell": _telemetry(
        lambda t: aggregates.count_where(t, "cell_id", F.col("niveau") == "ERROR", "erreurs")
    ),
    "stddev_latency_by_cell": _telemetry(
        lambda t: _rounded(aggregates.stddev_by(t, "cell_id", "latence_ms", "ecart_type"), "ecart_type")
    ),
    "median_latency_by_cell": _telemetry(
        lambda t: aggregates.median_by(t, "cell_id", "latence_ms", "latence_mediane")
    ),
    "median_bytes_by_cell": _telemetry(
        lambda t: quantiles.median_by_windows(t, "cell_id", "octets", "octets_median")
    ),
    "median_from_sketches": median_from_sketches,
    "approx_median_latency_by_cell": _telemetry(approx_median_checked),
    # Filters and projections
    "error_slow_projection": _telemetry(
        lambda t: filters.level_measure_projection(t, "ERROR", "latence_ms", 100)
    ),
    "warn_big_projection": _telemetry(
        lambda t: filters.level_measure_projection(t, "WARN", "octets", 1_000_000).select("cell_id", "octets")
    ),
    "warn_big_udf": _telemetry(
        lambda t: filters.of_level(t, "WARN")
        .filter(filters.big_payload_udf("octets"))
        .select("cell_id", "octets")
    ),
    "all_rows": _telemetry(lambda t: t.select("*")),
    "first_rows": _telemetry(first_rows),
    "warn_by_cell_top5": _telemetry(incidents.slowest_warn_cells),
    "sql_error_top10": _telemetry(incidents.top_cells_sql),
    "record_lines": _lines(lambda lines: lines),
    # Load rate
    "charge": _load(lambda c: c),
    "charge_join_first": _both(load.load_table_join_first),
    "charge_top10": _load(lambda c: ranking.top(c, 10, "taux_charge", "cell_id", "heure")),
    "saturation": _saturated(lambda s: s),
    "saturation_for_hour": _saturated(lambda s: serving.page_for_hour(s, "18")),
    "saturation_page": _saturated(serving.page_for_hour),
    "saturation_empty_page": _saturated(lambda s: serving.page_for_hour(s, "99")),
    "saturated_count": _load(load.saturated_count),
    "max_load_by_sector": _load(load.max_rate_by_sector),
    "avg_load_by_techno": _load(lambda c: _rounded(load.mean_rate_by_techno(c), "taux_moyen")),
    "worst_hour_by_sector": _load(load.worst_hour_by_sector),
    # One kept table, several queries
    "battery_from_kept_table": battery_from_kept_table,
    "two_uses_of_one_read": two_uses_of_one_read,
    # Joins
    "latency_by_sector_auto": _by_sector(joins.join_auto),
    "latency_by_sector_broadcast": _by_sector(joins.join_broadcast),
    "latency_by_sector_merge": _by_sector(joins.join_merge),
    "latency_by_sector_salted": _both(incidents.latency_by_sector_salted),
    "latency_by_sector_preagg": _both(incidents.latency_by_sector_preaggregated),
    "latency_by_sector_left": latency_by_sector_left,
    "large_dim_join": _over_lineitem(incidents.revenue_by_priority),
    "bucketed_dim_join": bucketed_dim_join,
    # Serving
    "sector_alerts": _saturated(serving.sector_alerts),
    "kpi": _saturated(serving.kpi),
    "top30_with_band": _saturated(serving.top_situations),
    "saturated_cells_by_sector": _saturated(lambda s: sets.members(s, "secteur", "cell_id")),
    # Shape of the data
    "volume_by_cell": _telemetry(serving.volume_with_share),
    "head_key_share": _telemetry(serving.head_share),
    "key_skew_profile": _telemetry(
        lambda t: diagnostics.skew_profile(diagnostics.volume_by_key(t, "cell_id"))
    ),
    "skewed_cells": _telemetry(skewed_cells),
    "hot_cells": _telemetry(lambda t: joins.hot_keys(t, "cell_id", 100)),
    "partition_sizes": _telemetry(partition_sizes),
    "layout_report": _telemetry(lambda t: diagnostics.layout_report(t, LAYOUT_CANDIDATES, screen=False)),
    "layout_estimate": _telemetry(layout_estimate),
    "layout_from_sketches": layout_from_sketches,
    "hour_intervals": _telemetry(hour_intervals),
    "weighted_draw": weighted_draw,
    "customer_intervals": customer_intervals,
    "customer_draw": customer_draw,
    # Sources and sinks
    "text_scan": text_scan,
    "ndjson_declared": ndjson_declared,
    "ndjson_inferred": ndjson_inferred,
    "ndjson_hours": ndjson_hours,
    "rejected_lines": rejected_lines,
    "parquet_roundtrip": parquet_roundtrip,
    "json_roundtrip": json_roundtrip,
    "cells_published": cells_published,
    "footprint": footprint,
    "storage_ratio": storage_ratio,
    "freshness": freshness,
    "synthetic_mapping": synthetic_mapping,
    "synthetic_saturation": synthetic_saturation,
    "synthetic_profile": synthetic_profile,
    # Streaming
    "streaming_saturation": streaming_saturation,
}
