"""Independent ANSI-SQL form of the named queries, over the same tables.

Every engine rounds doubles its own way; ``rounded`` goes through the shortest
decimal text, which is what Spark's ``round`` does.
"""

from __future__ import annotations

from netload.plans.catalog import DRAW_CONSTANTS, DRAW_MODULUS, PICK_FACTOR
from netload.sources import synthetic
from netload.sources.tables import EVENTS, HOT_SHARE_PERCENT


def rounded(expression: str, digits: int) -> str:
    return f"CAST(ROUND(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def _names(level: str) -> str:
    return "[" + ", ".join(f"'{n}'" for n in EVENTS[level]) + "]"


def _event(level: str) -> str:
    return f"list_extract({_names(level)}, (k % {len(EVENTS[level])} + 1)::INTEGER)"


BASE = f"""
WITH brut AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CAST(ROUND(value * 100) AS BIGINT) AS cents
  FROM events
),
telemetrie AS (
  SELECT ts,
         printf('CELL_%04d', CASE WHEN k < {HOT_SHARE_PERCENT} THEN 1 ELSE user_id + 1 END) AS cell_id,
         CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' ELSE 'INFO' END AS niveau,
         CASE event_type WHEN 'error' THEN {_event("ERROR")} WHEN 'signup' THEN {_event("WARN")}
              ELSE {_event("INFO")} END AS event,
         cents % 2000 AS connexions_actives,
         3 + cents % 400 AS latence_ms,
         400 + k * 60000 + cents AS octets,
         CAST(hour(ts) AS INTEGER) AS heure
  FROM brut
),
cellules AS (
  SELECT printf('CELL_%04d', c_custkey + 1) AS cell_id,
         n_name AS secteur,
         CASE WHEN c_custkey % 4 = 3 THEN '4G' ELSE '5G' END AS techno,
         600 + (c_custkey % 10) * 100 AS capacite_max,
         45.0::DOUBLE + (c_custkey % 1000)::DOUBLE / 1000.0::DOUBLE AS lat,
         4.0::DOUBLE + (c_custkey % 500)::DOUBLE / 1000.0::DOUBLE AS lon,
         (2016 + c_custkey % 10)::VARCHAR || '-0' || (1 + c_custkey % 9)::VARCHAR || '-01' AS mise_en_service
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
lignes AS (
  SELECT '{{"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.') || substr(strftime(ts, '%f'), 1, 3)
         || 'Z","cell_id":"' || cell_id || '","niveau":"' || niveau || '","event":"' || event
         || '","connexions_actives":' || connexions_actives || ',"latence_ms":' || latence_ms
         || ',"octets":' || octets || '}}' AS value, latence_ms, octets
  FROM telemetrie
),
moyennes AS (
  SELECT cell_id, heure, {rounded("AVG(connexions_actives)", 1)} AS connexions_moy
  FROM telemetrie GROUP BY cell_id, heure
),
charge AS (
  SELECT cell_id, secteur, techno, heure, connexions_moy, capacite_max,
         {rounded("100 * connexions_moy / capacite_max", 2)} AS taux_charge
  FROM moyennes JOIN cellules USING (cell_id)
),
saturation AS (SELECT * FROM charge WHERE taux_charge > 70),
volumes AS (SELECT cell_id, COUNT(*) AS volume FROM telemetrie GROUP BY cell_id)
"""


def _sql(body: str) -> str:
    return BASE + body


BAND = "CASE WHEN {0} >= 100 THEN 'alerte' WHEN {0} >= 85 THEN 'warn' ELSE 'ok' END"

ERROR_BY_EVENT = _sql(
    "SELECT event, COUNT(*) AS incidents FROM telemetrie WHERE niveau = 'ERROR' GROUP BY event"
)
LATENCY_BY_SECTOR = _sql(
    "SELECT secteur, AVG(latence_ms) AS latence_moyenne "
    "FROM telemetrie JOIN cellules USING (cell_id) GROUP BY secteur"
)
MEAN_LATENCY = _sql("SELECT cell_id, AVG(latence_ms) AS latence_moyenne FROM telemetrie GROUP BY cell_id")
COUNT_BY_CELL = _sql("SELECT cell_id, COUNT(*) AS evenements FROM telemetrie GROUP BY cell_id")
WARN_BIG = _sql("SELECT cell_id, octets FROM telemetrie WHERE niveau = 'WARN' AND octets > 1000000")
CHARGE = _sql("SELECT * FROM charge")
SATURATION = _sql("SELECT * FROM saturation ORDER BY taux_charge DESC, cell_id, heure")
LEVEL_TOTALS = _sql(
    "SELECT niveau, COUNT(*) AS evenements, MAX(latence_ms) AS latence_max, "
    "CAST(SUM(octets) AS BIGINT) AS octets FROM telemetrie GROUP BY niveau"
)
ERROR_SLOW = _sql("SELECT cell_id, latence_ms FROM telemetrie WHERE niveau = 'ERROR' AND latence_ms > 100")


def _page(where: str) -> str:
    return _sql(
        f", page AS (SELECT * FROM saturation {where}) "
        "SELECT *, (SELECT COUNT(*) FROM page) AS total FROM page "
        "ORDER BY taux_charge DESC, cell_id, heure LIMIT 500"
    )


def _layout(column: str) -> str:
    return (
        f"SELECT '{column}' AS colonne, COUNT(*) AS valeurs, AVG(n) AS lignes_moyennes, MAX(n) AS lignes_max, "
        "COUNT(*) >= 0.5 * SUM(n) AS quasi_unique "
        f"FROM (SELECT COUNT(*) AS n FROM telemetrie GROUP BY {column})"
    )


CUSTOMER_INTERVALS = """
WITH poids AS (
  SELECT c_custkey, COUNT(o_orderkey) AS poids FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey
),
bornes AS (SELECT c_custkey, poids, CAST(SUM(poids) OVER (ORDER BY c_custkey) AS BIGINT) AS haut FROM poids)
"""

SKEW_PROFILE = """
, rangs AS (
  SELECT volume, ROW_NUMBER() OVER (ORDER BY volume) AS r, COUNT(*) OVER () AS n FROM volumes
),
profil AS (
  SELECT COUNT(*) AS groupes, CAST(SUM(volume) AS BIGINT) AS total,
         MAX(CASE WHEN r = n // 2 + 1 THEN volume END) AS mediane,
         MAX(CASE WHEN r = GREATEST(n * 9 // 10, 1) THEN volume END) AS p90,
         MAX(volume) AS maximum
  FROM rangs
)
"""


def _draw(tag: str, row_id: str) -> str:
    factor, offset = DRAW_CONSTANTS[tag]
    return f"((({row_id} * {factor} + {offset}) % {DRAW_MODULUS})::DOUBLE / {DRAW_MODULUS}::DOUBLE)"


def _pick(u: str, weights: list) -> str:
    """CASE form of the weighted choice, bounds added up left to right in doubles."""
    reached, branches = 0, []
    for index, weight in enumerate(weights[:-1]):
        reached += weight
        branches.append(f"WHEN {u} * {float(sum(weights))!r}::DOUBLE < {float(reached)!r}::DOUBLE THEN {index}")
    return f"CASE {' '.join(branches)} ELSE {len(weights) - 1} END"


def _synthetic(select: str) -> str:
    """Synthetic events (``evenements``) and cells (``dimension``) from the arithmetic draws."""
    sectors, number, firsts = [], 1, []
    for index, s in enumerate(synthetic.SECTORS):
        firsts.append(number)
        sectors.append(f"({index}, '{s.nom}', {s.cellules}, {s.capacite}, '{s.techno}', {number})")
        number += s.cellules
    sizes = [s.cellules for s in synthetic.SECTORS]
    weights = synthetic.HOUR_WEIGHTS
    names = {
        level: f"list_extract({_names(level)}, FLOOR({_draw('event', 'id')} * {len(EVENTS[level])})::INTEGER + 1)"
        for level in EVENTS
    }
    pressure = rounded(f"densite * (0.75::DOUBLE + {_draw('pressure', 'numero')} * 0.5::DOUBLE)", 3)
    return f"""
WITH secteurs(ordre, nom, nb, capacite, techno, premier) AS (VALUES {", ".join(sectors)}),
antennes AS (
  SELECT ordre, nom, premier + i AS numero, capacite,
         CASE WHEN i % 4 <> 3 THEN techno WHEN techno = '5G' THEN '4G' ELSE '5G' END AS techno,
         (CASE WHEN ordre = 0 THEN 1.28 WHEN techno = '5G' THEN 1.06 ELSE 0.86 END)::DOUBLE AS densite
  FROM secteurs, generate_series(0, 20) AS g(i) WHERE i < nb
),
dimension AS (
  SELECT numero, printf('CELL_%04d', numero) AS cell_id, nom AS secteur, techno, {pressure} AS pression,
         FLOOR(capacite * (0.8::DOUBLE + {_draw('capacity', 'numero')} * 0.4::DOUBLE) + 0.5::DOUBLE)::BIGINT
           AS capacite_max
  FROM antennes
),
places AS (
  SELECT event_id AS id, {_pick(_draw('sector', 'event_id'), [s.poids for s in synthetic.SECTORS])} AS rang,
         {_pick(_draw('hour', 'event_id'), weights)} AS heure
  FROM events
),
situes AS (
  SELECT id, rang, heure,
         CASE WHEN rang = 0 AND {_draw('hot', 'id')} < 0.6::DOUBLE THEN 1
              ELSE list_extract({firsts}, rang + 1)
                   + FLOOR({_draw('cell', 'id')} * list_extract({sizes}, rang + 1))::INTEGER END AS numero,
         list_extract({weights}::DOUBLE[], heure + 1) / {max(weights)}::DOUBLE AS facteur,
         CASE WHEN {_draw('level', 'id')} < (CASE WHEN rang = 0 THEN 0.030::DOUBLE ELSE 0.012::DOUBLE END)
                THEN 'ERROR'
              WHEN {_draw('level', 'id')} < (CASE WHEN rang = 0 THEN 0.030::DOUBLE + 0.140::DOUBLE
                                             ELSE 0.012::DOUBLE + 0.055::DOUBLE END) THEN 'WARN'
              ELSE 'INFO' END AS niveau
  FROM places
),
evenements AS (
  SELECT '{synthetic.DAY}T' || printf('%02d', heure) || ':'
           || printf('%02d', FLOOR({_draw('minute', 'id')} * 60)::INTEGER) || ':'
           || printf('%02d', FLOOR({_draw('second', 'id')} * 60)::INTEGER) || '.'
           || printf('%03d', FLOOR({_draw('millis', 'id')} * 1000)::INTEGER) || 'Z' AS ts,
         cell_id, niveau, heure,
         CASE niveau WHEN 'ERROR' THEN {names['ERROR']} WHEN 'WARN' THEN {names['WARN']}
                     ELSE {names['INFO']} END AS event,
         GREATEST(0, FLOOR(capacite_max * pression * (facteur * 0.85::DOUBLE + 0.20::DOUBLE)
           * ({_draw('conn', 'id')} * 0.5::DOUBLE + 0.75::DOUBLE) + 0.5::DOUBLE)::BIGINT) AS connexions_actives,
         GREATEST(3, FLOOR((CASE WHEN rang = 0 THEN 70 ELSE 25 END)::DOUBLE
           * (facteur * 1.2::DOUBLE + 0.4::DOUBLE)
           * ({_draw('lat1', 'id')} * {_draw('lat2', 'id')} * 3 + 0.5::DOUBLE) + 0.5::DOUBLE)::BIGINT)
           AS latence_ms,
         FLOOR({_draw('size1', 'id')} * {_draw('size2', 'id')} * {_draw('size3', 'id')} * 6000000)::BIGINT + 400
           AS octets
  FROM situes JOIN dimension USING (numero)
)
{select}
"""


SYNTHETIC_SATURATION = f"""
SELECT cell_id, secteur, techno, heure, connexions_moy, capacite_max, taux_charge FROM (
  SELECT *, {rounded("100 * connexions_moy / capacite_max", 2)} AS taux_charge FROM (
    SELECT cell_id, CAST(heure AS INTEGER) AS heure, {rounded("AVG(connexions_actives)", 1)} AS connexions_moy
    FROM evenements GROUP BY cell_id, heure
  ) JOIN dimension USING (cell_id)
) WHERE taux_charge > 70
"""


ORACLES: dict[str, str] = {
    "error_by_event": ERROR_BY_EVENT,
    "error_by_event_from_text": _sql(
        "SELECT json_extract_string(value, '$.event') AS event, COUNT(*) AS incidents FROM lignes "
        "WHERE contains(value, '\"niveau\":\"ERROR\"') GROUP BY 1"
    ),
    "error_by_cell_top5": _sql(
        "SELECT cell_id, COUNT(*) AS incidents FROM telemetrie WHERE niveau = 'ERROR' "
        "GROUP BY cell_id ORDER BY incidents DESC, cell_id LIMIT 5"
    ),
    "integers_even_double_union": """
        SELECT 'pairs' AS serie, event_id AS valeur FROM events WHERE event_id % 2 = 0
        UNION ALL SELECT 'doubles', 2 * event_id FROM events
        UNION ALL SELECT 'plus', event_id FROM events
        UNION ALL SELECT 'plus', MAX(event_id) + 1 FROM events
    """,
    "filter_chain_count": _sql(
        "SELECT COUNT(*) AS retenus FROM telemetrie "
        "WHERE niveau <> 'INFO' AND latence_ms > 50 AND cell_id IS DISTINCT FROM 'CELL_0000'"
    ),
    "line_length_over_100": _sql(
        "SELECT CAST(length(value) AS INTEGER) AS longueur FROM lignes WHERE length(value) > 100"
    ),
    "events_by_hour_from_text": _sql(
        "SELECT substr(value, 19, 2) AS heure_texte, COUNT(*) AS evenements FROM lignes GROUP BY 1"
    ),
    "count_by_cell": COUNT_BY_CELL,
    "count_by_cell_repartitioned": COUNT_BY_CELL,
    "total_count": "SELECT COUNT(*) AS evenements FROM events",
    "avg_latency_by_cell": MEAN_LATENCY,
    "avg_latency_from_partials": MEAN_LATENCY,
    "max_latency_by_cell": _sql(
        "SELECT cell_id, MAX(latence_ms) AS latence_max FROM telemetrie GROUP BY cell_id"
    ),
    "max_bytes_by_cell": _sql("SELECT cell_id, MAX(octets) AS octets_max FROM telemetrie GROUP BY cell_id"),
    "errors_by_cell": _sql(
        "SELECT cell_id, COUNT(*) FILTER (WHERE niveau = 'ERROR') AS erreurs FROM telemetrie GROUP BY cell_id"
    ),
    "stddev_latency_by_cell": _sql(
        f"SELECT cell_id, {rounded('stddev_samp(latence_ms)', 6)} AS ecart_type "
        "FROM telemetrie GROUP BY cell_id"
    ),
    "median_latency_by_cell": _sql(
        "SELECT cell_id, quantile_cont(latence_ms, 0.5) AS latence_mediane FROM telemetrie GROUP BY cell_id"
    ),
    "approx_median_latency_by_cell": _sql(
        "SELECT cell_id, quantile_disc(latence_ms, 0.5) AS latence_mediane, COUNT(*) AS mesures, TRUE AS proche "
        "FROM telemetrie GROUP BY cell_id"
    ),
    "median_from_sketches": _sql(
        "SELECT 'cellule' AS niveau, cell_id AS cle, COUNT(*) AS mesures, TRUE AS proche FROM telemetrie GROUP BY cell_id "
        "UNION ALL SELECT 'secteur', secteur, COUNT(*), TRUE FROM telemetrie JOIN cellules USING (cell_id) GROUP BY secteur"
    ),
    "median_bytes_by_cell": _sql(
        "SELECT cell_id, quantile_cont(octets, 0.5) AS octets_median FROM telemetrie GROUP BY cell_id"
    ),
    "error_slow_projection": ERROR_SLOW,
    "warn_big_projection": WARN_BIG,
    "warn_big_udf": WARN_BIG,
    "all_rows": _sql("SELECT * FROM telemetrie"),
    "warn_by_cell_top5": _sql(
        f"SELECT cell_id, COUNT(*) AS evenements, {rounded('AVG(latence_ms)', 1)} AS latence_moy "
        "FROM telemetrie WHERE niveau = 'WARN' GROUP BY cell_id ORDER BY latence_moy DESC, cell_id LIMIT 5"
    ),
    "sql_error_top10": _sql(
        f"SELECT cell_id, COUNT(*) AS incidents, {rounded('AVG(latence_ms)', 0)} AS latence_moyenne "
        "FROM telemetrie WHERE niveau = 'ERROR' GROUP BY cell_id ORDER BY incidents DESC, cell_id LIMIT 10"
    ),
    "record_lines": _sql("SELECT value FROM lignes"),
    "charge": CHARGE,
    "charge_join_first": CHARGE,
    "charge_top10": _sql("SELECT * FROM charge ORDER BY taux_charge DESC, cell_id, heure LIMIT 10"),
    "saturation": SATURATION,
    "saturation_for_hour": _page("WHERE heure = 18"),
    "saturation_page": _page(""),
    "saturation_empty_page": (
        "SELECT CAST(NULL AS VARCHAR) AS cell_id, CAST(NULL AS VARCHAR) AS secteur, CAST(NULL AS VARCHAR) AS techno, "
        "CAST(NULL AS INTEGER) AS heure, CAST(NULL AS DOUBLE) AS connexions_moy, CAST(NULL AS BIGINT) AS capacite_max, "
        "CAST(NULL AS DOUBLE) AS taux_charge, CAST(0 AS BIGINT) AS total"
    ),
    "battery_from_kept_table": _sql(
        "SELECT 'saturated_count' AS requete, 'toutes' AS cle, CAST(COUNT(*) AS DOUBLE) AS valeur FROM saturation "
        "UNION ALL SELECT 'max_load_by_sector', secteur, MAX(taux_charge) FROM charge GROUP BY secteur "
        f"UNION ALL SELECT 'avg_load_by_techno', techno, {rounded('AVG(taux_charge)', 6)} FROM charge GROUP BY techno"
    ),
    "two_uses_of_one_read": _sql(
        "SELECT 'evenements' AS requete, cell_id AS cle, CAST(COUNT(*) AS DOUBLE) AS valeur FROM telemetrie GROUP BY cell_id "
        "UNION ALL SELECT 'erreurs', cell_id, CAST(COUNT(*) AS DOUBLE) FROM telemetrie WHERE niveau = 'ERROR' GROUP BY cell_id"
    ),
    "freshness": _sql("SELECT COUNT(*) AS alertes, TRUE AS a_jour FROM saturation"),
    "footprint": _sql(
        "SELECT niveau, COUNT(*) AS evenements, TRUE AS a_des_fichiers, TRUE AS a_des_octets FROM telemetrie GROUP BY niveau"
    ),
    "storage_ratio": "SELECT COUNT(*) AS lignes_apres, COUNT(*) AS lignes_avant, TRUE AS plus_petit FROM events",
    "first_rows": "SELECT least(COUNT(*), 3) AS lignes FROM events",
    "partition_sizes": "SELECT COUNT(*) AS lignes, TRUE AS a_des_partitions FROM events",
    "layout_estimate": _sql(
        ", n AS (SELECT COUNT(DISTINCT niveau) AS niveau, COUNT(DISTINCT heure) AS heure, COUNT(DISTINCT cell_id) AS cell_id, "
        "COUNT(DISTINCT ts) AS ts FROM telemetrie) "
        "SELECT 'niveau' AS colonne, niveau AS exactes, TRUE AS proche FROM n UNION ALL SELECT 'heure', heure, TRUE FROM n "
        "UNION ALL SELECT 'cell_id', cell_id, TRUE FROM n UNION ALL SELECT 'ts', ts, TRUE FROM n"
    ),
    "synthetic_profile": "SELECT dense, TRUE AS error_proche, TRUE AS warn_proche FROM (VALUES (TRUE), (FALSE)) AS t(dense)",
    "saturated_count": _sql("SELECT COUNT(*) AS cellules_saturees FROM saturation"),
    "max_load_by_sector": _sql("SELECT secteur, MAX(taux_charge) AS taux_max FROM charge GROUP BY secteur"),
    "avg_load_by_techno": _sql(
        f"SELECT techno, {rounded('AVG(taux_charge)', 6)} AS taux_moyen FROM charge GROUP BY techno"
    ),
    "worst_hour_by_sector": _sql(
        "SELECT secteur, heure, taux_charge AS taux_max FROM ("
        "SELECT *, ROW_NUMBER() OVER (PARTITION BY secteur ORDER BY taux_charge DESC, heure) AS r FROM charge"
        ") WHERE r = 1"
    ),
    "latency_by_sector_auto": LATENCY_BY_SECTOR,
    "latency_by_sector_broadcast": LATENCY_BY_SECTOR,
    "latency_by_sector_merge": LATENCY_BY_SECTOR,
    "latency_by_sector_salted": LATENCY_BY_SECTOR,
    "latency_by_sector_preagg": LATENCY_BY_SECTOR,
    "latency_by_sector_left": _sql(
        ", commandes AS (SELECT printf('CELL_%04d', o_custkey + 1) AS cell_id, "
        "3 + CAST(ROUND(o_totalprice * 100) AS BIGINT) % 400 AS latence_ms FROM orders), "
        "connues AS (SELECT * FROM cellules WHERE cell_id IN (SELECT cell_id FROM telemetrie)) "
        "SELECT secteur, AVG(latence_ms) AS latence_moyenne "
        "FROM commandes LEFT JOIN connues USING (cell_id) GROUP BY secteur"
    ),
    "large_dim_join": """
        SELECT o_orderpriority, COUNT(*) AS lignes,
               CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS centimes
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority
    """,
    "bucketed_dim_join": """
        SELECT o_orderpriority, COUNT(*) AS lignes,
               CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS centimes
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority
    """,
    "sector_alerts": _sql(
        "SELECT secteur, COUNT(*) AS alertes, GREATEST(MAX(taux_charge), 0) AS taux_max, "
        "COUNT(DISTINCT cell_id) AS cellules FROM saturation GROUP BY secteur"
    ),
    "kpi": _sql(
        ", pire AS (SELECT cell_id FROM saturation ORDER BY taux_charge DESC, cell_id, heure LIMIT 1), "
        "ligne AS (SELECT COUNT(*) AS alertes, COUNT(DISTINCT secteur) AS secteurs, "
        "COALESCE(MAX(taux_charge), 0) AS pire_taux, "
        "COALESCE((SELECT cell_id FROM pire), '—') AS cellule_critique FROM saturation) "
        f"SELECT *, {BAND.format('pire_taux')} AS bande FROM ligne"
    ),
    "top30_with_band": _sql(
        "SELECT cell_id, secteur, techno, printf('%02d', heure) AS heure_texte, taux_charge, "
        f"LEAST(taux_charge, 100) AS barre, {BAND.format('taux_charge')} AS bande "
        "FROM saturation ORDER BY taux_charge DESC, cell_id, heure LIMIT 30"
    ),
    "saturated_cells_by_sector": _sql("SELECT DISTINCT secteur, cell_id FROM saturation"),
    "volume_by_cell": _sql(
        "SELECT cell_id, volume, 100 * volume / (SELECT SUM(volume) FROM volumes)::DOUBLE AS part FROM volumes"
    ),
    "head_key_share": _sql(
        "SELECT cell_id, volume, 100 * volume / (SELECT SUM(volume) FROM volumes)::DOUBLE AS part FROM volumes "
        "ORDER BY volume DESC, cell_id LIMIT 1"
    ),
    "key_skew_profile": _sql(
        SKEW_PROFILE + "SELECT *, maximum / mediane AS rapport, 100 * maximum / total AS part_max FROM profil"
    ),
    "skewed_cells": _sql(
        SKEW_PROFILE + "SELECT cell_id, volume, mediane, volume > 5 * mediane AND volume > 100 AS desequilibree "
        "FROM volumes, profil"
    ),
    "hot_cells": _sql(
        ", taille AS (SELECT COUNT(*) AS n FROM events) "
        "SELECT cell_id, CAST(CEIL(volume * 100 / n::DOUBLE) AS INTEGER) AS tranches "
        "FROM volumes, taille WHERE volume * 100 > n"
    ),
    "layout_report": _sql(" UNION ALL ".join(_layout(c) for c in ("niveau", "heure", "cell_id", "ts"))),
    "layout_from_sketches": _sql(
        "SELECT niveau, COUNT(*) AS lignes, COUNT(DISTINCT heure) AS heure_exact, COUNT(DISTINCT cell_id) AS cell_id_exact, "
        "COUNT(DISTINCT ts) AS ts_exact, TRUE AS heure_proche, TRUE AS cell_id_proche, TRUE AS ts_proche "
        "FROM telemetrie GROUP BY niveau"
    ),
    "customer_intervals": CUSTOMER_INTERVALS + "SELECT c_custkey, poids, haut, haut - poids AS bas FROM bornes",
    "customer_draw": CUSTOMER_INTERVALS + f"""
        , tirage AS (SELECT event_id * {PICK_FACTOR} % (SELECT SUM(poids) FROM poids) AS x FROM events)
        SELECT c_custkey, COUNT(*) AS tirages FROM tirage JOIN bornes ON x >= haut - poids AND x < haut GROUP BY c_custkey
        """,
    "hour_intervals": _sql(
        ", poids AS (SELECT heure, COUNT(*) AS poids FROM telemetrie GROUP BY heure) "
        "SELECT a.heure, a.poids, CAST(SUM(b.poids) AS BIGINT) AS haut, "
        "CAST(SUM(b.poids) AS BIGINT) - a.poids AS bas "
        "FROM poids a JOIN poids b ON b.heure <= a.heure GROUP BY a.heure, a.poids"
    ),
    "weighted_draw": _sql(
        f"""
        , poids AS (SELECT heure, COUNT(*) AS poids FROM telemetrie GROUP BY heure),
        bornes AS (SELECT heure, SUM(poids) OVER (ORDER BY heure) AS haut,
                          SUM(poids) OVER (ORDER BY heure) - poids AS bas FROM poids),
        tirage AS (SELECT event_id * {PICK_FACTOR} % (SELECT SUM(poids) FROM poids) AS x FROM events)
        SELECT heure, COUNT(*) AS tirages FROM tirage JOIN bornes ON x >= bas AND x < haut GROUP BY heure
        """
    ),
    "text_scan": ERROR_BY_EVENT,
    "ndjson_declared": LEVEL_TOTALS,
    "ndjson_inferred": LEVEL_TOTALS,
    "ndjson_hours": _sql("SELECT heure, COUNT(*) AS evenements FROM telemetrie GROUP BY heure"),
    "rejected_lines": _sql(
        "SELECT latence_ms % 10 = 0 AS rejetee, COUNT(*) AS lignes, "
        "CAST(SUM(CASE WHEN latence_ms % 10 = 0 THEN length(value) - 5 ELSE 0 END) AS BIGINT) AS caracteres_bruts, "
        "COUNT(*) FILTER (WHERE latence_ms % 10 <> 0) AS octets_lus FROM lignes GROUP BY 1"
    ),
    "parquet_roundtrip": ERROR_SLOW,
    "json_roundtrip": SATURATION,
    "cells_published": _sql("SELECT * FROM cellules"),
    "synthetic_mapping": _synthetic(
        "SELECT ts, cell_id, niveau, event, connexions_actives, latence_ms, octets FROM evenements"
    ),
    "synthetic_saturation": _synthetic(SYNTHETIC_SATURATION),
    "streaming_saturation": SATURATION,
}
