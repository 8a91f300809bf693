import pytest
from pyspark.sql import functions as F

from helpers import plan, values
from netload import schemas
from netload.operators import aggregates
from netload.plans import load
from netload.sources import readers, synthetic, writers

ROWS = 200_000


@pytest.fixture(scope="module")
def events(spark):
    return synthetic.telemetry(spark, ROWS).persist()


@pytest.fixture(scope="module")
def dimension(spark):
    return synthetic.cells(spark).persist()


def share(frame, condition):
    return frame.filter(condition).count() / ROWS


def test_cells(dimension):
    assert dimension.count() == 87
    assert dimension.drop("_pression").columns == schemas.names(schemas.CELL)
    assert values(dimension, "cell_id") == [(f"CELL_{n:04d}",) for n in range(1, 88)]
    assert dimension.select("secteur").distinct().count() == 12
    assert dimension.filter("secteur = 'Lyon_PartDieu' AND techno = '4G'").count() == 3
    dense = dimension.filter("secteur = 'Lyon_PartDieu'").agg(F.min("capacite_max"), F.max("capacite_max")).first()
    assert dense[0] >= 1280 and dense[1] <= 1920
    assert dimension.filter(~F.col("mise_en_service").rlike(r"^20(1[6-9]|2[0-5])-0[1-9]-01$")).count() == 0


def test_telemetry_contract(events):
    assert events.columns == schemas.names(schemas.TELEMETRY)
    row = events.agg(
        F.count("*"), F.min("latence_ms"), F.min("octets"), F.max("octets"), F.min("connexions_actives"),
        F.countDistinct("cell_id"), F.countDistinct("event"),
    ).first()
    assert row[0] == ROWS and row[1] >= 3 and 400 <= row[2] and row[3] <= 6_000_399 and row[4] >= 0
    assert row[5] == 87 and row[6] == 13
    assert events.filter(~F.col("ts").rlike(r"^2026-10-24T\d\d:[0-5]\d:[0-5]\d\.\d{3}Z$")).count() == 0


def test_distribution(events):
    # Expected: head cell 0.34 * (0.6 + 0.4 / 14), levels from the two sector kinds.
    assert share(events, "cell_id = 'CELL_0001'") == pytest.approx(0.214, abs=0.005)
    assert share(events, "niveau = 'ERROR'") == pytest.approx(0.018, abs=0.002)
    assert share(events, "niveau = 'WARN'") == pytest.approx(0.084, abs=0.004)
    assert share(events, "substring(ts, 12, 2) = '18'") == pytest.approx(2.4 / 31.2, abs=0.004)
    assert share(events, "substring(ts, 12, 2) = '02'") == pytest.approx(0.15 / 31.2, abs=0.001)


def test_event_names_belong_to_their_level(events):
    pairs = {(r.niveau, r.event) for r in events.select("niveau", "event").distinct().collect()}
    from netload.sources.tables import EVENTS

    assert pairs == {(level, name) for level, names in EVENTS.items() for name in names}


def test_same_seed_same_rows_however_they_are_split(spark, events):
    again = synthetic.telemetry_for(spark.range(0, ROWS, 1, 13), synthetic.cells(spark))
    assert again.exceptAll(events).isEmpty() and events.exceptAll(again).isEmpty()


def test_other_seed_other_rows(spark):
    first, second = synthetic.telemetry(spark, 100, 1), synthetic.telemetry(spark, 100, 2)
    assert values(first) != values(second)


def test_generation_is_one_narrow_stage(spark):
    text = plan(synthetic.telemetry(spark, 1000))
    assert "ArrowEvalPython" not in text and "SortMergeJoin" not in text
    assert "Exchange SinglePartition" not in text


def test_some_cells_saturate(events, dimension):
    rows = load.saturated(load.load_table(readers.timed(events), dimension))
    assert 0 < rows.count() < 87 * 24


def test_written_events_read_back(spark, events, tmp_path):
    path = str(tmp_path / "ndjson")
    writers.write_ndjson(events, path)
    back = readers.read_ndjson(spark, path).drop(schemas.CORRUPT)
    assert back.exceptAll(events).isEmpty() and back.count() == ROWS
    assert aggregates.count_by(back, "niveau").count() == 3
