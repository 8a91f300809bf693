import json
import os
from functools import partial
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from helpers import plan, values
from netload import schemas, scratch
from netload.operators import diagnostics, filters
from netload.plans import load
from netload.sources import publication, readers, tables, writers

GOOD = {
    "ts": "2026-10-24T17:28:53.601Z", "cell_id": "CELL_0001", "niveau": "INFO", "event": "ATTACH",
    "connexions_actives": 5, "latence_ms": 80, "octets": 1000,
}


def compact(record):
    return json.dumps(record, separators=(",", ":"))


@pytest.fixture
def messy(tmp_path):
    path = tmp_path / "telemetrie.ndjson"
    path.write_text("\n".join([
        compact(GOOD), "not json", compact(GOOD | {"latence_ms": "abc"}), "",
        compact({"ts": GOOD["ts"], "cell_id": "CELL_0002"}), compact(GOOD | {"ts": "x", "niveau": "ERROR"}),
    ]) + "\n")
    return str(path)


def test_bad_lines_are_kept_raw(spark, messy):
    rows = readers.read_ndjson(spark, messy).collect()
    assert len(rows) == 5
    corrupt = [r[schemas.CORRUPT] for r in rows if r[schemas.CORRUPT] is not None]
    assert sorted(corrupt) == sorted(["not json", compact(GOOD | {"latence_ms": "abc"})])
    wrong_type = next(r for r in rows if r[schemas.CORRUPT] and r.cell_id == "CELL_0001")
    assert wrong_type.latence_ms is None and wrong_type.octets == 1000
    partial = next(r for r in rows if r.cell_id == "CELL_0002")
    assert partial.niveau is None and partial[schemas.CORRUPT] is None


def test_bad_timestamp_gives_null_ts_and_hour(spark, messy):
    rows = readers.timed(readers.read_ndjson(spark, messy))
    bad = rows.filter("niveau = 'ERROR'").first()
    assert bad.ts is None and bad.heure is None
    assert rows.filter("niveau = 'INFO' AND latence_ms = 80").first().heure == 17


def test_inferred_schema_comes_in_name_order(spark, tmp_path):
    path = tmp_path / "t.ndjson"
    path.write_text(compact(GOOD) + "\n")
    inferred = readers.read_ndjson_inferred(spark, str(path))
    assert inferred.columns == sorted(GOOD)
    assert dict(inferred.dtypes)["latence_ms"] == "bigint" and dict(inferred.dtypes)["ts"] == "string"
    declared = readers.read_ndjson(spark, str(path))
    assert values(declared, *sorted(GOOD)) == values(inferred)
    assert declared.columns == [*GOOD, schemas.CORRUPT]


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored")
    source, target = str(root / "ndjson"), str(root / "parquet")
    writers.write_lines(tables.lines(tables.telemetry(spark, sf_dir)), source)
    writers.ndjson_to_parquet(spark, source, target)
    return source, target


def test_partitioned_table_columns(spark, stored):
    table = readers.read_telemetry(spark, stored[1])
    assert table.columns == [
        "ts", "cell_id", "event", "connexions_actives", "latence_ms", "octets", "heure", "niveau",
    ]
    assert dict(table.dtypes)["ts"] == "timestamp" and dict(table.dtypes)["heure"] == "int"
    run = publication.current(spark, stored[1])
    assert [name for name in os.listdir(run) if "=" in name] == ["_refusee=0"]
    folders = {name for name in os.listdir(f"{run}/_refusee=0") if name.startswith("niveau=")}
    assert folders == {"niveau=INFO", "niveau=WARN", "niveau=ERROR"}


def test_filters_reach_the_parquet_scan(spark, stored):
    table = readers.read_telemetry(spark, stored[1])
    text = plan(filters.level_measure_projection(table, "ERROR", "latence_ms", 100))
    assert "PartitionFilters: [isnotnull(niveau" in text and "(niveau" in text
    assert "GreaterThan(latence_ms,100)" in text
    assert "ReadSchema: struct<cell_id:string,latence_ms:bigint>" in text
    assert "Exchange" not in text


def test_udf_keeps_only_the_partition_filter(spark, stored):
    table = readers.read_telemetry(spark, stored[1])
    slow = filters.of_level(table, "WARN").filter(filters.big_payload_udf("octets"))
    text = plan(slow)
    assert "PushedFilters: []" in text and "(niveau" in text and "ArrowEvalPython" in text
    assert values(slow) == values(filters.above(filters.of_level(table, "WARN"), "octets", 1_000_000))


def test_json_and_parquet_give_the_same_rows(spark, stored):
    source, target = stored
    from_json = filters.level_measure_projection(readers.read_ndjson(spark, source), "ERROR", "latence_ms", 100)
    from_parquet = filters.level_measure_projection(
        readers.read_telemetry(spark, target), "ERROR", "latence_ms", 100
    )
    assert values(from_json) == values(from_parquet)
    assert "PartitionFilters: []" in plan(from_json)


def test_parquet_takes_less_room(spark, stored):
    assert diagnostics.size_ratio(spark, *stored).first().facteur > 1


def test_conversion_keeps_every_line(spark, messy, tmp_path):
    target = str(tmp_path / "parquet")
    writers.ndjson_to_parquet(spark, messy, target)
    assert readers.read_telemetry(spark, target).count() == 5
    refused = [r.value for r in readers.read_rejects(spark, target).collect()]
    assert sorted(refused) == sorted(["not json", compact(GOOD | {"latence_ms": "abc"})])


def test_compacted_table_has_the_same_rows_in_fewer_files(spark, sf_dir, tmp_path):
    rows = tables.telemetry(spark, sf_dir).repartition(9)
    plain, dense = str(tmp_path / "plain"), str(tmp_path / "dense")
    writers.write_telemetry(rows, plain, compact=False)
    writers.write_telemetry(rows, dense)
    assert values(readers.read_telemetry(spark, plain)) == values(readers.read_telemetry(spark, dense))
    files = [diagnostics.footprint(spark, path).first().fichiers for path in (plain, dense)]
    assert files[0] == 27 and files[1] < files[0]


def saturated(spark, sf_dir):
    return load.saturated(load.load_table(tables.telemetry(spark, sf_dir), tables.cells(spark, sf_dir)))


def test_delivery_contract(spark, sf_dir, setting, tmp_path):
    setting(spark__sql__adaptive__enabled="false")
    path = tmp_path / "saturation"
    rows = saturated(spark, sf_dir)
    for _ in range(2):  # the second call replaces the first
        writers.deliver(rows, str(path))
    run = Path(readers.result_path(spark, str(path)))
    parts = sorted(p for p in run.iterdir() if p.name.startswith("part-"))
    assert len(parts) > 1 and (run / "_SUCCESS").exists()
    records = [json.loads(line) for part in parts for line in part.read_text().splitlines()]
    assert len(records) == rows.count()
    assert all(list(r) == schemas.names(schemas.SATURATION) for r in records)
    rates = [r["taux_charge"] for r in records]
    assert rates == sorted(rates, reverse=True) and min(rates) > 70
    assert [tuple(r) for r in readers.read_result(spark, str(path)).collect()] == [tuple(r) for r in rows.collect()]


def test_a_result_that_was_never_published(spark, tmp_path):
    path = tmp_path / "saturation"
    with pytest.raises(readers.ResultNotReady):
        readers.read_result(spark, str(path))
    (path / "run-000000000000-x").mkdir(parents=True)  # written, or half written, but not named
    with pytest.raises(readers.ResultNotReady):
        readers.read_result(spark, str(path))


def test_a_failing_delivery_leaves_the_last_result(spark, sf_dir, tmp_path):
    path = str(tmp_path / "saturation")
    rows = saturated(spark, sf_dir)
    writers.deliver(rows, path)
    before = values(readers.read_result(spark, path))
    broken = rows.withColumn("taux_charge", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        writers.deliver(broken, path)
    assert values(readers.read_result(spark, path)) == before


def test_old_runs_go_and_readers_keep_theirs(spark, sf_dir, tmp_path):
    path, rows = tmp_path / "saturation", saturated(spark, sf_dir)
    writers.deliver(rows, str(path))
    held = readers.read_result(spark, str(path))
    writers.deliver(rows.limit(1), str(path))
    assert held.count() == rows.count()  # opened before the second delivery
    writers.deliver(rows.limit(2), str(path))
    assert len([p for p in path.iterdir() if p.name.startswith("run-")]) == 2
    assert readers.read_result(spark, str(path)).count() == 2


def test_blank_lines_in_a_result_are_skipped(spark, tmp_path):
    root = tmp_path / "saturation"
    path = root / "run-000000000000-x"
    path.mkdir(parents=True)
    (root / "published").mkdir()
    (root / "published" / "00000000000000000000").write_text('{"run": "run-000000000000-x", "key": null}')
    record = dict(zip(schemas.names(schemas.SATURATION), ["a", "s", "5G", 8, 90.0, 100, 90.0]))
    (path / "part-00000.json").write_text(compact(record) + "\n\n")
    (path / "part-00001.json").write_text(compact(record | {"taux_charge": 95.0}) + "\n")
    assert [r.taux_charge for r in readers.read_result(spark, str(root)).collect()] == [95.0, 90.0]


def test_empty_delivery_is_a_result(spark, tmp_path):
    path = str(tmp_path / "saturation")
    writers.deliver(spark.createDataFrame([], schemas.SATURATION), path)
    rows = readers.read_result(spark, path)
    assert rows.columns == schemas.names(schemas.SATURATION) and rows.isEmpty()
    assert diagnostics.freshness(spark, path, rows).first().alertes == 0


def test_freshness(spark, sf_dir, tmp_path):
    path = tmp_path / "saturation"
    rows = saturated(spark, sf_dir)
    writers.deliver(rows, str(path))
    report = diagnostics.freshness(spark, str(path), readers.read_result(spark, str(path))).first()
    run = Path(readers.result_path(spark, str(path)))
    newest = max(p.stat().st_mtime for p in run.iterdir() if p.name.startswith("part-"))
    assert report.alertes == rows.count()
    assert abs(report.derniere_maj.timestamp() - newest) < 1


def test_published_cells_have_no_private_column(spark, sf_dir, tmp_path):
    path = str(tmp_path / "cellules")
    cells = tables.cells(spark, sf_dir)
    writers.publish_cells(cells.withColumn("_pression", F.lit(1.5)), path)
    assert "_pression" not in spark.read.json(publication.current(spark, path)).columns
    assert values(readers.read_cells(spark, path)) == values(cells)


def test_scratch_root(spark, setting):
    assert scratch.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch.fresh_path(spark, "x") != scratch.fresh_path(spark, "x")


def test_what_an_application_wrote_can_be_cleared(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(scratch, "scratch_root", lambda _: str(tmp_path))
    other = tmp_path / "netload-another-application"
    other.mkdir()
    rows = scratch.kept(spark.range(5), "rows")
    assert rows.count() == 5 and len(list(tmp_path.iterdir())) == 2
    scratch.clear(spark)
    assert list(tmp_path.iterdir()) == [other]
    scratch.clear(spark)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        scratch.scratch_root(Session())


def test_other_read_errors_pass_through(spark, tmp_path):
    with pytest.raises(AnalysisException):
        readers.read_telemetry(spark, str(tmp_path / "nowhere"))


def test_a_failing_second_write_leaves_the_first(spark, sf_dir, tmp_path):
    events, cells = tables.telemetry(spark, sf_dir), tables.cells(spark, sf_dir)
    sinks = [
        (writers.write_lines, readers.read_lines, tables.lines(events), "value"),
        (writers.write_ndjson, readers.read_ndjson, events.drop("heure"), "cell_id"),
        (writers.write_telemetry, readers.read_telemetry, events, "cell_id"),
        (partial(writers.write_telemetry, compact=False), readers.read_telemetry, events, "cell_id"),
        (writers.publish_cells, readers.read_cells, cells, "secteur"),
    ]
    for i, (write, read, rows, column) in enumerate(sinks):
        path = str(tmp_path / f"t{i}")
        write(rows, path)
        before = values(read(spark, path))
        fails = F.when(F.rand() < 0.5, F.raise_error(F.lit("broken"))).otherwise(F.raise_error(F.lit("broken")))
        with pytest.raises(Exception, match="broken"):
            write(rows.withColumn(column, fails.cast("string")), path)
        assert values(read(spark, path)) == before and before
        assert len([p for p in os.listdir(path) if p.startswith("run-")]) == 1
        write(rows.limit(2), path)
        assert read(spark, path).count() == 2


def test_the_log_stays_short_and_a_key_publishes_once(spark, tmp_path, monkeypatch):
    path, removed = str(tmp_path / "r"), []
    remove = publication.remove
    monkeypatch.setattr(publication, "remove", lambda s, p: (removed.append(p), remove(s, p)))

    def write(run):
        os.makedirs(run)
        (Path(run) / "_SUCCESS").touch()

    for i in range(1000):
        removed.clear()
        assert publication.replace(spark, path, write, key=str(i))
        assert len(removed) == (2 if i >= publication.KEEP else 0)
        assert not publication.replace(spark, path, write, key=str(i))
    assert [(e.number, e.key) for e in publication.entries(spark, path)] == [(998, "998"), (999, "999")]
    assert len([n for n in os.listdir(path) if n.startswith("run-")]) == 2
    assert len([n for n in os.listdir(f"{path}/published") if not n.startswith(".")]) == 2


def test_two_writers_take_different_numbers(spark, tmp_path):
    path = str(tmp_path / "r")

    def write(run):
        os.makedirs(run)

    def slow(run):
        write(run)
        publication.replace(spark, path, write, "inner")  # another writer publishes meanwhile

    assert publication.replace(spark, path, slow, "outer")
    assert [(e.number, e.key) for e in publication.entries(spark, path)] == [(0, "inner"), (1, "outer")]
    open(f"{path}/published/{2:020d}", "w").close()  # a writer that died between creating and writing
    assert publication.entries(spark, path)[-1].key == "outer"


def test_conversion_scans_its_source_once(spark, messy, tmp_path):
    target = str(tmp_path / "parquet")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("conversion", "", False)
    try:
        writers.ndjson_to_parquet(spark, messy, target, compact=False)
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert len(tracker.getJobIdsForGroup("conversion")) == 1
    text = plan(readers.read_rejects(spark, target))
    assert "PartitionFilters: [isnotnull(_refusee" in text and "ReadSchema: struct<_corrupt_record:string>" in text
