from helpers import values
from netload.plans import load
from netload.sources import publication, readers, tables, writers
from netload.streaming import refresh


def run(spark, source, cells, target, checkpoint):
    stream = refresh.telemetry_stream(spark, source, files_per_batch=1)
    query = refresh.refresh_saturation(stream, cells, target, checkpoint, once=True)
    query.awaitTermination()
    return query


def test_stream_equals_batch_over_several_micro_batches(spark, sf_dir, tmp_path):
    events, cells = tables.telemetry(spark, sf_dir), tables.cells(spark, sf_dir)
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    writers.write_lines(tables.lines(events).repartition(3), source)
    query = run(spark, source, cells, target, checkpoint)
    batches = [p for p in query.recentProgress if p.numInputRows]
    assert len(batches) == 3
    expected = values(load.saturated(load.load_table(events, cells)))
    assert values(readers.read_result(spark, target)) == expected


def test_restart_continues_from_the_checkpoint(spark, sf_dir, tmp_path):
    events, cells = tables.telemetry(spark, sf_dir), tables.cells(spark, sf_dir)
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    lines = tables.lines(events)
    lines.limit(400).coalesce(1).write.text(source)
    run(spark, source, cells, target, checkpoint)
    rest = lines.exceptAll(lines.limit(400))
    rest.write.mode("append").text(source)
    run(spark, source, cells, target, checkpoint)
    assert values(readers.read_result(spark, target)) == values(load.saturated(load.load_table(events, cells)))


def test_bad_lines_count_as_in_batch(spark, sf_dir, tmp_path):
    cells = tables.cells(spark, sf_dir)
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text(
        'garbage\n{"ts":"2026-10-24T08:00:00.000Z","cell_id":"CELL_0001","connexions_actives":5000}\n'
        '{"ts":"x","cell_id":"CELL_0001","connexions_actives":6000}\n'
    )
    run(spark, str(source), cells, str(tmp_path / "out"), str(tmp_path / "state"))
    rows = values(readers.read_result(spark, str(tmp_path / "out")))
    batch = readers.timed(readers.read_ndjson(spark, str(source)))
    assert rows == values(load.saturated(load.load_table(batch, cells)))
    assert {(r[0], r[3]) for r in rows} == {("CELL_0001", 8), ("CELL_0001", None)}


def test_refused_lines_stay_beside_the_result(spark, sf_dir, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    lines = tables.lines(tables.telemetry(spark, sf_dir)).limit(50)
    good = [r.value for r in lines.collect()]
    for i, bad in enumerate(["garbage", '{"latence_ms":"abc"}', "more garbage"]):
        (source / f"{i}.json").write_text("\n".join([*good[i::3], bad]) + "\n")
    run(spark, str(source), tables.cells(spark, sf_dir), target, str(tmp_path / "state"))
    refused = refresh.refused_lines(spark, target).collect()
    assert sorted(r.lot for r in refused) == [0, 1, 2]
    table = str(tmp_path / "table")
    writers.ndjson_to_parquet(spark, str(source), table)
    assert sorted(r.value for r in refused) == sorted(r.value for r in readers.read_rejects(spark, table).collect())


def test_a_replayed_batch_counts_once(spark, sf_dir, tmp_path):
    """The commit of the last batch is lost, so a restart runs it again."""
    events, cells = tables.telemetry(spark, sf_dir), tables.cells(spark, sf_dir)
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    tables.lines(events).repartition(2).write.text(source)
    run(spark, source, cells, target, checkpoint)
    before, log = values(readers.read_result(spark, target)), publication.entries(spark, target)
    for name in ("1", ".1.crc"):
        (tmp_path / "state" / "commits" / name).unlink()
    query = run(spark, source, cells, target, checkpoint)
    assert [p for p in query.recentProgress if p.numInputRows]  # it did run
    assert publication.entries(spark, target) == log
    assert values(readers.read_result(spark, target)) == before
    assert before == values(load.saturated(load.load_table(events, cells)))
