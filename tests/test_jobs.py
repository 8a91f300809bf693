import pytest

from helpers import values
from netload import jobs
from netload.plans import load
from netload.sources import readers, synthetic, writers


def test_missing_inputs_name_the_stage_to_run(spark, tmp_path):
    folder = str(tmp_path)
    with pytest.raises(jobs.MissingInput, match="run `produce` first"):
        jobs.convert(spark, folder)
    with pytest.raises(jobs.MissingInput, match="run `convert` first"):
        jobs.saturate(spark, folder)
    with pytest.raises(readers.ResultNotReady):
        jobs.views(spark, folder)


def test_stages_chain_through_files(spark, tmp_path):
    folder, rows = str(tmp_path), 20_000
    jobs.produce(spark, folder, rows)
    assert jobs.convert(spark, folder).first().facteur > 2
    assert readers.read_telemetry(spark, f"{folder}/{jobs.TABLE}").count() == rows
    jobs.saturate(spark, folder)

    direct = load.load_table(readers.timed(synthetic.telemetry(spark, rows)), synthetic.cells(spark))
    delivered = values(readers.read_result(spark, f"{folder}/{jobs.RESULT}"))
    assert delivered == values(load.saturated(direct)) and delivered

    views = jobs.views(spark, folder, "18")
    assert views["kpi"].first().alertes == len(delivered) == views["sante"].first().alertes
    assert {r.heure for r in views["saturation"].collect()} == {18}
    assert views["situations"].count() == min(30, len(delivered))

    jobs.follow(spark, folder, once=True).awaitTermination()
    assert values(readers.read_result(spark, f"{folder}/{jobs.RESULT}")) == delivered

    more = synthetic.telemetry(spark, 500, seed=7)  # files that arrive later
    writers.append_ndjson(more, f"{folder}/{jobs.EVENTS}")
    jobs.follow(spark, folder, once=True).awaitTermination()
    both = readers.timed(readers.read_ndjson(spark, f"{folder}/{jobs.EVENTS}"))
    assert both.count() == rows + 500
    direct = load.load_table(both, readers.read_cells(spark, f"{folder}/{jobs.CELLS}"))
    assert values(readers.read_result(spark, f"{folder}/{jobs.RESULT}")) == values(load.saturated(direct))
