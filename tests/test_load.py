from helpers import cells, plan, telemetry, values
from netload import schemas
from netload.operators import caching
from netload.plans import load, serving
from netload.sources import tables


def test_double_rounding_and_threshold(spark):
    events = telemetry(spark, [("a", 1, 70), ("b", 1, 701), ("b", 1, 700), ("c", 1, 130), ("a", 2, 1), ("a", 2, 2)])
    dimension = cells(spark, [("a", "s", "5G", 100), ("b", "s", "4G", 1000), ("c", "t", "5G", 100)])
    table = load.load_table(events, dimension)
    # b: mean 700.5 of 1000; a at 2 h: mean 1.5.
    assert values(table, "cell_id", "heure", "connexions_moy", "taux_charge") == [
        ("a", 1, 70.0, 70.0), ("a", 2, 1.5, 1.5), ("b", 1, 700.5, 70.05), ("c", 1, 130.0, 130.0),
    ]
    assert [r.cell_id for r in load.saturated(table).collect()] == ["c", "b"]
    assert load.saturated(table).columns == schemas.names(schemas.SATURATION)


def test_rate_uses_the_rounded_mean(spark):
    # Mean 1.25 rounds to 1.3; of 3 that is 43.33 %, while 1.25 would give 41.67 %.
    events = telemetry(spark, [("a", 0, 1), ("a", 0, 1), ("a", 0, 1), ("a", 0, 2)])
    assert load.load_table(events, cells(spark, [("a", "s", "5G", 3)])).first().taux_charge == 43.33


def test_bad_capacity_is_no_alert_and_no_failure(spark):
    events = telemetry(spark, [("a", 1, 70), ("b", 1, 80), ("c", 1, 90)])
    dimension = cells(spark, [("a", "s", "5G", 0), ("b", "s", "5G", None), ("c", "s", "5G", 100)])
    table = load.load_table(events, dimension)
    assert dict(values(table, "cell_id", "taux_charge")) == {"a": None, "b": None, "c": 90.0}
    assert load.saturated(table).count() == 1
    assert values(load.worst_hour_by_sector(table)) == [("s", 1, 90.0)]


def test_unknown_cells_vanish(spark):
    events = telemetry(spark, [("a", 1, 70), ("x", 1, 80)])
    assert load.load_table(events, cells(spark, [("a", "s", "5G", 100)])).count() == 1


def test_aggregating_first_equals_joining_first(spark, sf_dir):
    events, dimension = tables.telemetry(spark, sf_dir), tables.cells(spark, sf_dir)
    assert values(load.load_table(events, dimension)) == values(load.load_table_join_first(events, dimension))


def test_flagship_plan(spark, sf_dir, setting):
    setting(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    text = plan(load.saturated(load.load_table(tables.telemetry(spark, sf_dir), tables.cells(spark, sf_dir))))
    # Only partials cross the network on the event side, and the scan is pruned.
    assert "partial_sum(connexions_actives" in text and "partial_count(connexions_actives" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double,props:string>" in text
    assert "rangepartitioning(taux_charge" in text
    for absent in ("ArrowEvalPython", "CartesianProduct", "NestedLoop", "SinglePartition"):
        assert absent not in text


def test_join_first_broadcasts_and_prunes(spark, sf_dir):
    text = plan(load.load_table_join_first(tables.telemetry(spark, sf_dir), tables.cells(spark, sf_dir)))
    assert "BroadcastHashJoin [cell_id" in text and "SortMergeJoin" not in text


def test_battery_from_cache_equals_battery_without(spark, sf_dir):
    table = load.load_table(tables.telemetry(spark, sf_dir), tables.cells(spark, sf_dir))
    direct = {name: values(query) for name, query in load.battery(table).items()}
    with caching.kept(table) as cached:
        for name, query in load.battery(cached).items():
            assert "InMemoryTableScan" in plan(query)
            got = [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in values(query)]
            want = [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in direct[name]]
            assert got == want


def test_merging_two_days_of_partials(spark):
    dimension = cells(spark, [("a", "s", "5G", 100)])
    first, second = telemetry(spark, [("a", 1, 80)]), telemetry(spark, [("a", 1, 90), ("a", 1, 100)])
    parts = load.connection_partials(first).unionByName(load.connection_partials(second))
    from netload.operators import aggregates

    merged = aggregates.merged(parts, "cell_id", "heure")
    assert load.rate_partials(merged, dimension).first().taux_charge == 90.0


def saturated_rows(spark, rows):
    return spark.createDataFrame(rows, schemas.SATURATION)


def test_serving_views(spark):
    rows = saturated_rows(spark, [
        ("a", "s", "5G", 8, 90.0, 100, 90.0),
        ("a", "s", "5G", 9, 120.0, 100, 120.0),
        ("b", "s", "4G", 9, 120.0, 100, 120.0),
        ("c", "t", "4G", 18, 71.0, 100, 71.0),
    ])
    assert [tuple(r) for r in serving.sector_alerts(rows).collect()] == [("s", 3, 120.0, 2), ("t", 1, 71.0, 1)]
    assert tuple(serving.kpi(rows).first()) == (4, 2, 120.0, "a", "alerte")
    top = [tuple(r) for r in serving.top_situations(rows, 3).collect()]
    assert [(r[0], r[3], r[5], r[6]) for r in top] == [
        ("a", "09", 100.0, "alerte"), ("b", "09", 100.0, "alerte"), ("a", "08", 90.0, "warn"),
    ]
    page = serving.page_for_hour(rows, "9", size=1).collect()
    assert [(r.cell_id, r.total) for r in page] == [("a", 2)]
    assert [(r.cell_id, r.total) for r in serving.page_for_hour(rows, "09").collect()] == [(None, 0)]


def test_empty_result_has_defaults(spark):
    rows = saturated_rows(spark, [])
    assert tuple(serving.kpi(rows).first()) == (0, 0, 0.0, "—", "ok")
    assert serving.sector_alerts(rows).count() == 0


def test_views_skip_the_sort_they_do_not_need(spark, sf_dir):
    rows = load.saturated(load.load_table(tables.telemetry(spark, sf_dir), tables.cells(spark, sf_dir)))
    assert "rangepartitioning" not in plan(serving.kpi(rows))
    assert "rangepartitioning(taux" not in plan(serving.sector_alerts(rows))
