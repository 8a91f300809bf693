"""Times the headline queries and the before/after pairs; prints one JSON line.

Every query runs to completion into the ``noop`` sink. Shuffle volumes and task
counts come from Spark's event log, written to a scratch folder.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from netload import scratch
from netload.operators import aggregates, bucketing, caching, diagnostics, filters, joins
from netload.plans import catalog, incidents, load
from netload.sources import readers, synthetic, tables, writers

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))
# Synthetic events of the second set of pairs.
EVENTS = int(os.environ.get("BENCH_EVENTS", synthetic.DEFAULT_ROWS))

HEADLINE = [
    "saturation", "charge", "charge_join_first", "error_by_event", "error_by_event_from_text",
    "filter_chain_count", "events_by_hour_from_text", "avg_latency_by_cell", "avg_latency_from_partials",
    "count_by_cell", "count_by_cell_repartitioned", "warn_by_cell_top5", "sql_error_top10",
    "median_latency_by_cell", "stddev_latency_by_cell", "latency_by_sector_auto",
    "latency_by_sector_broadcast", "latency_by_sector_merge", "latency_by_sector_salted",
    "latency_by_sector_preagg", "large_dim_join", "sector_alerts", "kpi", "top30_with_band",
    "volume_by_cell", "key_skew_profile", "layout_report", "weighted_draw",
    "synthetic_mapping",
]


def build_session(logs: str) -> SparkSession:
    session = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("netload-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{logs}")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


class Bench:
    def __init__(self, spark: SparkSession):
        self.spark, self.seconds, self.repeats, self.prefix, self.usual = spark, {}, {}, "", REPEATS

    def run(self, name: str, action, repeats: int | None = None, warm_up: bool = True) -> None:
        """Best of ``repeats``, by default after one warm-up run."""
        repeats = repeats or self.usual
        if warm_up:
            action()
        name = self.prefix + name
        self.spark.sparkContext.setJobDescription(name)
        times = []
        for _ in range(repeats):
            start = time.perf_counter()
            action()
            times.append(time.perf_counter() - start)
        self.spark.sparkContext.setJobDescription(None)
        self.seconds[name], self.repeats[name] = round(min(times), 4), repeats

    def frame(self, name: str, build) -> None:
        self.run(name, lambda: finish(build()))


def finish(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def measure_pairs(bench: Bench, spark: SparkSession, folder: str, write, cells: DataFrame) -> dict:
    """Times the before/after pairs on one NDJSON file and the Parquet table made from it;
    returns the size of both."""
    source, target = f"{folder}/ndjson", f"{folder}/parquet"
    write(source)
    bench.run("convert_ndjson_to_parquet", lambda: writers.ndjson_to_parquet(spark, source, target), 1)
    events = readers.read_telemetry(spark, target)
    declared = readers.read_ndjson(spark, source)

    def slow_errors(frame):
        return filters.level_measure_projection(frame, "ERROR", "latence_ms", 100)

    bench.frame("text_file_errors", lambda: incidents.errors_by_event_from_text(readers.read_lines(spark, source)))
    bench.frame("read_inferred", lambda: readers.read_ndjson_inferred(spark, source))
    bench.frame("read_declared", lambda: readers.read_ndjson(spark, source))
    bench.frame("filtered_json", lambda: slow_errors(declared))
    bench.frame("filtered_parquet", lambda: slow_errors(events))
    bench.frame("table_saturation", lambda: load.saturated(load.load_table(events, cells)))
    bench.frame("table_mean", lambda: aggregates.mean_by(events, "cell_id", "latence_ms", "m"))
    # What the mean would ship without map-side combine, and without projection either.
    bench.frame("ship_values", lambda: filters.key_value(events, "cell_id", "latence_ms").repartition("cell_id"))
    bench.frame("ship_records", lambda: events.repartition("cell_id"))
    for name, join in (("merge", joins.join_merge), ("broadcast", joins.join_broadcast)):
        bench.frame(f"table_join_{name}", lambda join=join: incidents.latency_by_sector(events, cells, join))
    bench.frame("table_join_salted", lambda: incidents.latency_by_sector_salted(events, cells))
    bench.frame("table_join_preagg", lambda: incidents.latency_by_sector_preaggregated(events, cells))
    for adaptive in ("false", "true"):
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        bench.frame(
            f"skewed_join_200_aqe_{adaptive}", lambda: incidents.latency_by_sector(events, cells, joins.join_merge)
        )
    spark.conf.set("spark.sql.shuffle.partitions", CPUS)
    table = load.load_table(events, cells)
    three = lambda rows: [finish(query) for query in load.battery(rows).values()]
    bench.run("battery_uncached", lambda: three(table))
    with caching.kept(table) as cached:
        bench.run("battery_cached", lambda: three(cached))
    return diagnostics.size_ratio(spark, source, target).first().asDict()


def before_after(seconds: dict, stages: dict, sizes: dict, prefix: str) -> dict:
    """The pairs as [before, after, ratio], of the names with the prefix."""
    seconds, stages = (
        {name.removeprefix(prefix): x for name, x in found.items() if name.startswith(prefix)} for found in (seconds, stages)
    )
    shuffled = {name: figures["shuffle_bytes"] for name, figures in stages.items()}
    skewed = stages["skewed_join_200_aqe_false"]
    pairs = {
        "shuffle_bytes_values_to_partials": (shuffled["ship_values"], shuffled["table_mean"]),
        "shuffle_bytes_records_to_values": (shuffled["ship_records"], shuffled["ship_values"]),
        "seconds_records_to_partials": (seconds["ship_records"], seconds["table_mean"]),
        "seconds_inferred_to_declared": (seconds["read_inferred"], seconds["read_declared"]),
        "bytes_ndjson_to_parquet": (sizes["octets_avant"], sizes["octets_apres"]),
        "seconds_filtered_json_to_parquet": (seconds["filtered_json"], seconds["filtered_parquet"]),
        "seconds_join_merge_to_broadcast": (seconds["table_join_merge"], seconds["table_join_broadcast"]),
        "seconds_join_merge_to_preaggregated": (seconds["table_join_merge"], seconds["table_join_preagg"]),
        "shuffle_bytes_merge_to_preaggregated": (shuffled["table_join_merge"], shuffled["table_join_preagg"]),
        "records_skewed_join_max_to_median_task": (skewed["max_read"], skewed["median_read"]),
        "tasks_without_to_with_aqe": (skewed["tasks"], stages["skewed_join_200_aqe_true"]["tasks"]),
        "seconds_battery_uncached_to_cached": (seconds["battery_uncached"], seconds["battery_cached"]),
    }
    return {name: [a, b, round(a / b, 2) if b else None] for name, (a, b) in pairs.items()}


def stage_figures(logs: str, repeats: dict) -> dict:
    """Per measured name, from the event log: shuffle bytes and records written, tasks,
    and the median and largest records read by a shuffle-reading task."""
    names, figures = {}, {}
    for line in next(Path(logs).iterdir()).open():
        event = json.loads(line)
        if event["Event"] == "SparkListenerJobStart":
            name = (event.get("Properties") or {}).get("spark.job.description")
            names.update({stage["Stage ID"]: name for stage in event["Stage Infos"]})
        elif event["Event"] == "SparkListenerTaskEnd" and names.get(event["Stage ID"]) in repeats:
            entry = figures.setdefault(names[event["Stage ID"]], {"bytes": 0, "records": 0, "tasks": 0, "read": []})
            metrics = event.get("Task Metrics") or {}
            written = metrics.get("Shuffle Write Metrics", {})
            entry["bytes"] += written.get("Shuffle Bytes Written", 0)
            entry["records"] += written.get("Shuffle Records Written", 0)
            entry["tasks"] += 1
            read = metrics.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            if read:
                entry["read"].append(read)
    return {
        name: {
            "shuffle_bytes": entry["bytes"] // repeats[name],
            "shuffle_records": entry["records"] // repeats[name],
            "tasks": entry["tasks"] // repeats[name],
            "median_read": int(statistics.median(entry["read"])) if entry["read"] else 0,
            "max_read": max(entry["read"], default=0),
        }
        for name, entry in figures.items()
    }


def main() -> None:
    logs, folder = tempfile.mkdtemp(prefix="netload-log-"), tempfile.mkdtemp(prefix="netload-bench-")
    spark = build_session(logs)
    bench = Bench(spark)
    for name in HEADLINE:
        bench.frame(name, lambda name=name: catalog.QUERIES[name](spark, SF_DIR))
    headline = round(sum(bench.seconds.values()), 3)
    rest = sorted(set(catalog.QUERIES) - set(HEADLINE))
    for name in rest:
        bench.run(name, lambda name=name: finish(catalog.QUERIES[name](spark, SF_DIR)), 1, warm_up=False)
        scratch.clear(spark)
    laid_out = [
        bucketing.bucketed(tables.table(spark, SF_DIR, name).select(*columns), columns[0], name)
        for name, columns in (("lineitem", ["l_orderkey", "l_extendedprice"]), ("orders", ["o_orderkey", "o_orderpriority"]))
    ]
    bench.frame("dim_join_laid_out", lambda: incidents.revenue_by_priority(*laid_out))
    scratch.clear(spark)
    given = tables.lines(tables.telemetry(spark, SF_DIR))
    sizes = measure_pairs(bench, spark, f"{folder}/given", partial(writers.write_lines, given), tables.cells(spark, SF_DIR))
    bench.prefix, bench.usual = "default_", 1
    events, cells = synthetic.telemetry(spark, EVENTS, synthetic.EVENT_SEED), synthetic.cells(spark)
    large = measure_pairs(bench, spark, f"{folder}/default", partial(writers.write_ndjson, events), cells)
    for name, build in (("fold_first", load.load_table), ("join_first", load.load_table_join_first)):
        rows = readers.read_telemetry(spark, f"{folder}/default/parquet")
        bench.frame(f"load_{name}", lambda build=build, rows=rows: build(rows, cells))
    spark.stop()
    stages = stage_figures(logs, bench.repeats)
    result = {
        "metric": f"total of {len(HEADLINE)} headline queries",
        "value": headline,
        "unit": "sec",
        "queries": bench.seconds,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
        "pairs": before_after(bench.seconds, stages, sizes, "")
        | {"seconds_dim_join_to_laid_out": [bench.seconds["large_dim_join"], bench.seconds["dim_join_laid_out"]]},
        "events_default": EVENTS,
        "pairs_default": before_after(bench.seconds, stages, large, "default_")
        | {"seconds_load_join_first_to_fold_first": [bench.seconds["default_load_join_first"], bench.seconds["default_load_fold_first"]]},
        "stages": stages,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
