"""The stages of a run, each reading and writing one shared folder.

They meet only through files, so each can be its own ``spark-submit``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from netload.operators import diagnostics
from netload.plans import load, serving
from netload.sources import readers, synthetic, writers
from netload.streaming import refresh

# Names inside the data folder.
EVENTS, CELLS, TABLE, RESULT = "telemetrie.ndjson", "cellules.json", "parquet/telemetrie", "out/saturation"
# Where the stream keeps its progress, so that a restart continues.
STATE = "state/saturation"


class MissingInput(FileNotFoundError):
    """A stage's input is not there; names the stage that makes it."""


def _expect(path: str, stage: str, spark: SparkSession) -> str:
    try:
        readers.read_lines(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise MissingInput(f"{path} not found; run `{stage}` first") from error
    return path


def produce(
    spark: SparkSession, folder: str, rows: int = synthetic.DEFAULT_ROWS, seed: int = synthetic.EVENT_SEED
) -> None:
    """Synthetic telemetry as NDJSON and the published cell dimension."""
    writers.publish_cells(synthetic.cells(spark), f"{folder}/{CELLS}")
    writers.write_ndjson(synthetic.telemetry(spark, rows, seed), f"{folder}/{EVENTS}")


def convert(spark: SparkSession, folder: str, compact: bool = True) -> DataFrame:
    """NDJSON to the level-partitioned table; returns both sizes and their ratio."""
    source, target = _expect(f"{folder}/{EVENTS}", "produce", spark), f"{folder}/{TABLE}"
    writers.ndjson_to_parquet(spark, source, target, compact)
    return diagnostics.size_ratio(spark, source, target)


def saturate(spark: SparkSession, folder: str) -> None:
    """Load rates from the table, saturated rows delivered as JSON."""
    events = readers.read_telemetry(spark, _expect(f"{folder}/{TABLE}", "convert", spark))
    cells = readers.read_cells(spark, _expect(f"{folder}/{CELLS}", "produce", spark))
    writers.deliver(load.saturated(load.load_table(events, cells)), f"{folder}/{RESULT}")


def follow(spark: SparkSession, folder: str, once: bool = False) -> StreamingQuery:
    """Like ``saturate``, but keeps the delivery current while NDJSON files arrive."""
    stream = refresh.telemetry_stream(spark, _expect(f"{folder}/{EVENTS}", "produce", spark))
    cells = readers.read_cells(spark, _expect(f"{folder}/{CELLS}", "produce", spark))
    return refresh.refresh_saturation(stream, cells, f"{folder}/{RESULT}", f"{folder}/{STATE}", once)


def views(spark: SparkSession, folder: str, hour: str | None = None) -> dict[str, DataFrame]:
    """What a dashboard shows, from the delivered result."""
    path = f"{folder}/{RESULT}"
    rows = readers.read_result(spark, path)
    return {
        "kpi": serving.kpi(rows),
        "secteurs": serving.sector_alerts(rows),
        "situations": serving.top_situations(rows),
        "saturation": serving.page_for_hour(rows, hour),
        "sante": diagnostics.freshness(spark, path, rows),
    }
