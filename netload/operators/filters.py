"""Row filters and projections. All are column expressions, so Catalyst merges
them and pushes them into the scan."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from netload import schemas
from netload.functions import text
from netload.operators import projections


def of_level(records: DataFrame, level: str) -> DataFrame:
    return records.filter(F.col("niveau") == level)


def above(records: DataFrame, column: str, limit: float) -> DataFrame:
    """Strictly above; the limit itself is excluded."""
    return records.filter(F.col(column) > limit)


def other_than(records: DataFrame, column: str, value: str) -> DataFrame:
    """Keeps rows whose value differs, NULL included (a bare ``!=`` would drop NULL)."""
    return records.filter(~F.col(column).eqNullSafe(value))


def lines_of_level(lines: DataFrame, level: str) -> DataFrame:
    """Raw-text test, before any parsing."""
    return lines.filter(text.has_level(F.col("value"), level))


def lines_not_of_level(lines: DataFrame, level: str) -> DataFrame:
    return lines.filter(~text.has_level(F.col("value"), level))


def non_blank_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(text.not_blank(F.col("value")))


def parsed(lines: DataFrame, ddl: str = schemas.TELEMETRY) -> DataFrame:
    """Text lines to columns, parsed once per line; name only the fields you need."""
    record = text.parse_record(F.col("value"), ddl)
    return projections.computed_once(lines.select("value"), r=record).select("r.*")


def long_lines(lines: DataFrame, characters: int = 100) -> DataFrame:
    """Lengths of the lines longer than the limit."""
    return lines.select(F.length("value").alias("longueur")).filter(F.col("longueur") > characters)


def key_value(records: DataFrame, key: str, value: str | Column) -> DataFrame:
    """Keeps only what a per-key computation needs; the scan reads nothing else."""
    return records.select(key, value)


def level_measure_projection(
    records: DataFrame, level: str, measure: str, limit: float, key: str = "cell_id"
) -> DataFrame:
    """``key, measure`` where the level matches and the measure exceeds the limit."""
    return above(of_level(records, level), measure, limit).select(key, measure)


def at_hour(rows: DataFrame, hour: str | None) -> DataFrame:
    """Optional hour parameter as text: absent keeps all rows, ``"08"`` is not hour 8."""
    if hour is None:
        return rows
    canonical = hour.isascii() and hour.isdigit() and str(int(hour)) == hour and int(hour) < 24
    return rows.filter(F.col("heure") == int(hour)) if canonical else rows.filter(F.lit(False))


@F.arrow_udf(BooleanType())
def big_payload_udf(octets: pa.Array) -> pa.Array:
    """Twin of ``octets > 1000000`` in Python, a batch at a time, kept to show what a UDF costs:
    the optimizer cannot look inside, so nothing but the level reaches the scan."""
    return pc.fill_null(pc.greater(octets, 1_000_000), False)
