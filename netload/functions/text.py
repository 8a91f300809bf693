"""Columns over raw JSON lines: everything stays a JVM expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from netload import schemas

# Fixed value: 1-based position and width of the hour inside a compact line
# that starts with {"ts":"YYYY-MM-DDTHH:
HOUR_POSITION, HOUR_WIDTH = 19, 2


def has_level(line: Column, level: str) -> Column:
    """Substring test on the unparsed line.

    Equal to the parsed test only for compact JSON: a line written with a
    space after the colon is missed here and kept by the parsed filter.
    """
    return line.contains(f'"niveau":"{level}"')


def hour_text(line: Column) -> Column:
    return F.substring(line, HOUR_POSITION, HOUR_WIDTH)


def not_blank(line: Column) -> Column:
    return F.trim(line) != ""


def json_field(line: Column, name: str) -> Column:
    """One field of the line, without building the whole record."""
    return F.get_json_object(line, f"$.{name}")


def parse_record(line: Column, ddl: str = schemas.TELEMETRY) -> Column:
    """The line as a struct; a line that is not JSON gives NULL fields."""
    return F.from_json(line, ddl)


def parse_with_rejects(line: Column, ddl: str = schemas.TELEMETRY) -> Column:
    """The line as a struct whose last field keeps the raw text of a bad line."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
    return F.from_json(line, schemas.with_rejects(ddl), options)


def to_line(*columns: str | Column) -> Column:
    """The columns as one compact JSON line, in the given order."""
    return F.to_json(F.struct(*columns))


def zero_padded(number: Column, width: int) -> Column:
    """Left-pads with zeros and, unlike a bare ``lpad``, never cuts a longer number."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def cell_name(number: Column) -> Column:
    return F.concat(F.lit("CELL_"), zero_padded(number, 4))
