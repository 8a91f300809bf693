"""Timestamps and hours that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from netload.functions.text import zero_padded


def instant(text: Column) -> Column:
    """ISO text to TIMESTAMP, in UTC unless it names a zone; other text gives NULL instead of a failed job."""
    clock, zone = r"\d:\d", r"\d:\d.*(Z|z|[+-]\d|[A-Za-z]{2})"
    plain = F.trim(text)
    midnight = F.concat(plain.try_cast("date").cast("string"), F.lit("T00:00:00Z"))
    named = F.when(plain.endswith("Z") | plain.rlike(zone), plain)
    return F.try_to_timestamp(named.when(plain.rlike(clock), F.concat(plain, F.lit("Z"))).otherwise(midnight))


def utc_hour(ts: Column) -> Column:
    """Hour 0-23 in UTC of a TIMESTAMP, whatever ``spark.sql.session.timeZone`` says."""
    return F.pmod(F.floor(F.unix_seconds(ts) / 3600), F.lit(24)).cast("int")


def wall_hour(ts: Column) -> Column:
    """Hour 0-23 of a TIMESTAMP_NTZ, which carries no zone."""
    return F.hour(ts)


def iso_text(ts: Column) -> Column:
    """A TIMESTAMP_NTZ as ``YYYY-MM-DDTHH:MM:SS.mmmZ``, sub-millisecond digits cut.

    Built from the plain string form: ``date_format`` would pass through the
    session zone and shift hours that a DST change skips.
    """
    plain = ts.cast("string")
    millis = F.rpad(F.substring(plain, 21, 3), 3, "0")
    return F.concat(
        F.substring(plain, 1, 10), F.lit("T"), F.substring(plain, 12, 8), F.lit("."), millis, F.lit("Z")
    )


def iso_from_parts(day: str, hour: Column, minute: Column, second: Column, millis: Column) -> Column:
    """The same text assembled from numbers."""
    return F.concat(
        F.lit(day + "T"), zero_padded(hour, 2), F.lit(":"), zero_padded(minute, 2),
        F.lit(":"), zero_padded(second, 2), F.lit("."), zero_padded(millis, 3), F.lit("Z"),
    )
