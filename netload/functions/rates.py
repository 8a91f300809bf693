"""Load rate, means and the dashboard's severity bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Alert threshold (strict) and band limits, in percent, and the
# placeholder shown when there is no critical cell.
SATURATION_THRESHOLD = 70.0
BAND_ALERT, BAND_WARN = 100.0, 85.0
NO_CELL = "—"


def mean_of(total: Column, n: Column) -> Column:
    """Final step of a mergeable mean; an empty group gives NULL."""
    return F.try_divide(total, n)


def load_rate(mean_connections: Column, capacity: Column) -> Column:
    """Percentage of nominal capacity, 2 decimals.

    The input is the mean already rounded to one decimal: the double rounding
    is part of the result's contract. Zero or missing capacity gives NULL, and
    a rate above 100 is an overloaded cell, not an error.
    """
    return F.round(F.try_divide(100 * mean_connections, capacity), 2)


def band(rate: Column) -> Column:
    return F.when(rate >= BAND_ALERT, "alerte").when(rate >= BAND_WARN, "warn").otherwise("ok")
