"""Added columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are evaluated once per row, whatever is built on them.

    A plain projection is merged into the next one and copied into every
    expression and pushed-down filter that mentions it; a parse or a long
    case expression then runs several times, in code too large to compile.
    ``inline`` stops the merging. All its columns are evaluated together, so
    keep those with different users apart.
    """
    fields = [column.alias(name) for name, column in columns.items()]
    return rows.select("*", F.inline(F.array(F.struct(*fields))))
