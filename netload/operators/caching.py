"""Reuse of a computed table across several actions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from netload import scratch


@contextmanager
def kept(rows: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK, fill: bool = True) -> Iterator[DataFrame]:
    """Keeps ``rows`` for the block and releases them afterwards.

    ``persist`` alone computes nothing, so the block starts with one action
    unless ``fill`` is off. Blocks lost with an executor are recomputed from
    the plan.
    """
    rows.persist(level)
    try:
        if fill:
            rows.count()
        yield rows
    finally:
        rows.unpersist()


def answered(rows: DataFrame, answers: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``answers`` makes of the kept rows, written to the scratch folder and read back.

    The rows are computed once for all uses, and released as soon as the answers are
    written: what is returned no longer depends on them. Runs jobs.
    """
    with kept(rows, fill=False) as parent:
        return scratch.kept(answers(parent), "answers")
