"""Measures over the steps (trail marks) of a tracked operation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigilog.functions.times import parse_zulu


def mark_count(marks: Column) -> Column:
    """NULL for a missing list, 0 for an empty one."""
    return F.when(marks.isNotNull(), F.size(marks))


def any_incomplete(marks: Column) -> Column:
    """Three-valued: marks whose flags are all missing give NULL."""
    return F.when(mark_count(marks) > 0, F.exists(marks, lambda m: ~m["Complete"])).otherwise(
        F.lit(False)
    )


def total_elapsed(marks: Column) -> Column:
    """Sum of the durations, a missing one counting 0. An overflow gives NULL."""
    total = F.aggregate(
        marks,
        F.lit(0).cast("bigint"),
        lambda acc, m: F.try_add(acc, F.coalesce(m["ElapsedDuration"], F.lit(0).cast("bigint"))),
    )
    return F.when(mark_count(marks) > 0, total)


def first_mark_time(marks: Column, field: str) -> Column:
    return parse_zulu(F.try_element_at(marks, F.lit(1))[field])
