"""Size, rate and duration expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeshift.functions.cells import col

GIB = 1024**3
MIB = 1024**2
SIZE_TOLERANCE = 0.01


def size_match_rel(source, dest) -> Column:
    """Table rule: relative difference strictly below the tolerance."""
    source, dest = col(source), col(dest)
    return F.abs(source - dest) / F.greatest(source, F.lit(1)) < SIZE_TOLERANCE


def size_match_abs(source, dest) -> Column:
    """Folder rule: difference up to the tolerance (truncated), at least one byte."""
    source, dest = col(source), col(dest)
    allowed = F.greatest(F.lit(1).cast("bigint"), (source * SIZE_TOLERANCE).cast("bigint"))
    return F.abs(source - dest) <= allowed


def growth(before, after, clamp: bool = False) -> Column:
    delta = col(after) - col(before)
    return F.greatest(delta, F.lit(0)) if clamp else delta


def zero(c) -> Column:
    return F.coalesce(col(c), F.lit(0))


def or_one(c) -> Column:
    """Divisor guard: null and zero become one."""
    c = col(c)
    return F.when(c.isNull() | (c == 0), F.lit(1.0)).otherwise(c)


def gib(c) -> Column:
    return zero(c) / GIB


def speed_mib(size, seconds) -> Column:
    return zero(size) / MIB / or_one(seconds)


def rows_per_second(rows, seconds) -> Column:
    return zero(rows) / or_one(seconds)


def size_difference_pct(source, dest) -> Column:
    source, dest = zero(source), zero(dest)
    return F.when(source > 0, F.abs(source - dest) / F.nullif(source, F.lit(0)) * 100).otherwise(0.0)


def total_duration(*seconds) -> Column:
    total = zero(seconds[0])
    for s in seconds[1:]:
        total = total + zero(s)
    return total


def parse_ts(c) -> Column:
    return F.try_to_timestamp(col(c))


def duration_seconds(start, end) -> Column:
    return F.timestamp_diff("SECOND", col(start), col(end))
