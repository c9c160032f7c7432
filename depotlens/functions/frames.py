"""Calendars without cross joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def fill_calendar(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    value: str,
    *,
    step_days: int = 1,
    first: Column | None = None,
    last: Column | None = None,
    partitions: int | None = None,
    carried: Mapping[str, Column] | None = None,
    own: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Give every key one row per calendar step, ``value`` being 0 on the steps that were missing.

    ``carried`` columns keep the value of the last row before a missing step, and have the given value
    before a key's first row; ``own`` columns have the given value on every missing step.

    ``df`` holds at most one row per key and day. Each row emits its own day and the gap up to the
    next row, so there is one shuffle on ``keys`` and neither a cross join with the calendar nor a
    join back. ``first``/``last`` stretch every series to a common range; without them a series
    keeps its own range.

    The shuffle moves the rows before they multiply, so adaptive coalescing, which goes by bytes,
    would leave the long calendars to a few tasks; ``partitions`` fixes the number instead.
    """
    if partitions:
        df = df.repartition(partitions, *keys)
    ordered = Window.partitionBy(*keys).orderBy(day)
    begins = F.lag(day).over(ordered).isNull()
    start = F.when(begins, first).otherwise(F.col(day)) if first is not None else F.col(day)
    ends = F.date_sub(F.lead(day).over(ordered), step_days)
    until = F.coalesce(ends, last if last is not None else F.col(day))
    zero = F.lit(0).cast(df.schema[value].dataType)
    # Day numbers, not timestamps: the calendar does not depend on the session time zone.
    offsets = F.sequence(F.lit(0), F.date_diff("_until", "_from"), F.lit(step_days))
    step = F.date_add("_from", F.col("_offset"))
    extra = [*(carried or {}), *(own or {})]
    here = step == F.col(day)
    filled = {name: F.when(step >= F.col(day), F.col(name)).otherwise(before) for name, before in (carried or {}).items()}
    filled |= {name: F.when(here, F.col(name)).otherwise(missing) for name, missing in (own or {}).items()}
    return (
        df.select(*keys, day, value, *extra, start.alias("_from"), until.alias("_until"))
        .select(*keys, day, value, *extra, "_from", F.explode(offsets).alias("_offset"))
        .select(
            *keys,
            step.alias(day),
            F.when(here, F.col(value)).otherwise(zero).alias(value),
            *(column.alias(name) for name, column in filled.items()),
        )
    )
