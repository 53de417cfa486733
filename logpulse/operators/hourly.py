"""Hour-of-day activity by level."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logpulse.constants import LEVELS
from logpulse.operators.windows import level_counts


def hourly_breakdown(entries: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, hour, DEBUG..CRITICAL, total) for hours present in the data.

    ``total`` is the sum of the five known levels (unknown levels are not
    counted here, unlike the severity total). Rows without a timestamp or
    level form no group.
    """
    counts = (entries
              .where(F.col("timestamp").isNotNull() & F.col("level").isNotNull())
              .groupBy(*keys, F.hour("timestamp").alias("hour"))
              .agg(*level_counts()))
    return hours_wide(counts, keys)


def hours_wide(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, hour, DEBUG..CRITICAL, total) from counts ``n_<LEVEL>`` by hour."""
    renamed = [F.col(f"n_{lv}").alias(lv) for lv in LEVELS]
    total = sum((F.col(f"n_{lv}") for lv in LEVELS[1:]), F.col(f"n_{LEVELS[0]}"))
    return counts.select(*keys, "hour", *renamed, total.alias("total"))


def hourly_stacked(entries: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Long form of the breakdown for stacked bars: (keys, hour, level,
    level_order, count, bottom) where ``bottom`` is the running sum of the
    lower levels within the hour (0 for DEBUG).

    The running sum spans five known columns of one row, so it is computed
    as column arithmetic before unpivoting: no window, no extra shuffle.
    """
    return stack_hours(hourly_breakdown(entries, keys), keys)


def stack_hours(wide: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """:func:`hourly_stacked` from the breakdown."""
    parts, running = [], F.lit(0).cast("bigint")
    for i, lv in enumerate(LEVELS, 1):
        parts.append(F.struct(F.lit(lv).alias("level"), F.lit(i).alias("level_order"),
                              F.col(lv).alias("count"), running.alias("bottom")))
        running = running + F.col(lv)
    return (wide.select(*keys, "hour", F.explode(F.array(*parts)).alias("s"))
            .select(*keys, "hour", "s.*"))
