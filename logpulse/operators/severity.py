"""Severity counts, rates and shares.

One global (or per-key) aggregate with a ``count_if`` per level: a single
scan, partial aggregation per task, one tiny final merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logpulse.constants import LEVELS, SHARE_ORDER
from logpulse.functions.columns import safe_ratio


def with_rates(counts: DataFrame) -> DataFrame:
    return counts.withColumns({
        "error_rate": safe_ratio(F.col("ERROR") + F.col("CRITICAL"), "total"),
        "warning_rate": safe_ratio("WARNING", "total"),
    })


def severity_counts(entries: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Dense counts for the five levels (0 if absent), ``total`` = all rows
    (unknown levels included), error and warning rates (0.0 when empty).

    Unkeyed, the result is always exactly one row, also for empty input.
    """
    counts = entries.groupBy(*keys).agg(
        *[F.count_if(F.col("level") == lv).alias(lv) for lv in LEVELS],
        F.count(F.lit(1)).alias("total"))
    return with_rates(counts)


def share_from_counts(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    stack_args = ", ".join(f"'{lv}', {i}, `{lv}`" for i, lv in enumerate(SHARE_ORDER, 1))
    long = counts.select(
        *keys, "total",
        F.expr(f"stack({len(SHARE_ORDER)}, {stack_args}) AS (level, level_order, count)"))
    return long.select(
        *keys, "level_order", "level", "count",
        (F.col("count") / F.greatest(F.col("total"), F.lit(1))).alias("share"))


def severity_share(entries: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per level, CRITICAL first: count and share of all rows
    (share uses ``total or 1``)."""
    return share_from_counts(severity_counts(entries, keys), keys)
