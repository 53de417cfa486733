"""Tumbling-window error rates, spikes, timeline, per-window status, lift.

Each analysis is one ``groupBy(keys, window_start)`` whose partial
aggregation runs map-side, so only (tasks x windows) small rows cross the
shuffle no matter how many raw entries there are or how skewed a window is;
the result is bounded by keys x (time span / window length), not by data
volume. :func:`window_cube` adds a count per level; :func:`spike_lift` takes its overall rate from the same aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logpulse.constants import LEVELS, HealthParams
from logpulse.functions.columns import (
    add_duration,
    floor_time,
    is_error,
    safe_ratio,
    spike_severity,
    window_status,
)
from logpulse.operators.keys import join_on_keys


def level_counts() -> list[Column]:
    return [F.count_if(F.col("level") == lv).alias(f"n_{lv}") for lv in LEVELS]


def window_cube(entries: DataFrame, window: str = "5 minutes",
                keys: Sequence[str] = ()) -> DataFrame:
    """(keys, window_start, n_all, n_<LEVEL>..., first_ts, last_ts).

    Rows with a NULL timestamp form the ``window_start IS NULL`` group, so
    totals over the cube still count them.
    """
    return (entries
            .groupBy(*keys, floor_time("timestamp", window).alias("window_start"))
            .agg(F.count(F.lit(1)).alias("n_all"), *level_counts(),
                 F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts")))


def rates_from_cube(cube: DataFrame, window: str, keys: Sequence[str] = ()) -> DataFrame:
    err = F.col("n_ERROR") + F.col("n_CRITICAL")
    return (cube.where(F.col("window_start").isNotNull())
            .select(*keys, "window_start",
                    add_duration("window_start", window).alias("window_end"),
                    F.col("n_all").alias("total_entries"),
                    err.alias("error_count"),
                    (err / F.col("n_all")).alias("error_rate")))


def window_error_rate(entries: DataFrame, window: str = "5 minutes",
                      keys: Sequence[str] = ()) -> DataFrame:
    """Entries and errors per populated tumbling window; rate = errors / entries.

    Uses only ``timestamp`` and ``level``; a direct count + count_if
    aggregate (the cube's level columns are not needed here).
    """
    return (entries
            .where(F.col("timestamp").isNotNull())
            .groupBy(*keys, floor_time("timestamp", window).alias("window_start"))
            .agg(F.count(F.lit(1)).alias("total_entries"),
                 F.count_if(is_error("level")).alias("error_count"))
            .select(*keys, "window_start",
                    add_duration("window_start", window).alias("window_end"),
                    "total_entries", "error_count",
                    (F.col("error_count") / F.col("total_entries")).alias("error_rate")))


def spikes_from_rates(rates: DataFrame, p: HealthParams) -> DataFrame:
    return (rates
            .where((F.col("error_rate") > F.lit(p.error_rate_threshold))
                   & (F.col("total_entries") >= p.min_window_entries))
            .withColumn("severity", spike_severity("error_rate", p.critical_rate)))


def detect_spikes(entries: DataFrame, params: HealthParams = HealthParams(),
                  keys: Sequence[str] = ()) -> DataFrame:
    """Windows with ``error_rate > threshold`` and at least ``min_window_entries``
    rows; severity 'warning' below ``critical_rate``, else 'critical'."""
    return spikes_from_rates(window_error_rate(entries, params.window, keys), params)


def error_timeline(entries: DataFrame, params: HealthParams = HealthParams(),
                   keys: Sequence[str] = ()) -> DataFrame:
    """Windows with at least ``min_window_entries`` rows; ``above_threshold`` uses
    ``>=`` (the chart colouring rule, unlike the strict spike test)."""
    return timeline_from_rates(window_error_rate(entries, params.window, keys), params)


def timeline_from_rates(rates: DataFrame, params: HealthParams) -> DataFrame:
    return (rates
            .where(F.col("total_entries") >= params.min_window_entries)
            .withColumn("above_threshold",
                        F.col("error_rate") >= F.lit(params.error_rate_threshold)))


def status_from_rates(rates: DataFrame, p: HealthParams) -> DataFrame:
    return rates.withColumn(
        "status", window_status("total_entries", "error_rate", p.error_rate_threshold,
                                p.critical_rate, p.min_window_entries))


def window_status_frame(entries: DataFrame, params: HealthParams = HealthParams(),
                        keys: Sequence[str] = ()) -> DataFrame:
    """Every populated window with its status (HEALTHY / WARNING / CRITICAL)."""
    return status_from_rates(window_error_rate(entries, params.window, keys), params)


def spike_lift(entries: DataFrame, params: HealthParams = HealthParams(),
               keys: Sequence[str] = ()) -> DataFrame:
    """Spike windows with their rate relative to the overall error rate.

    One scan, one shuffle: window counts keep the NULL-timestamp group (it
    belongs in the overall rate) and the overall rate is summed from the
    same aggregate - a scalar subquery unkeyed, a join on keys otherwise -
    so Spark reuses the exchange instead of scanning the entries again.
    """
    counts = (entries
              .groupBy(*keys, floor_time("timestamp", params.window).alias("window_start"))
              .agg(F.count(F.lit(1)).alias("total_entries"),
                   F.count_if(is_error("level")).alias("error_count")))
    totals = counts.groupBy(*keys).agg(
        safe_ratio(F.sum("error_count"), F.sum("total_entries")).alias("overall_error_rate"))
    # The NULL-window test references an aggregate output so that it stays
    # above the aggregate (a pushed-down filter would change its plan).
    populated = F.when(F.col("total_entries") > 0, F.col("window_start")).isNotNull()
    rates = counts.where(populated).withColumn(
        "error_rate", F.col("error_count") / F.col("total_entries"))
    spikes = spikes_from_rates(rates, params)
    if keys:
        spikes = join_on_keys(spikes, totals, keys)
        overall = F.col("overall_error_rate")
    else:
        overall = totals.select("overall_error_rate").scalar()
        spikes = spikes.withColumn("overall_error_rate", overall)
    return spikes.select(
        *keys, "window_start", "total_entries", "error_count", "error_rate", "severity",
        "overall_error_rate",
        F.when(overall > 0, F.col("error_rate") / overall).alias("lift"))
