"""Health report from a single scan: a one-row header and a table of spikes.

Plan: one base aggregate over the entries on (window, hour, error prefix) - one scan,
one shuffle of partial aggregates - written to the shared folder. Its rows are
windows x prefixes, small beside the entries, and every part of the report is
rolled up from them: counts and time range, window rates and spikes, top errors, and
the chart series (hours, timeline, shares).
No join, no cross join.

The header holds bounded lists only: at most ``top_errors_n`` top errors and
``spike_advice_n`` + 1 recommendations, each taken by a top-n before it is put
into a list. The spikes are rows of a table of their own, as many as there are:
no list holds them all and none is left out.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logpulse.constants import LEVELS, HealthParams
from logpulse.functions.columns import (
    covered_hours,
    floor_time,
    is_error,
    message_prefix,
    minute_text,
    safe_ratio,
    second_text,
)
from logpulse.operators.hourly import hours_wide, stack_hours
from logpulse.operators.severity import share_from_counts
from logpulse.operators.status import spike_recommendations, status_from_spike_counts, status_reason
from logpulse.operators.top_errors import _rank_top
from logpulse.operators.windows import level_counts, rates_from_cube, spikes_from_rates, timeline_from_rates
from logpulse.session import shared_dir

_TOP = "struct<message_prefix:string,count:bigint,pct_of_errors:double>"


def report_aggregate(entries: DataFrame, params: HealthParams = HealthParams(),
                     path: str | None = None) -> DataFrame:
    """The base aggregate, written to ``path`` (default: a new folder below the
    session's shared folder) and read back: (window_start, hour, prefix, n_all, n_levelled,
    n_<LEVEL>..., first_ts, last_ts). Rows without an error prefix share the
    NULL prefix, rows without a timestamp the NULL window and hour. The report and all
    chart series are rolled up from it."""
    path = path or shared_dir(entries.sparkSession, "reports", "base")
    prefix = F.when(is_error("level"), message_prefix("message", params.prefix_length))
    base = (entries
            .groupBy(floor_time("timestamp", params.window).alias("window_start"), F.hour("timestamp").alias("hour"),
                     prefix.alias("prefix"))
            .agg(F.count(F.lit(1)).alias("n_all"), F.count("level").alias("n_levelled"), *level_counts(),
                 F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts")))
    base.write.mode("overwrite").parquet(path)
    return entries.sparkSession.read.schema(base.schema).parquet(path)


def _sums() -> list[Column]:
    return [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_all", *[f"n_{lv}" for lv in LEVELS])]


def _base_rates(base: DataFrame, params: HealthParams) -> DataFrame:
    cube = base.where(F.col("window_start").isNotNull()).groupBy("window_start").agg(*_sums())
    return rates_from_cube(cube, params.window)


def base_spikes(base: DataFrame, params: HealthParams = HealthParams()) -> DataFrame:
    """Spike windows (as ``detect_spikes``) from the base aggregate."""
    return spikes_from_rates(_base_rates(base, params), params)


def base_series(base: DataFrame, params: HealthParams = HealthParams()) -> dict[str, DataFrame]:
    """The tables behind the charts from the base aggregate: ``hourly``, ``hourly_stacked``, ``timeline``
    and ``severity_share``, as the operators of these names give them."""
    hours = (base.where(F.col("hour").isNotNull()).groupBy("hour").agg(*_sums(), F.sum("n_levelled").alias("n_levelled"))
             .where(F.col("n_levelled") > 0))
    hourly = hours_wide(hours)
    totals = base.agg(*_sums()).select(*[F.col(f"n_{lv}").alias(lv) for lv in LEVELS], F.col("n_all").alias("total"))
    return {"hourly": hourly, "hourly_stacked": stack_hours(hourly),
            "timeline": timeline_from_rates(_base_rates(base, params), params), "severity_share": share_from_counts(totals)}


def base_top_errors(base: DataFrame, params: HealthParams = HealthParams()) -> DataFrame:
    """(rank, message_prefix, count) of the top errors from the base aggregate."""
    counts = base.groupBy("prefix").agg(F.sum("n_all").alias("count"))
    return _rank_top(counts, params.top_errors_n, ()).withColumnRenamed("prefix", "message_prefix")


def base_recommendations(base: DataFrame, params: HealthParams = HealthParams()) -> DataFrame:
    """(rec_no, recommendation) from the base aggregate."""
    return spike_recommendations(base_spikes(base, params), base_top_errors(base, params), params)


def report_spikes(base: DataFrame, params: HealthParams = HealthParams()) -> DataFrame:
    """The spikes as stored with the report: window as text, one row each."""
    return base_spikes(base, params).select(
        second_text("window_start").alias("window"), "total_entries", "error_count", "error_rate", "severity")


def report_header(base: DataFrame, params: HealthParams = HealthParams(),
                  as_of: datetime | str | None = None) -> DataFrame:
    """The one-row header: status, reason, counts, time range, top errors,
    number of spikes, recommendations, generation time and covered hours."""
    p = params
    spikes = base_spikes(base, p).agg(F.struct(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("severity") == "critical").alias("critical")).alias("s"))
    # both lists come from a top-n: at most top_errors_n and spike_advice_n + 1 elements
    top = base_top_errors(base, p).agg(F.sort_array(F.collect_list(
        F.struct("rank", "message_prefix", "count"))).alias("t"))
    recs = base_recommendations(base, p).agg(F.sort_array(F.collect_list(
        F.struct("rec_no", "recommendation"))).alias("r"))
    summary = base.agg(*_sums(), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    n_errors = F.col("n_ERROR") + F.col("n_CRITICAL")
    n_spikes = F.col("_spikes.n")
    status = status_from_spike_counts(n_spikes, F.col("_spikes.critical"))
    error_rate = safe_ratio(n_errors, "n_all")
    severity = F.struct(*[F.col(f"n_{lv}").alias(lv) for lv in LEVELS], F.col("n_all").alias("total"),
                        error_rate.alias("error_rate"), safe_ratio("n_WARNING", "n_all").alias("warning_rate"))
    generated = (F.lit(str(as_of)).cast("timestamp_ntz") if as_of is not None else F.localtimestamp())
    top_list = F.transform("_top", lambda x: F.struct(
        x["message_prefix"].alias("message_prefix"), x["count"].alias("count"),
        (x["count"] / n_errors).alias("pct_of_errors"))).cast(f"array<{_TOP}>")
    # subqueries are attached as columns first: they may not sit inside a lambda
    return (summary.withColumns({"_spikes": spikes.scalar(), "_top": top.scalar(), "_recs": recs.scalar()})
            .select(
                status.alias("status"),
                status_reason(status, n_spikes, p).alias("status_reason"),
                F.col("n_all").alias("total_entries"),
                F.when(F.col("first_ts").isNotNull(),
                       F.struct(minute_text("first_ts").alias("start"),
                                minute_text("last_ts").alias("end"))).alias("time_range"),
                severity.alias("severity_counts"),
                F.round(error_rate * 100, 2).alias("error_rate_pct"),
                top_list.alias("top_errors"),
                n_spikes.alias("spike_count"),
                F.transform("_recs", lambda r: r["recommendation"]).alias("recommendations"),
                second_text(generated).alias("generated_at"),
                covered_hours("first_ts", "last_ts").alias("hours_analysed"),
            ))


def health_report(entries: DataFrame, params: HealthParams = HealthParams(),
                  as_of: datetime | str | None = None) -> DataFrame:
    """The report's header for ``entries``. With the spikes: take
    :func:`report_aggregate` once and both tables from it."""
    return report_header(report_aggregate(entries, params), params, as_of)


def _first(arr: str) -> Column:
    return F.try_element_at(F.col(arr), F.lit(1))


def flatten_report(report: DataFrame) -> DataFrame:
    """Scalar view of the report (for tabular checks and dashboards)."""
    return report.select(
        "status", "status_reason", "total_entries",
        F.col("time_range.start").alias("time_start"), F.col("time_range.end").alias("time_end"),
        *[F.col(f"severity_counts.{lv}").alias(lv) for lv in LEVELS],
        F.col("severity_counts.error_rate").alias("error_rate"),
        F.col("severity_counts.warning_rate").alias("warning_rate"),
        "error_rate_pct",
        F.size("top_errors").alias("n_top_errors"),
        _first("top_errors")["message_prefix"].alias("top_error_prefix"),
        _first("top_errors")["count"].alias("top_error_count"),
        _first("top_errors")["pct_of_errors"].alias("top_error_share"),
        "spike_count",
        F.size("recommendations").alias("n_recommendations"),
        _first("recommendations").alias("first_recommendation"),
        "generated_at", "hours_analysed",
    )
