"""Report JSON sink and source with explicit schemas (no inference).

The header is one row in one file; the spikes are rows beside it, written by as many
tasks as they need. Both are published together (:mod:`logpulse.sources.published`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logpulse.constants import LEVELS
from logpulse.sources.published import publish, read_published

_TOP = T.StructType([
    T.StructField("message_prefix", T.StringType()),
    T.StructField("count", T.LongType()),
    T.StructField("pct_of_errors", T.DoubleType()),
])
REPORT_SPIKE_SCHEMA = T.StructType([
    T.StructField("window", T.StringType()),
    T.StructField("total_entries", T.LongType()),
    T.StructField("error_count", T.LongType()),
    T.StructField("error_rate", T.DoubleType()),
    T.StructField("severity", T.StringType()),
])
HEALTH_REPORT_SCHEMA = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("status_reason", T.StringType()),
    T.StructField("total_entries", T.LongType()),
    T.StructField("time_range", T.StructType([
        T.StructField("start", T.StringType()), T.StructField("end", T.StringType())])),
    T.StructField("severity_counts", T.StructType(
        [T.StructField(lv, T.LongType()) for lv in LEVELS]
        + [T.StructField("total", T.LongType()),
           T.StructField("error_rate", T.DoubleType()),
           T.StructField("warning_rate", T.DoubleType())])),
    T.StructField("error_rate_pct", T.DoubleType()),
    T.StructField("top_errors", T.ArrayType(_TOP)),
    T.StructField("spike_count", T.LongType()),
    T.StructField("recommendations", T.ArrayType(T.StringType())),
    T.StructField("generated_at", T.StringType()),
    T.StructField("hours_analysed", T.IntegerType()),
])


def write_report(report: DataFrame, path: str, spikes: DataFrame | None = None) -> int:
    """Publish the one-row report (JSON) with its spikes (JSON lines; none if not given) at ``path`` and
    return the publication's number. A reader sees one report or the next, header and spikes together; a
    failure on the way leaves the earlier report readable."""
    spark = report.sparkSession
    spikes = spikes if spikes is not None else spark.createDataFrame([], REPORT_SPIKE_SCHEMA)
    return publish(spark, path, {"header": report.coalesce(1), "spikes": spikes}, "json")


def read_report_spikes(spark: SparkSession, path: str) -> DataFrame:
    """The spikes stored with the report at ``path``, one row each."""
    return read_published(spark, path, "spikes", REPORT_SPIKE_SCHEMA, "json")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return read_published(spark, path, "header", HEALTH_REPORT_SCHEMA, "json")


def report_section(report: DataFrame, section: str) -> DataFrame:
    """One part of a stored report as rows: 'severity_counts', 'time_range'
    (struct fields as columns), 'top_errors' (one row per element, with a
    1-based ``rank``), or 'recommendations'. Spikes: :func:`read_report_spikes`."""
    if section in ("severity_counts", "time_range"):
        return report.select(f"{section}.*")
    if section == "top_errors":
        return (report.select(F.posexplode(section).alias("pos", "e"))
                .select((F.col("pos") + 1).alias("rank"), "e.*"))
    if section == "recommendations":
        return report.select(F.posexplode(section).alias("pos", "recommendation")) \
            .select((F.col("pos") + 1).alias("rec_no"), "recommendation")
    return report.select(section)
