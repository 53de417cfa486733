"""Adaptor from an ``events`` table to log entries and log lines.

``events(event_id, ts, user_id, event_type, value, props)`` is mapped to the
entry shape so every operator can run on table data:

* level: error -> CRITICAL when ``value >= 100`` else ERROR; purchase ->
  WARNING; view -> DEBUG; anything else -> INFO
* logger = event_type, message = ``event_type || ' ' || props``
* timestamp = ts floored to the second (log timestamps carry no fraction)

It can also render the same events as text lines in the Hadoop or app
format, to drive the parsers with data whose volume grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logpulse.functions.columns import floor_time


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _event_level() -> Column:
    et = F.col("event_type")
    return (F.when(et == "error", F.when(F.col("value") >= 100, "CRITICAL").otherwise("ERROR"))
            .when(et == "purchase", "WARNING")
            .when(et == "view", "DEBUG")
            .otherwise("INFO"))


def entries_from_events(events: DataFrame, n_services: int | None = None) -> DataFrame:
    """events -> (event_id, timestamp, level, logger, message[, svc]).

    ``n_services`` adds ``svc = user_id % n_services`` as a grouping key for
    keyed (per-service) analyses.
    """
    cols = [
        F.col("event_id"),
        floor_time("ts", "1 second").alias("timestamp"),
        _event_level().alias("level"),
        F.col("event_type").alias("logger"),
        F.concat(F.col("event_type"), F.lit(" "), F.col("props")).alias("message"),
    ]
    if n_services:
        cols.append(F.pmod(F.col("user_id"), F.lit(n_services)).cast("int").alias("svc"))
    return events.select(*cols)


def _hadoop_raw_level() -> Column:
    et = F.col("event_type")
    return (F.when(et == "error", "ERROR").when(et == "signup", "FATAL")
            .when(et == "purchase", "WARN").when(et == "view", "DEBUG")
            .otherwise("INFO"))


def hadoop_lines_from_events(events: DataFrame) -> DataFrame:
    """events -> (event_id, event_type, line) in Hadoop format.

    ``view`` events get level DEBUG, which the Hadoop parser rejects, so the
    reject path is exercised on every run.
    """
    line = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"), F.lit(" "),
        _hadoop_raw_level(), F.lit(" [user "), F.col("user_id").cast("string"),
        F.lit("] app.svc."), F.col("event_type"), F.lit(": "),
        F.col("event_type"), F.lit(" "), F.col("props"),
    )
    return events.select("event_id", "event_type", line.alias("line"))


def app_lines_from_events(events: DataFrame) -> DataFrame:
    """events -> (event_id, event_type, line) in the em-dash app format."""
    line = F.concat(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(" — "),
        _event_level(), F.lit(" — app."), F.col("event_type"), F.lit(" — "),
        F.col("event_type"), F.lit(" "), F.col("props"),
    )
    return events.select("event_id", "event_type", line.alias("line"))
