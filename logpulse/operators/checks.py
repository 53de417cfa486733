"""Run-once status check with a saved state (the cron form of alerting).

Each check scores the whole input (overall health status and worst spike),
compares it with the status saved by the previous check (HEALTHY when there
is none) and returns an alert row only when it changed. The state is a history
table, one row per check with an id of its own, kept by date: a check replaces its
own date's few rows by a turn of its own, so a date is two small files however
many checks it has, nothing is overwritten while it is read, and a check that fails
leaves the history as it was. The previous status is the latest row not after
``as_of``. The answer is the row of this check alone, whatever later checks are in the
history; a re-run with the same ``as_of`` finds its first run and stays silent. Only
a missing history counts as none: any other read failure is raised. One check at a
time may write to a history.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logpulse.constants import HealthParams
from logpulse.functions.columns import minute_text, percent_text, status_colour, status_emoji, transition_text
from logpulse.operators.status import (
    alert_payload,
    health_status,
    window_prefix_counts,
    worst_spike,
)
from logpulse.operators.windows import spikes_from_rates
from logpulse.sources.published import DatedTable

HISTORY_SCHEMA = T.StructType([
    T.StructField("checked_at", T.TimestampNTZType()),
    T.StructField("prev_status", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("spike_count", T.LongType()),
    T.StructField("window_start", T.TimestampNTZType()),
    T.StructField("total_entries", T.LongType()),
    T.StructField("error_count", T.LongType()),
    T.StructField("error_rate", T.DoubleType()),
    T.StructField("check_id", T.StringType()),
    T.StructField("top_error", T.StringType()),
])


def history(spark: SparkSession, path: str) -> DatedTable:
    return DatedTable(spark, path, T.StructType([*HISTORY_SCHEMA.fields, T.StructField("date", T.DateType())]))


def status_check(entries: DataFrame, history_path: str, params: HealthParams = HealthParams(),
                 as_of: datetime | str | None = None, initial: str = "HEALTHY") -> DataFrame:
    """Score ``entries``, append the check to ``history_path``, return the
    alert (0 or 1 row): prev_status, status, spike_count, the worst spike's
    window and counts, the most frequent error prefix of all entries,
    transition text and chat payload."""
    spark = entries.sparkSession
    base = window_prefix_counts(entries, params)
    rates = (base.groupBy("window_start")
             .agg(F.sum("n").alias("total_entries"), F.sum("e").alias("error_count"))
             .where(F.when(F.col("total_entries") > 0, F.col("window_start")).isNotNull())
             .withColumn("error_rate", F.col("error_count") / F.col("total_entries")))
    spikes = spikes_from_rates(rates, params)
    top = (base.groupBy("p").agg(F.sum("n").alias("n"), F.sum("e").alias("e"))
           .agg(F.min_by("p", F.when(F.col("p").isNotNull(), F.struct((-F.col("n")).alias("nn"), F.col("p"), F.col("e"))))
                .alias("top_error")))
    status = health_status(spikes, params).select("status", "spike_count")
    worst = worst_spike(spikes).select("window_start", "total_entries", "error_count", "error_rate")
    at = F.lit(str(as_of)).cast("timestamp_ntz") if as_of is not None else F.localtimestamp()
    at = spark.range(1).select(at).first()[0]
    checked_at = F.lit(at).cast("timestamp_ntz")
    table = history(spark, history_path)
    prev = (table.read().where((F.col("date") <= F.lit(at.date())) & (F.col("checked_at") <= checked_at))
            .orderBy(F.col("checked_at").desc(), F.col("check_id").desc()).limit(1).select("status"))
    w = worst.select(F.struct(*worst.columns).alias("w")).scalar()  # NULL without spikes
    row = status.select(checked_at.alias("checked_at"),
                        F.coalesce(prev.scalar(), F.lit(initial)).alias("prev_status"),
                        "status", "spike_count",
                        *[w[c].alias(c) for c in worst.columns],
                        F.lit(uuid.uuid4().hex).alias("check_id"), top.scalar().alias("top_error"))
    check = spark.createDataFrame([row.first()], HISTORY_SCHEMA)  # the one row of this check
    today = table.read(dates=[at.date()])
    table.replace(today.unionByName(check.withColumn("date", F.lit(at.date()))).coalesce(1), table.next_version(at.date()), [at.date()])
    own = check.drop("check_id")
    alert = own.where(F.col("prev_status") != F.col("status")).withColumns({
        "transition": transition_text("prev_status", "status"),
        "worst_window": minute_text("window_start"),
        "worst_rate_text": percent_text("error_rate"),
    })
    alert = alert.withColumns({"colour": status_colour("status"), "emoji": status_emoji("status")})
    return alert.withColumn("payload", alert_payload(params, minute_text("checked_at"))).drop("colour", "emoji")
