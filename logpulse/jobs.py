"""End-to-end runs over a log directory, composed from the operators.

* :func:`report_job` - scan + parse a directory of Hadoop-format logs, write the
  one-row health report as JSON and the chart series as tables (the batch run).
* :func:`check_job` - one status check of the directory against the saved
  status (the run-once alert).
* :func:`watch_alerts` - a continuous (or run-once) Structured Streaming query
  from the lines added to log files to the alert log (the alert watcher);
  :func:`poll_alerts` is one round of it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from logpulse.constants import HealthParams
from logpulse.operators.checks import status_check
from logpulse.operators.report import base_series, report_aggregate, report_header, report_spikes
from logpulse.session import shared_dir
from logpulse.sources.growing import LineLedger, log_lines
from logpulse.sources.logs import load_hadoop_logs, parse_hadoop_lines
from logpulse.sources.report_io import read_report, write_report
from logpulse.streaming.alert_state import AlertState


def report_job(spark: SparkSession, log_dir: str, output: str,
               params: HealthParams = HealthParams(), as_of: datetime | str | None = None,
               series: str | None = None) -> DataFrame:
    """Publish the health report of every ``*.log`` under ``log_dir``, with its spikes, at
    ``output`` and return it as read back. With ``series``, the tables behind the charts go below
    that folder: ``hourly``, ``hourly_stacked``, ``timeline`` and ``severity_share`` (Parquet,
    overwritten). The logs are read and parsed once, for one aggregate that all of it comes from."""
    base = report_aggregate(load_hadoop_logs(spark, log_dir), params)
    write_report(report_header(base, params, as_of), output, report_spikes(base, params))
    if series is not None:
        for name, table in base_series(base, params).items():
            table.write.mode("overwrite").parquet(f"{series.rstrip('/')}/{name}")
    return read_report(spark, output)


def check_job(spark: SparkSession, log_dir: str, history: str, params: HealthParams = HealthParams(),
              as_of: datetime | str | None = None) -> DataFrame:
    """Score every ``*.log`` under ``log_dir`` once, save the status to
    ``history`` and return the alert (no row when the status is unchanged)."""
    return status_check(load_hadoop_logs(spark, log_dir), history, params, as_of)


def poll_alerts(ledger: LineLedger, state: AlertState, log_dir: str, glob: str = "*.log") -> int:
    """One round of the watcher: take the lines that were added to the log files below ``log_dir`` since
    the last round, score the windows they touch and log the alerts that change. Returns the round's number.

    The ledger moves on last: a round that fails is run again, with the same number."""
    version, lines = ledger.poll(log_dir, glob)
    state.apply(parse_hadoop_lines(log_lines(lines)), version)
    return ledger.commit()


def log_watcher(spark: SparkSession, params: HealthParams = HealthParams(), output: str | None = None,
                checkpoint: str | None = None, lateness: str | None = None) -> tuple[LineLedger, AlertState, str]:
    """The ledger and state of a watcher over log files, and its checkpoint folder, which they belong to."""
    checkpoint = (checkpoint or shared_dir(spark, "streams", "logs-ckpt")).rstrip("/")
    output = output or shared_dir(spark, "streams", "alerts")
    entries = parse_hadoop_lines(spark.createDataFrame([], "value string"))
    state = AlertState(spark, f"{checkpoint}-state", output, entries.schema, params, lateness=lateness)
    return LineLedger(spark, f"{checkpoint}-lines"), state, checkpoint


def watch_alerts(spark: SparkSession, log_dir: str, params: HealthParams = HealthParams(),
                 interval: str | None = "300 seconds", output: str | None = None, checkpoint: str | None = None,
                 lateness: str | None = None, glob: str = "*.log"):
    """Start the alert watcher over the log files below ``log_dir``: every ``interval`` (None =
    once) the lines added since the last round are taken, from files that grew, were rotated or
    truncated as from new ones, the windows they touch scored again and the alert log brought up
    to date. Returns (query, alert log folder, checkpoint folder).

    Spark's clock source triggers the rounds; what was taken is in the ledger."""
    ledger, state, checkpoint = log_watcher(spark, params, output, checkpoint, lateness)
    clock = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", "1").load()
    writer = (clock.writeStream.foreachBatch(lambda _rows, _number: poll_alerts(ledger, state, log_dir, glob) and None)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start(), state.log, checkpoint
