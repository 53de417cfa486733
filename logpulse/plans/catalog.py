"""Registered queries: every operator run over the driver tables.

Each entry takes (spark, sf_dir) and returns a DataFrame over whole tables.
Parameters (fixed here so results repeat):

* unkeyed analyses use 1-hour windows, threshold 0.05, critical 0.10, n >= 10
  (5-minute windows hold too few events at small scale factors);
* keyed analyses use ``svc = user_id % 8``, 1-day windows, 0.20 / 0.25.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logpulse.constants import HealthParams
from logpulse.functions.columns import floor_time, normalise_level
from logpulse.operators import (
    base_recommendations,
    detect_spikes,
    enrich_entries,
    error_timeline,
    flatten_report,
    health_report,
    health_status,
    hourly_breakdown,
    hourly_stacked,
    incidents,
    number_rows,
    pages_to_text,
    report_aggregate,
    report_header,
    report_spikes,
    severity_counts,
    severity_share,
    spike_lift,
    status_check,
    status_transitions,
    time_range,
    top_errors,
    top_prefixes,
    window_error_rate,
    window_alerts,
    window_status_frame,
    worst_spike,
)
from logpulse.operators.windows import spikes_from_rates
from logpulse.sources import (
    app_lines_from_events,
    entries_from_events,
    hadoop_lines_from_events,
    parse_app_lines,
    parse_hadoop_lines,
    read_log_lines,
    read_report,
    read_report_spikes,
    read_table,
    reject_summary,
    report_section,
    union_sources,
    write_report,
)
from logpulse.sources.growing import LineLedger, log_lines
from logpulse.sources.logs import tag_hadoop_lines
from logpulse.session import shared_dir
from logpulse.streaming import AlertState, finished, land_entries, landed_entries, watch_entries, watcher_state

HOURLY = HealthParams(window="1 hour")
KEYED = HealthParams(window="1 day", error_rate_threshold=0.20, critical_rate=0.25)
RARE = KEYED.replace(error_rate_threshold=0.32, critical_rate=0.34)  # some services have no spike
N_SERVICES = 8
SVC = ["svc"]
AS_OF = "2024-01-29 00:00:00"
LOOKBACK_HOURS = 24

Query = Callable[[SparkSession, str], DataFrame]


def _entries(spark: SparkSession, sf: str, keyed: bool = False) -> DataFrame:
    return entries_from_events(read_table(spark, sf, "events"), N_SERVICES if keyed else None)


def _hadoop_lines(spark, sf):
    return hadoop_lines_from_events(read_table(spark, sf, "events"))


def _app_lines(spark, sf):
    return app_lines_from_events(read_table(spark, sf, "events"))


def q_parse_hadoop_logs(spark, sf):
    return parse_hadoop_lines(_hadoop_lines(spark, sf), line_col="line")


def q_parse_app_logs(spark, sf):
    return parse_app_lines(_app_lines(spark, sf), line_col="line")


def q_parse_rejects(spark, sf):
    return reject_summary(_hadoop_lines(spark, sf), by=["event_type"], line_col="line")


def q_parse_rejects_by_reason(spark, sf):
    # every day of the month put into February: days past the 29th are no dates
    feb = F.regexp_replace("line", r"^(\d{4})-\d{2}-", "$1-02-")
    return reject_summary(_hadoop_lines(spark, sf).withColumn("line", feb), by=["event_type"], line_col="line")


def q_normalise_levels(spark, sf):
    # regex-matched lines, impossible dates included (a non-match has an empty level)
    tagged = tag_hadoop_lines(_hadoop_lines(spark, sf), "line")
    raw = tagged.where(F.col("raw_level") != "")
    return (raw.groupBy("raw_level").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("level", normalise_level("raw_level")))


def q_recent_entries(spark, sf):
    return parse_app_lines(_app_lines(spark, sf), line_col="line",
                           hours=LOOKBACK_HOURS, as_of=AS_OF)


def q_union_sources(spark, sf):
    both = union_sources(("hadoop", q_parse_hadoop_logs(spark, sf)),
                         ("app", q_parse_app_logs(spark, sf)))
    return both.groupBy("source", "level").agg(F.count(F.lit(1)).alias("n"))


def q_enrich_entries(spark, sf):
    return enrich_entries(_entries(spark, sf), HOURLY.window)


def q_severity_counts(spark, sf):
    return severity_counts(_entries(spark, sf))


def q_severity_share(spark, sf):
    return severity_share(_entries(spark, sf))


def q_top_errors(spark, sf):
    return top_errors(_entries(spark, sf), HOURLY.top_errors_n, HOURLY.prefix_length)


def q_top_prefixes(spark, sf):
    return top_prefixes(read_table(spark, sf, "documents"), "text", 10, 60)


def q_top_errors_by_svc(spark, sf):
    return top_errors(_entries(spark, sf, keyed=True), 3, 60, keys=SVC)


def q_window_error_rate(spark, sf):
    return window_error_rate(_entries(spark, sf), HOURLY.window)


def q_detect_spikes(spark, sf):
    return detect_spikes(_entries(spark, sf), HOURLY)


def q_error_timeline(spark, sf):
    return error_timeline(_entries(spark, sf), HOURLY)


def q_hourly_breakdown(spark, sf):
    return hourly_breakdown(_entries(spark, sf))


def q_hourly_stacked(spark, sf):
    return hourly_stacked(_entries(spark, sf))


def q_time_range(spark, sf):
    return time_range(_entries(spark, sf))


def q_health_status(spark, sf):
    return health_status(detect_spikes(_entries(spark, sf), HOURLY), HOURLY)


def q_health_status_by_svc(spark, sf):
    rates = window_error_rate(_entries(spark, sf, keyed=True), KEYED.window, SVC)
    return health_status(spikes_from_rates(rates, RARE), RARE, SVC, known_keys=rates)


def q_worst_spike(spark, sf):
    return worst_spike(detect_spikes(_entries(spark, sf), HOURLY))


def q_spike_recommendations(spark, sf):
    return base_recommendations(report_aggregate(_entries(spark, sf), HOURLY), HOURLY)


def q_spike_lift(spark, sf):
    return spike_lift(_entries(spark, sf), HOURLY)


def q_window_status(spark, sf):
    return window_status_frame(_entries(spark, sf), HOURLY)


def q_window_status_by_svc(spark, sf):
    return window_status_frame(_entries(spark, sf, keyed=True), KEYED, SVC)


def q_status_transitions(spark, sf):
    return status_transitions(q_window_status(spark, sf))


def q_status_transitions_by_svc(spark, sf):
    return status_transitions(q_window_status_by_svc(spark, sf), SVC)


def q_incidents(spark, sf):
    return incidents(q_window_status(spark, sf))


def q_incidents_by_svc(spark, sf):
    return incidents(q_window_status_by_svc(spark, sf), SVC)


def _alerts(spark, sf, keyed):
    p, keys = (KEYED, SVC) if keyed else (HOURLY, [])
    return window_alerts(_entries(spark, sf, keyed), p, keys)


def q_alert_events(spark, sf):
    return _alerts(spark, sf, False)


def q_alert_events_by_svc(spark, sf):
    return _alerts(spark, sf, True)


def q_status_check(spark, sf):
    history = shared_dir(spark, "checks", "status_history")
    return status_check(_entries(spark, sf), history, HOURLY, as_of=AS_OF)


def q_status_check_history(spark, sf):
    """Four checks on one history: fires, silent, recovers (rules no window
    breaks), and an earlier check, which does not see the later ones."""
    history = shared_dir(spark, "checks", "status_history")
    entries = _entries(spark, sf)
    calm = HOURLY.replace(error_rate_threshold=1.0, critical_rate=1.0)
    checks = [(HOURLY, "2024-01-29 00:00:00"), (HOURLY, "2024-01-29 00:05:00"),
              (calm, "2024-01-29 00:10:00"), (HOURLY, "2024-01-28 00:00:00")]
    alerts = [status_check(entries, history, p, as_of=t) for p, t in checks]
    return reduce(DataFrame.unionByName, alerts)


def q_health_report(spark, sf):
    return flatten_report(health_report(_entries(spark, sf), HOURLY, as_of=AS_OF))


def _written_report(spark, sf):
    path = shared_dir(spark, "reports", "health_report")
    base = report_aggregate(_entries(spark, sf), HOURLY)
    write_report(report_header(base, HOURLY, as_of=AS_OF), path, report_spikes(base, HOURLY))
    return path


def q_report_fields(spark, sf):
    return report_section(read_report(spark, _written_report(spark, sf)), "top_errors")


def q_report_spikes(spark, sf):
    return read_report_spikes(spark, _written_report(spark, sf))


def q_html_to_text(spark, sf):
    return pages_to_text(read_table(spark, sf, "pages"))


def _event_stream(spark, sf):
    schema = read_table(spark, sf, "events").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
            .parquet(sf))


def q_stream_window_rates(spark, sf):
    stream = entries_from_events(_event_stream(spark, sf))
    query, landed, _ = land_entries(stream)
    finished(query)
    return window_error_rate(landed_entries(spark, landed, stream), HOURLY.window)


def q_stream_status_alerts(spark, sf):
    stream = entries_from_events(_event_stream(spark, sf), N_SERVICES)
    query, out, checkpoint = watch_entries(stream, KEYED, SVC, interval=None)
    finished(query)
    return watcher_state(spark, out, checkpoint, stream, KEYED, SVC).alerts()


def q_read_log_files(spark, sf):
    """Lines as text files, a fifth of them with bytes that are no UTF-8, read and parsed."""
    folder = shared_dir(spark, "logs", "files")
    damaged = F.concat("line", F.unhex(F.lit("FFC3")).cast("string"))
    lines = _hadoop_lines(spark, sf).select(F.when(F.col("event_id") % 5 == 0, damaged).otherwise(F.col("line")).alias("value"))
    lines.write.text(folder)
    entries = parse_hadoop_lines(read_log_lines(spark, folder, "*.txt"))
    return entries.drop("file_path")


def q_poll_log_files(spark, sf):
    """Two polls of a folder of log files, the second after half of the lines were added."""
    folder, lines = shared_dir(spark, "logs", "polled"), _hadoop_lines(spark, sf)
    ledger, taken = LineLedger(spark, shared_dir(spark, "logs", "ledger")), []
    for half in (0, 1):
        lines.where(F.col("event_id") % 2 == half).select(F.col("line").alias("value")).write.text(f"{folder}/half{half}")
        taken.append(ledger.poll(folder, "*.txt")[1])
        ledger.commit()
    entries = parse_hadoop_lines(log_lines(taken[0].unionByName(taken[1])))
    return window_error_rate(entries, HOURLY.window)


def q_late_rows_by_window(spark, sf):
    """Four batches, the days before the 9th two batches late and some rows of every day last: the windows
    after all of them, and how many rows of each came more than 36 hours behind."""
    entries = _entries(spark, sf)
    day = F.dayofmonth("timestamp")
    batch = (F.when(F.col("event_id") % 50 == 0, 3).when(day <= 8, 2).when(day <= 16, 0).when(day <= 24, 1).otherwise(3))
    state = AlertState(spark, shared_dir(spark, "streams", "late-state"), shared_dir(spark, "streams", "late-log"),
                       entries.schema, HOURLY, lateness="36 hours")
    for number in range(4):
        state.apply(entries.where(batch == number), number)
    late = (state.late_rows().groupBy(floor_time("timestamp", HOURLY.window).alias("window_start"))
            .agg(F.count(F.lit(1)).alias("late_rows")))
    rates = state.window_rates().select("window_start", "total_entries", "error_count")
    return rates.join(late, "window_start", "left").withColumn("late_rows", F.coalesce("late_rows", F.lit(0).cast("long")))


def q_numbered_entries(spark, sf):
    return number_rows(_entries(spark, sf), "timestamp", "event_id").select("event_id", "row_no")


def q_alert_events_own_texts(spark, sf):
    """Texts and looks from tables of the user's own; the way back to HEALTHY has no text, WARNING no look."""
    texts = spark.createDataFrame([("HEALTHY", "CRITICAL", "page the owner"), ("CRITICAL", "WARNING", "keep watching"),
                                   ("HEALTHY", "WARNING", None)], "prev_status string, status string, text string")
    looks = spark.createDataFrame([("CRITICAL", "#111111", ":fire:"), ("HEALTHY", "#222222", ":ok:")],
                                  "status string, colour string, emoji string")
    return window_alerts(_entries(spark, sf), HOURLY, texts=texts, looks=looks)


QUERIES: dict[str, Query] = {
    "parse_hadoop_logs": q_parse_hadoop_logs,
    "parse_app_logs": q_parse_app_logs,
    "parse_rejects": q_parse_rejects,
    "parse_rejects_by_reason": q_parse_rejects_by_reason,
    "normalise_levels": q_normalise_levels,
    "recent_entries": q_recent_entries,
    "union_sources": q_union_sources,
    "enrich_entries": q_enrich_entries,
    "severity_counts": q_severity_counts,
    "severity_share": q_severity_share,
    "top_errors": q_top_errors,
    "top_prefixes": q_top_prefixes,
    "top_errors_by_svc": q_top_errors_by_svc,
    "window_error_rate": q_window_error_rate,
    "detect_spikes": q_detect_spikes,
    "error_timeline": q_error_timeline,
    "hourly_breakdown": q_hourly_breakdown,
    "hourly_stacked": q_hourly_stacked,
    "time_range": q_time_range,
    "health_status": q_health_status,
    "health_status_by_svc": q_health_status_by_svc,
    "worst_spike": q_worst_spike,
    "spike_recommendations": q_spike_recommendations,
    "spike_lift": q_spike_lift,
    "window_status": q_window_status,
    "window_status_by_svc": q_window_status_by_svc,
    "status_transitions": q_status_transitions,
    "status_transitions_by_svc": q_status_transitions_by_svc,
    "incidents": q_incidents,
    "incidents_by_svc": q_incidents_by_svc,
    "alert_events": q_alert_events,
    "alert_events_by_svc": q_alert_events_by_svc,
    "status_check": q_status_check,
    "status_check_history": q_status_check_history,
    "health_report": q_health_report,
    "report_fields": q_report_fields,
    "report_spikes": q_report_spikes,
    "html_to_text": q_html_to_text,
    "stream_window_rates": q_stream_window_rates,
    "stream_status_alerts": q_stream_status_alerts,
    "read_log_files": q_read_log_files,
    "poll_log_files": q_poll_log_files,
    "late_rows_by_window": q_late_rows_by_window,
    "numbered_entries": q_numbered_entries,
    "alert_events_own_texts": q_alert_events_own_texts,
}
