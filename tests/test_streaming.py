"""Structured Streaming: stream = batch, late data, restart without re-alerting."""

import json
import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import SF_SMALL
from logpulse.constants import HealthParams
from logpulse.operators import window_error_rate
from logpulse.sources import entries_from_events, parse_hadoop_lines, read_table, stream_log_lines
from logpulse.jobs import check_job, log_watcher, report_job, watch_alerts
from logpulse.operators import window_alerts
from logpulse.sources import load_hadoop_logs
from logpulse.streaming import (
    dropped_late_rows,
    finished,
    land_entries,
    landed_entries,
    run_to_parquet,
    stream_window_rates,
    watch_entries,
    watcher_state,
)


def _split_events(spark, folder, n_parts=3):
    ev = read_table(spark, SF_SMALL, "events")
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).collect()[0]
    step = (hi - lo) / n_parts
    for i in range(n_parts):
        a, b = lo + step * i, lo + step * (i + 1)
        part = ev.where((F.col("ts") >= a) & ((F.col("ts") < b) if i < n_parts - 1 else F.lit(True)))
        part.coalesce(1).write.parquet(f"{folder}/part{i}")
    return ev, hi


def test_stream_equals_batch_across_micro_batches(spark, scratch):
    ev, max_ts = _split_events(spark, f"{scratch}/in")
    src = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1)
           .option("recursiveFileLookup", "true").parquet(f"{scratch}/in"))
    rates = stream_window_rates(entries_from_events(src), "1 hour", "10 minutes")
    out, _ = run_to_parquet(rates, "t", output=f"{scratch}/out", checkpoint=f"{scratch}/ck")
    got = sorted(spark.read.parquet(out).collect())
    cutoff = max_ts - timedelta(minutes=10)
    want = sorted(window_error_rate(entries_from_events(ev), "1 hour")
                  .where(F.col("window_end") <= F.lit(cutoff)).collect())
    assert len(got) > 0 and got == want


def test_late_rows_are_dropped_and_counted(spark, scratch):
    ev, max_ts = _split_events(spark, f"{scratch}/in", n_parts=2)
    entries_schema = ev.schema

    def run():
        src = spark.readStream.schema(entries_schema).option("recursiveFileLookup", "true").parquet(f"{scratch}/in")
        rates = stream_window_rates(entries_from_events(src), "1 day", "10 minutes")
        q = (rates.writeStream.format("parquet").outputMode("append")
             .option("path", f"{scratch}/out").option("checkpointLocation", f"{scratch}/ck")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        return dropped_late_rows(q)

    run()
    before = sorted(spark.read.parquet(f"{scratch}/out").collect())
    # three error events for the first day, long closed
    late = ev.limit(3).withColumn("ts", F.lit(datetime(2024, 1, 1, 12, 0)).cast("timestamp_ntz")) \
             .withColumn("event_type", F.lit("error"))
    late.coalesce(1).write.parquet(f"{scratch}/in/late")
    dropped = run()
    after = sorted(spark.read.parquet(f"{scratch}/out").collect())
    assert after == before
    assert dropped >= 1   # counts partially aggregated rows: a lower bound


def _hadoop_line(t, level, msg):
    return f"{t:%Y-%m-%d %H:%M:%S},000 {level} [main] app.Test: {msg}"


def _put(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.log", "w") as f:
        f.write("\n".join(rows) + "\n")


def _fixture_lines():
    from tests.test_reference_fixtures import spike_rows

    return [_hadoop_line(t, level, msg) for t, level, _, msg in spike_rows()]


def _changes(state):
    rows = state.alerts().collect()
    assert all(json.loads(r.payload)["attachments"][0]["color"] for r in rows)
    return sorted((r.window_start, r.prev_status, r.status, r.top_error) for r in rows)


def test_alerts_fire_once_over_restarts_and_follow_late_rows(spark, scratch):
    base, logs, message = datetime(2015, 10, 18, 21, 40, 0), f"{scratch}/logs", "ERROR IN CONTACTING RM."
    lines = _fixture_lines()
    _put(logs, "a", lines)

    def run():
        q, out, _ = watch_alerts(spark, logs, interval=None, output=f"{scratch}/alerts", checkpoint=f"{scratch}/ck")
        finished(q)
        return _changes(log_watcher(spark, output=out, checkpoint=f"{scratch}/ck")[1])

    first = run()
    assert first == [(base, "HEALTHY", "CRITICAL", message)]
    assert run() == first                     # restart, no new data: nothing re-emitted
    _put(logs, "b", [_hadoop_line(datetime(2015, 10, 19, 23, 0, 5), "INFO", "next day")])
    second = first + [(datetime(2015, 10, 19, 23, 0), "CRITICAL", "HEALTHY", None)]
    assert run() == second
    # two hours late, on the first day: the window after the spike was healthy
    _put(logs, "c", [_hadoop_line(base + timedelta(minutes=5, seconds=i), "INFO", "late") for i in range(20)])
    # it recovers there, so the alert of the next day is withdrawn
    assert run() == first + [(base + timedelta(minutes=5), "CRITICAL", "HEALTHY", None)]
    log = spark.read.parquet(f"{scratch}/alerts")
    assert [(r.op, r.window_start) for r in log.where("op <> 'insert'").collect()] == [("withdraw", datetime(2015, 10, 19, 23, 0))]


def test_file_limit_changes_nothing(spark, scratch):
    """Four files of one span, one a micro-batch: the rows and alerts of the batch operators."""
    start, logs = datetime(2024, 3, 1), f"{scratch}/logs"
    for node in range(4):
        _put(logs, f"node{node}", [
            _hadoop_line(start + timedelta(seconds=48 * i + node), "ERROR" if (i // 40 + node) % 3 == 0 else "INFO",
                         f"m{i % 3}") for i in range(300)])
    entries = parse_hadoop_lines(stream_log_lines(spark, logs, max_files_per_trigger=1))
    q, landed, _ = land_entries(entries, f"{scratch}/landed", checkpoint=f"{scratch}/ck1")
    finished(q)
    whole = load_hadoop_logs(spark, logs)
    got = window_error_rate(landed_entries(spark, landed, entries))
    assert sorted(got.collect()) == sorted(window_error_rate(whole).collect())
    assert got.agg(F.sum("total_entries")).collect()[0][0] == 1200
    q, out, ck = watch_entries(entries, interval=None, output=f"{scratch}/alerts", checkpoint=f"{scratch}/ck2")
    finished(q)
    state = watcher_state(spark, out, ck, entries)
    rates = state.window_rates().drop("top_error")
    assert sorted(tuple(r) for r in rates.collect()) == sorted(tuple(r) for r in window_error_rate(whole).collect())
    names = sorted(state.alerts().columns)
    assert sorted(map(str, state.alerts().select(names).collect())) == sorted(map(str, window_alerts(whole).select(names).collect()))


def test_backlog_of_many_windows_in_one_batch(spark, scratch):
    """Thousands of windows per key, and a window that does not divide the day."""
    rows = spark.range(40000).select(
        F.timestamp_add("SECOND", F.col("id").cast("int") * 300, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        .alias("timestamp"),
        F.when(F.col("id") % 70 < 20, "ERROR").otherwise("INFO").alias("level"), F.lit("T").alias("logger"),
        F.concat(F.lit("m"), (F.col("id") % 3).cast("string")).alias("message"),
        (F.col("id") % 2).cast("int").alias("svc"))
    rows.write.parquet(f"{scratch}/in")
    params = HealthParams(window="50 minutes", min_window_entries=2)
    stream = spark.readStream.schema(rows.schema).parquet(f"{scratch}/in")
    q, out, ck = watch_entries(stream, params, ["svc"], interval=None,
                               output=f"{scratch}/alerts", checkpoint=f"{scratch}/ck")
    finished(q)
    want = window_alerts(rows, params, ["svc"])
    cols = sorted(want.columns)
    got = sorted(watcher_state(spark, out, ck, stream, params, ["svc"]).alerts().select(*cols).collect(), key=str)
    assert len(got) > 500 and got == sorted(want.select(*cols).collect(), key=str)


def test_landed_entries_prune_dates_and_push_levels(spark, scratch):
    _put(f"{scratch}/logs", "a", _fixture_lines())
    entries = parse_hadoop_lines(stream_log_lines(spark, f"{scratch}/logs"))
    q, landed, _ = land_entries(entries, f"{scratch}/landed", checkpoint=f"{scratch}/ck")
    finished(q)
    errors = landed_entries(spark, landed, entries).where("date = DATE'2015-10-18' AND level IN ('ERROR', 'CRITICAL')")
    plan = errors._jdf.queryExecution().executedPlan().toString()
    assert "In(level, [CRITICAL,ERROR])" in plan.replace("ERROR,CRITICAL", "CRITICAL,ERROR")
    assert "PartitionFilters: [isnotnull(date" in plan and errors.count() == 15


def test_run_to_parquet_raises_on_late_rows(spark, scratch):
    import pytest

    _put(f"{scratch}/logs", "a", [_hadoop_line(datetime(2024, 1, 2), "INFO", "new")])

    def run(**kw):
        entries = parse_hadoop_lines(stream_log_lines(spark, f"{scratch}/logs"))
        return run_to_parquet(stream_window_rates(entries), "t", output=f"{scratch}/out",
                              checkpoint=f"{scratch}/ck", **kw)

    run()
    _put(f"{scratch}/logs", "b", [_hadoop_line(datetime(2024, 1, 1), "INFO", "old")])
    with pytest.raises(RuntimeError, match="later than the watermark"):
        run()
    _put(f"{scratch}/logs", "c", [_hadoop_line(datetime(2024, 1, 1), "INFO", "old")])
    run(allow_late=True)


def test_rows_dropped_before_the_kept_progress_raise_too(spark, scratch):
    import pytest

    for i, day in enumerate((5, 6, 1, 7, 8, 9)):  # the third file is late, one file a batch
        _put(f"{scratch}/logs", f"f{i}", [_hadoop_line(datetime(2024, 1, day), "INFO", "x")])
        os.utime(f"{scratch}/logs/f{i}.log", (1_700_000_000 + i, 1_700_000_000 + i))
    lines = stream_log_lines(spark, f"{scratch}/logs", max_files_per_trigger=1)

    def run(name, **kw):
        return run_to_parquet(stream_window_rates(parse_hadoop_lines(lines)), "t",
                              output=f"{scratch}/out{name}", checkpoint=f"{scratch}/ck{name}", **kw)

    key = "spark.sql.streaming.numRecentProgressUpdates"
    with pytest.raises(RuntimeError, match="later than the watermark and are not"):
        run("a")
    spark.conf.set(key, "2")
    try:
        with pytest.raises(RuntimeError, match="more batches than Spark keeps"):
            run("b")
        run("c", allow_late=True)
    finally:
        spark.conf.unset(key)


def test_jobs_over_a_log_directory(spark, scratch):
    logs = f"{scratch}/logs"
    _put(f"{logs}/node1", "app", [*_fixture_lines(), _hadoop_line(datetime(2015, 10, 18, 22, 30, 0), "INFO", "later")])
    rep = report_job(spark, logs, f"{scratch}/report", as_of="2015-10-19 00:00:00",
                     series=f"{scratch}/series").collect()[0]
    assert (rep.status, rep.total_entries, rep.spike_count) == ("CRITICAL", 126, 1)
    sizes = {name: spark.read.parquet(f"{scratch}/series/{name}").count()
             for name in ("hourly", "hourly_stacked", "timeline", "severity_share")}
    assert sizes == {"hourly": 3, "hourly_stacked": 15, "timeline": 1, "severity_share": 5}
    first = check_job(spark, logs, f"{scratch}/history", as_of="2015-10-18 23:00:00").collect()
    assert [(a.prev_status, a.status, a.top_error) for a in first] == [
        ("HEALTHY", "CRITICAL", "ERROR IN CONTACTING RM.")]
    assert check_job(spark, logs, f"{scratch}/history", as_of="2015-10-18 23:05:00").collect() == []


def test_report_and_series_come_from_one_scan(spark, scratch, monkeypatch):
    """Once the base aggregate is written the logs are gone, and everything else is there."""
    import shutil

    import logpulse.jobs as jobs
    from logpulse.operators import error_timeline, hourly_breakdown, hourly_stacked, severity_share

    logs = f"{scratch}/logs"
    _put(f"{logs}/node1", "app", [*_fixture_lines(), _hadoop_line(datetime(2015, 10, 18, 23, 30, 0), "INFO", "later"),
                                  _hadoop_line(datetime(2015, 10, 19, 23, 59, 59), "WARN", "last")])
    entries = spark.createDataFrame(load_hadoop_logs(spark, logs).collect(), load_hadoop_logs(spark, logs).schema)
    aggregate = jobs.report_aggregate

    def once(*args):
        base = aggregate(*args)
        shutil.rmtree(logs)
        return base

    monkeypatch.setattr(jobs, "report_aggregate", once)
    params = HealthParams(window="50 minutes")  # its windows lie over the hours' borders
    assert report_job(spark, logs, f"{scratch}/report", params, series=f"{scratch}/series").first().total_entries == 127
    for name, op in (("hourly", hourly_breakdown), ("hourly_stacked", hourly_stacked), ("severity_share", severity_share),
                     ("timeline", lambda e: error_timeline(e, params))):
        got = spark.read.parquet(f"{scratch}/series/{name}")
        want = op(entries)
        assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect())), name


def test_look_back_prunes_landed_dates(spark, scratch):
    from logpulse.sources import recent

    _put(f"{scratch}/logs", "a", [_hadoop_line(datetime(2024, 1, d, h), "INFO", f"{d} {h}") for d in range(1, 9) for h in (0, 9, 23)])
    entries = parse_hadoop_lines(stream_log_lines(spark, f"{scratch}/logs"))
    q, landed, _ = land_entries(entries, f"{scratch}/landed", checkpoint=f"{scratch}/ck")
    finished(q)
    for as_of, n in (("2024-01-08 00:00:00", 6), ("2024-01-08 09:00:01", 4), ("2024-01-09 23:00:00", 1)):
        back = recent(landed_entries(spark, landed, entries), 24, as_of)
        assert "date#" in back._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
        assert back.count() == n == recent(landed_entries(spark, landed, entries).drop("date"), 24, as_of).count()


def test_landed_batches_are_compacted(spark, scratch):
    from logpulse.streaming import compact_landed, compacted_entries

    for i in range(6):
        _put(f"{scratch}/logs", f"f{i}", [_hadoop_line(datetime(2024, 1, 1 + i % 2, i), "INFO", f"m{k}") for k in range(5)])
    entries = parse_hadoop_lines(stream_log_lines(spark, f"{scratch}/logs", max_files_per_trigger=1))
    q, landed, _ = land_entries(entries, f"{scratch}/landed", checkpoint=f"{scratch}/ck")
    finished(q)
    assert compact_landed(spark, landed, entries) == 1
    rows = lambda df: sorted(map(str, df.select("timestamp", "message", "batch", "date").collect()))
    assert rows(compacted_entries(spark, landed, entries)) == rows(landed_entries(spark, landed, entries))
    files = [f for _, _, fs in os.walk(f"{scratch}/landed-dates") for f in fs if f.startswith("part-")]
    assert len(files) <= 2 + 2  # two dates, and the pointer


def test_check_history_stays_few_files(spark, scratch, make_entries):
    from logpulse.operators import status_check

    bad = make_entries([(datetime(2024, 1, 1, 10, 0, i), "ERROR") for i in range(12)])
    fine = make_entries([(datetime(2024, 1, 1, 10, 0, i), "INFO") for i in range(12)])
    t0, fired = datetime(2024, 1, 2), []
    for i in range(12):
        rows = status_check(bad if i % 6 == 3 else fine, f"{scratch}/history", as_of=t0 + timedelta(hours=3 * i)).collect()
        fired += [(i, r.prev_status, r.status) for r in rows]
    assert fired == [(3, "HEALTHY", "CRITICAL"), (4, "CRITICAL", "HEALTHY"), (9, "HEALTHY", "CRITICAL"), (10, "CRITICAL", "HEALTHY")]
    assert status_check(bad, f"{scratch}/history", as_of=t0 + timedelta(hours=10)).count() == 0  # after the check of 9 h
    files = [f for _, _, fs in os.walk(f"{scratch}/history") for f in fs if f.startswith("part-")]
    assert len(files) <= 2 * 2  # two dates


def test_numbered_entries_follow_time_and_files(spark, scratch):
    from logpulse.operators import number_entries
    from logpulse.sources import read_log_lines

    for name in "ab":
        _put(f"{scratch}/logs", name, [_hadoop_line(datetime(2024, 1, 1, 0, i // 7), "INFO", f"{name}{i}") for i in range(60)])
    entries = parse_hadoop_lines(read_log_lines(spark, f"{scratch}/logs", with_position=True))
    rows = number_entries(entries).collect()
    assert sorted(r.row_no for r in rows) == list(range(1, 121))
    want = sorted((i // 7, name, i) for name in "ab" for i in range(60))
    assert [r.message for r in sorted(rows, key=lambda r: r.row_no)] == [f"{n}{i}" for _, n, i in want]


def test_lookups_keep_every_row_once(spark):
    from logpulse.operators import with_lookup

    rows = spark.createDataFrame([("a", 1), ("a", None), ("b", 2), (None, 1), ("c", 1), ("c", 1)], "k string, n int")
    table = spark.createDataFrame([("a", 1, "x"), ("a", None, "y"), ("a", 1, "w"), (None, 1, "z"), ("b", 2, None)], "k string, n int, v string")
    got = with_lookup(rows, table, ["k", "n"], "v", "out", F.lit("none"))
    assert sorted(map(str, ((r.k, r.n, r.out) for r in got.collect()))) == sorted(map(str, [
        ("a", 1, "w"), ("a", None, "y"), ("b", 2, "none"), (None, 1, "z"), ("c", 1, "none"), ("c", 1, "none")]))
