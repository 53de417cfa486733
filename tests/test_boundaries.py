"""Threshold, minimum-size, tie, null and empty-input boundaries."""

from datetime import datetime, timedelta

import pytest

from logpulse.constants import HealthParams
from logpulse.functions.columns import floor_time, percent_text
from logpulse.operators import (
    detect_spikes,
    error_timeline,
    health_report,
    health_status,
    hourly_breakdown,
    hourly_stacked,
    incidents,
    severity_counts,
    severity_share,
    spike_lift,
    status_transitions,
    time_range,
    top_errors,
    window_error_rate,
    window_status_frame,
    worst_spike,
)
from pyspark.sql import functions as F

B = datetime(2024, 3, 1, 10, 0, 0)


def window_rows(k, n, errors):
    """n rows in the k-th 5-minute window, the first `errors` of them ERROR."""
    start = B + timedelta(minutes=5 * k)
    return [(start + timedelta(seconds=i), "ERROR" if i < errors else "INFO", "T", f"m{i}")
            for i in range(n)]


@pytest.fixture
def boundary_entries(make_entries):
    rows = (window_rows(0, 20, 1)      # 0.05 exactly: no spike, timeline flag on
            + window_rows(1, 10, 1)    # 0.10 exactly: critical
            + window_rows(2, 9, 9)     # n = 9: ignored
            + window_rows(3, 10, 2)    # 0.20: critical
            + window_rows(4, 100, 6))  # 0.06: warning
    return make_entries(rows)


def test_spike_thresholds(boundary_entries):
    sp = {r.window_start: r for r in detect_spikes(boundary_entries).collect()}
    w = [B + timedelta(minutes=5 * k) for k in range(5)]
    assert set(sp) == {w[1], w[3], w[4]}
    assert sp[w[1]].severity == "critical" and sp[w[3]].severity == "critical"
    assert sp[w[4]].severity == "warning"


def test_timeline_uses_ge_and_min_entries(boundary_entries):
    tl = {r.window_start: r.above_threshold for r in error_timeline(boundary_entries).collect()}
    w = [B + timedelta(minutes=5 * k) for k in range(5)]
    assert w[2] not in tl
    assert tl[w[0]] is True and tl[w[4]] is True


def test_window_status_transitions_incidents(boundary_entries):
    st = window_status_frame(boundary_entries, HealthParams())
    assert [r.status for r in st.orderBy("window_start").collect()] == [
        "HEALTHY", "CRITICAL", "HEALTHY", "CRITICAL", "WARNING"]
    tr = [(r.prev_status, r.status) for r in status_transitions(st).orderBy("window_start").collect()]
    assert tr == [("HEALTHY", "CRITICAL"), ("CRITICAL", "HEALTHY"), ("HEALTHY", "CRITICAL"),
                  ("CRITICAL", "WARNING")]
    inc = incidents(st).orderBy("first_window").collect()
    assert [(i.n_windows, i.worst_status) for i in inc] == [(1, "CRITICAL"), (2, "CRITICAL")]
    assert inc[1].peak_error_rate == pytest.approx(0.2)
    assert inc[1].error_count == 8 and inc[1].total_entries == 110
    # property: transitions alternate, prev of each = status of the one before
    rows = status_transitions(st).orderBy("window_start").collect()
    assert all(a.status == b.prev_status for a, b in zip(rows, rows[1:]))


def test_incident_max_gap(make_entries):
    rows = window_rows(0, 10, 5) + window_rows(3, 10, 5)   # two bad windows 15 minutes apart
    st = window_status_frame(make_entries(rows), HealthParams())
    assert incidents(st).count() == 1
    assert incidents(st, max_gap="5 minutes").count() == 2


def test_worst_spike_tie_earliest(make_entries):
    rows = window_rows(0, 10, 3) + window_rows(1, 10, 3)
    w = worst_spike(detect_spikes(make_entries(rows))).collect()
    assert len(w) == 1 and w[0].window_start == B


def test_nulls_and_unknown_levels(make_entries):
    rows = window_rows(0, 10, 2) + [(None, "ERROR", "T", "no time"), (B, "NOTICE", "T", "odd"),
                                     (B, None, "T", "no level")]
    e = make_entries(rows)
    s = severity_counts(e).collect()[0]
    assert s.total == 13 and s.ERROR == 3
    wr = window_error_rate(e).collect()
    assert len(wr) == 1 and wr[0].total_entries == 12 and wr[0].error_count == 2
    h = hourly_breakdown(e).collect()[0]
    assert h.total == 10                      # unknown level not in the hourly total
    top = top_errors(e).collect()
    assert sum(r["count"] for r in top) == 3  # null-time error still counted
    rep = health_report(e).collect()[0]
    assert rep.total_entries == 13 and rep.severity_counts.ERROR == 3


def test_empty_input(make_entries):
    e = make_entries([])
    s = severity_counts(e).collect()
    assert len(s) == 1 and s[0].total == 0 and s[0].error_rate == 0.0
    assert [r["count"] for r in severity_share(e).collect()] == [0] * 5
    assert detect_spikes(e).count() == 0
    assert worst_spike(detect_spikes(e)).count() == 0
    hs = health_status(detect_spikes(e)).collect()
    assert len(hs) == 1 and hs[0].status == "HEALTHY" and hs[0].status_reason == "No anomaly spikes detected"
    tr = time_range(e).collect()[0]
    assert tr.start is None and tr.hours_analysed == 1
    rep = health_report(e, as_of="2024-01-01 00:00:00").collect()[0]
    assert (rep.status, rep.total_entries, rep.time_range, rep.hours_analysed) == ("HEALTHY", 0, None, 1)
    assert rep.top_errors == [] and rep.spike_count == 0 and rep.recommendations == []
    assert spike_lift(e).count() == 0 and hourly_stacked(e).count() == 0


def test_percent_text_matches_python(spark):
    pairs = [(k, n) for n in (3, 7, 8, 16, 40, 200, 1338, 3899) for k in range(0, n + 1, max(1, n // 40))]
    pairs += [(13, 200), (149, 1338), (253, 3899), (1, 16), (5, 80)]
    df = spark.createDataFrame(pairs, "k long, n long")
    got = df.select("k", "n", percent_text(F.col("k") / F.col("n")).alias("t")).collect()
    for r in got:
        assert r.t == f"{r.k / r.n:.0%}", (r.k, r.n)


def test_floor_time_is_zone_free(spark, make_entries):
    rows = [(datetime(2024, 3, 10, 2, 30, 5), "INFO"), (datetime(2024, 7, 1, 23, 59, 59), "INFO"),
            (datetime(1969, 12, 31, 23, 58, 1), "INFO"), (datetime(2024, 11, 3, 1, 30, 0), "INFO")]
    e = make_entries(rows)
    q = e.select(floor_time("timestamp", "1 hour").alias("h"), floor_time("timestamp", "7 minutes").alias("m7"),
                 F.window("timestamp", "7 minutes").start.alias("w7"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        out = {}
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            out[tz] = sorted(q.collect())
        assert out["UTC"] == out["America/New_York"] == out["Asia/Kolkata"]
        assert all(r.m7 == r.w7 for r in out["UTC"])
        assert [r.h for r in out["UTC"]][0] == datetime(1969, 12, 31, 23, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_null_key_is_a_group(spark):
    from pyspark.sql import types as T

    from conftest import ENTRY_SCHEMA

    schema = T.StructType([T.StructField("svc", T.IntegerType())] + ENTRY_SCHEMA.fields)
    rows = [(k, B + timedelta(seconds=i), "ERROR" if i < 4 else "INFO", "T", f"e{i % 2}")
            for k in (None, 1) for i in range(10)]
    e = spark.createDataFrame(rows, schema)
    top = top_errors(e, 5, keys=["svc"]).collect()
    got = sorted((-1 if r.svc is None else r.svc, r.message_prefix, r["count"], r.pct_of_errors) for r in top)
    assert got == [(-1, "e0", 2, 0.5), (-1, "e1", 2, 0.5), (1, "e0", 2, 0.5), (1, "e1", 2, 0.5)]
    lift = spike_lift(e, HealthParams(min_window_entries=5), keys=["svc"]).collect()
    assert sorted((r.svc is None, r.lift) for r in lift) == [(False, 1.0), (True, 1.0)]
