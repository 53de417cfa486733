"""Replays of the reference's own fixtures with the values derived by hand."""

from datetime import datetime, timedelta

import pytest

from logpulse.constants import HealthParams
from logpulse.operators import (
    detect_spikes,
    health_report,
    health_status,
    hourly_breakdown,
    report_aggregate,
    report_spikes,
    severity_counts,
    status_transitions,
    top_errors,
    window_status_frame,
)


def report_rows():
    """50 INFO, 10 WARNING, 5 ERROR, 1 CRITICAL; block i starts at minute i."""
    base = datetime(2015, 10, 18, 10, 0, 0)
    rows = []
    for i, (count, level) in enumerate([(50, "INFO"), (10, "WARNING"), (5, "ERROR"), (1, "CRITICAL")]):
        for j in range(count):
            rows.append((base + timedelta(seconds=i * 60 + j), level, "TestLogger", f"{level} message {j}"))
    return rows


def direct_rows():
    base = datetime(2015, 10, 18, 10, 0, 0)
    levels = ["INFO"] * 50 + ["WARNING"] * 10 + ["ERROR"] * 5
    return [(base + timedelta(seconds=i), lv, "Test", f"{lv} msg") for i, lv in enumerate(levels)]


def spike_rows():
    base = datetime(2015, 10, 18, 21, 40, 0)
    rows = [(base - timedelta(minutes=60) + timedelta(seconds=i * 36), "INFO", "Test", "info msg")
            for i in range(100)]
    rows += [(base + timedelta(seconds=i * 10), "ERROR", "Test", "ERROR IN CONTACTING RM.") for i in range(15)]
    rows += [(base + timedelta(seconds=150 + i * 10), "INFO", "Test", "info msg") for i in range(10)]
    return rows


def test_report_fixture_counts(make_entries):
    e = make_entries(report_rows())
    s = severity_counts(e).collect()[0]
    assert (s.total, s.INFO, s.WARNING, s.ERROR, s.CRITICAL, s.DEBUG) == (66, 50, 10, 5, 1, 0)
    assert s.error_rate == pytest.approx(6 / 66)
    assert s.warning_rate == pytest.approx(10 / 66)


def test_report_fixture_spike_and_status(make_entries):
    e = make_entries(report_rows())
    spikes = detect_spikes(e).collect()
    assert len(spikes) == 1
    sp = spikes[0]
    assert (sp.window_start, sp.total_entries, sp.error_count, sp.severity) == (
        datetime(2015, 10, 18, 10, 0), 66, 6, "warning")
    st = health_status(detect_spikes(e)).collect()[0]
    assert st.status == "WARNING"
    assert st.status_reason == "1 anomaly spike(s) detected above 5% threshold"


def test_report_fixture_top_errors_tie_order(make_entries):
    e = make_entries(report_rows())
    top = top_errors(e).orderBy("rank").collect()
    assert [r.message_prefix for r in top] == ["CRITICAL message 0"] + [f"ERROR message {j}" for j in range(5)]
    assert all(r["count"] == 1 for r in top)
    assert all(r.pct_of_errors == pytest.approx(1 / 6) for r in top)
    assert [r["rank"] for r in top] == list(range(1, 7))


def test_report_fixture_hourly(make_entries):
    rows = hourly_breakdown(make_entries(report_rows())).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.hour, r.DEBUG, r.INFO, r.WARNING, r.ERROR, r.CRITICAL, r.total) == (10, 0, 50, 10, 5, 1, 66)


def test_report_fixture_full_report(make_entries):
    rep = health_report(make_entries(report_rows()), as_of="2015-10-18 12:00:00").collect()[0]
    assert rep.status == "WARNING"
    assert rep.total_entries == 66
    assert rep.time_range.start == "2015-10-18 10:00" and rep.time_range.end == "2015-10-18 10:03"
    assert rep.hours_analysed == 1
    assert rep.spike_count == 1
    base = report_aggregate(make_entries(report_rows()))
    assert [s.window for s in report_spikes(base).collect()] == ["2015-10-18 10:00:00"]
    assert rep.recommendations == [
        "Anomaly spike at 2015-10-18 10:00:00: 6 errors in 5 minutes (9% error rate). "
        "Investigate what changed at this time.",
        "'CRITICAL message 0' occurred 1 times — consider adding retry logic.",
    ]
    assert rep.generated_at == "2015-10-18 12:00:00"
    assert rep.error_rate_pct == pytest.approx(9.09)
    assert len(rep.top_errors) == 6


def test_direct_fixture(make_entries):
    e = make_entries(direct_rows())
    sp = detect_spikes(e).collect()
    assert len(sp) == 1 and sp[0].severity == "warning"
    assert sp[0].error_rate == pytest.approx(5 / 65)
    top = top_errors(e).collect()
    assert [(r.message_prefix, r["count"], r.pct_of_errors) for r in top] == [("ERROR msg", 5, 1.0)]


def test_spike_fixture_critical_and_single_alert(make_entries):
    e = make_entries(spike_rows())
    spikes = detect_spikes(e).collect()
    assert [(s.window_start, s.total_entries, s.error_count, s.error_rate, s.severity) for s in spikes] == [
        (datetime(2015, 10, 18, 21, 40), 25, 15, 0.6, "critical")]
    assert health_status(detect_spikes(e)).collect()[0].status == "CRITICAL"
    # from HEALTHY: exactly one alert; a repeat of the same status is silent
    tr = status_transitions(window_status_frame(e, HealthParams())).collect()
    assert [(t.prev_status, t.status) for t in tr] == [("HEALTHY", "CRITICAL")]
