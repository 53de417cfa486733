"""Status layer goldens, alert payloads, report JSON sink/source."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from logpulse.constants import HealthParams
from logpulse.operators import (
    alert_events,
    report_aggregate,
    report_header,
    report_spikes,
    health_status,
    spike_recommendations,
    top_errors,
    worst_spike,
)
from logpulse.sources import read_report, read_report_spikes, report_section, write_report
from logpulse.sources.report_io import HEALTH_REPORT_SCHEMA

SPIKE_SCHEMA = ("window_start timestamp_ntz, total_entries long, error_count long, "
                "error_rate double, severity string")
# Values of the stored full-corpus report (two spikes and the top error).
STORED_SPIKES = [
    (datetime(2015, 10, 18, 18, 5), 3899, 253, 253 / 3899, "warning"),
    (datetime(2015, 10, 18, 21, 40), 1338, 149, 149 / 1338, "critical"),
]
STORED_RECOMMENDATIONS = [
    "Anomaly spike at 2015-10-18 21:40:00: 149 errors in 5 minutes (11% error rate). "
    "Investigate what changed at this time.",
    "Anomaly spike at 2015-10-18 18:05:00: 253 errors in 5 minutes (6% error rate). "
    "Investigate what changed at this time.",
    "'ERROR IN CONTACTING RM. ' occurred 480 times — consider adding retry logic.",
]


@pytest.fixture
def stored(spark):
    spikes = spark.createDataFrame(STORED_SPIKES, SPIKE_SCHEMA)
    top = spark.createDataFrame([(1, "ERROR IN CONTACTING RM. ", 480, 480 / 538)],
                                "rank int, message_prefix string, count long, pct_of_errors double")
    return spikes, top


def test_stored_report_status_and_advice(stored):
    spikes, top = stored
    st = health_status(spikes).collect()[0]
    assert (st.status, st.status_reason, st.spike_count) == (
        "CRITICAL", "Anomaly spike with >10% error rate detected", 2)
    recs = [r.recommendation for r in spike_recommendations(spikes, top).orderBy("rec_no").collect()]
    assert recs == STORED_RECOMMENDATIONS
    w = worst_spike(spikes).collect()[0]
    assert (w.window_start, w.error_count) == (datetime(2015, 10, 18, 21, 40), 149)
    assert 480 / 538 == pytest.approx(0.8921933085501859)


def test_worst_spike_keyed(spark):
    df = spark.createDataFrame(
        [("a", datetime(2024, 1, 1, 1), 10, 5, 0.5, "critical"),
         ("a", datetime(2024, 1, 1, 0), 10, 5, 0.5, "critical"),
         ("b", datetime(2024, 1, 1, 2), 10, 1, 0.1, "critical")],
        "svc string, " + SPIKE_SCHEMA)
    got = {r.svc: r.window_start for r in worst_spike(df, ["svc"]).collect()}
    assert got == {"a": datetime(2024, 1, 1, 0), "b": datetime(2024, 1, 1, 2)}


def _transitions(spark, rows):
    return spark.createDataFrame(rows, "window_start timestamp_ntz, prev_status string, status string, "
                                       "total_entries long, error_count long, error_rate double")


def test_alert_payload_critical(spark):
    tr = _transitions(spark, [(datetime(2015, 10, 18, 21, 40), "HEALTHY", "CRITICAL", 25, 15, 0.6)])
    tops = spark.createDataFrame([(datetime(2015, 10, 18, 21, 40), "ERROR IN CONTACTING RM.")],
                                 "window_start timestamp_ntz, top_error string")
    a = alert_events(tr, HealthParams(), top_errors_by_window=tops).collect()[0]
    assert a.transition == "Critical anomaly detected — immediate attention required."
    p = json.loads(a.payload)
    att = p["attachments"][0]
    assert att["color"] == "#EF4444"
    header = next(b for b in att["blocks"] if b["type"] == "header")
    assert header["text"] == {"type": "plain_text", "text": ":red_circle: CRITICAL — logpulse", "emoji": True}
    fields = [f["text"] for b in att["blocks"] if "fields" in b for f in b["fields"]]
    assert fields == ["*Worst window:*\n2015-10-18 21:40", "*Error rate:*\n60% (threshold: 5%)",
                      "*Errors in window:*\n15 / 25 entries", "*Top error:*\n`ERROR IN CONTACTING RM.`"]
    assert att["blocks"][-1]["type"] == "context"


def test_alert_payload_warning_and_recovery(spark):
    tr = _transitions(spark, [(datetime(2024, 1, 1, 0), "HEALTHY", "WARNING", 1000, 60, 0.06),
                              (datetime(2024, 1, 1, 1), "WARNING", "HEALTHY", 2000, 1, 0.0005),
                              (datetime(2024, 1, 1, 2), "HEALTHY", "UNKNOWN", 1, 0, 0.0)])
    rows = {r.status: r for r in alert_events(tr).collect()}
    assert json.loads(rows["WARNING"].payload)["attachments"][0]["color"] == "#F59E0B"
    assert "1,000 entries" in rows["WARNING"].payload
    rec = json.loads(rows["HEALTHY"].payload)["attachments"][0]
    assert rec["color"] == "#22C55E"
    assert "recovered" in json.dumps(rec["blocks"]).lower()
    assert not any("fields" in b for b in rec["blocks"])       # no spike fields on recovery
    assert rows["UNKNOWN"].transition == "HEALTHY → UNKNOWN"    # default text


def test_report_json_round_trip(make_entries, scratch):
    from tests.test_reference_fixtures import spike_rows

    base = report_aggregate(make_entries(spike_rows()))
    rep = report_header(base, as_of="2015-10-19 00:00:00")
    assert rep.schema.simpleString() == HEALTH_REPORT_SCHEMA.simpleString()
    path = f"{scratch}/report"
    write_report(rep, path, report_spikes(base))
    back = read_report(rep.sparkSession, path)
    assert back.collect() == rep.collect()
    sev = report_section(back, "severity_counts").collect()[0]
    assert (sev.total, sev.ERROR) == (125, 15)
    spikes = read_report_spikes(rep.sparkSession, path).collect()
    assert [(s.window, s.severity) for s in spikes] == [("2015-10-18 21:40:00", "critical")]
    tops = report_section(back, "top_errors").collect()
    assert [(t["rank"], t.message_prefix, t["count"]) for t in tops] == [(1, "ERROR IN CONTACTING RM.", 15)]


def test_top_errors_keyed_matches_brute_force(spark, make_entries):
    import random

    rnd = random.Random(7)
    rows = [(datetime(2024, 1, 1), "ERROR", "T", f"e{rnd.randint(0, 300)}") for _ in range(3000)]
    e = make_entries(rows).withColumn("svc", (F.hash("message") % 3).cast("int"))
    got = sorted((r.svc, r["rank"], r.message_prefix, r["count"])
                 for r in top_errors(e, 5, keys=["svc"]).collect())
    pdf = e.toPandas()
    want = []
    for svc, g in pdf.groupby("svc"):
        c = g.groupby("message").size().reset_index(name="n").sort_values(["n", "message"],
                                                                          ascending=[False, True])
        want += [(svc, i + 1, m, n) for i, (m, n) in enumerate(zip(c.message[:5], c.n[:5]))]
    assert got == sorted(want)


def test_status_check_fires_once_then_silent(make_entries, scratch):
    from logpulse.operators import status_check
    from tests.test_reference_fixtures import report_rows, spike_rows

    hist = f"{scratch}/state"
    e = make_entries(spike_rows())
    first = status_check(e, hist, as_of="2015-10-18 22:00:00").collect()
    assert [(a.prev_status, a.status, a.worst_window) for a in first] == [
        ("HEALTHY", "CRITICAL", "2015-10-18 21:40")]
    p = json.loads(first[0].payload)["attachments"][0]
    assert p["color"] == "#EF4444" and "60% (threshold: 5%)" in json.dumps(p, ensure_ascii=False)
    assert status_check(e, hist, as_of="2015-10-18 22:05:00").collect() == []      # same status: silent
    # a WARNING corpus next: CRITICAL -> WARNING fires
    w = status_check(make_entries(report_rows()), hist, as_of="2015-10-18 22:10:00").collect()
    assert [(a.prev_status, a.status) for a in w] == [("CRITICAL", "WARNING")]
    assert w[0].transition == "Partially recovered — still above warning threshold."
    assert first[0].top_error == "ERROR IN CONTACTING RM." and "ERROR IN CONTACTING RM." in first[0].payload
    assert w[0].top_error == "CRITICAL message 0"


def test_status_check_rerun_does_not_realert(make_entries, scratch):
    from logpulse.operators import status_check
    from tests.test_reference_fixtures import spike_rows

    hist = f"{scratch}/state"
    e = make_entries(spike_rows())
    assert len(status_check(e, hist, as_of="2015-10-18 22:00:00").collect()) == 1
    # the same check again (a retried job): the previous status is now CRITICAL
    assert status_check(e, hist, as_of="2015-10-18 22:00:00").collect() == []


def test_status_check_answers_for_itself(make_entries, scratch):
    """A check at an earlier time is not answered with a later check's alert."""
    from logpulse.operators import status_check
    from tests.test_reference_fixtures import report_rows, spike_rows

    bad, good, hist = make_entries(spike_rows()), make_entries(report_rows()), scratch + "/mixed"
    assert len(status_check(bad, hist, as_of="2015-10-18 23:00:00").collect()) == 1
    before = status_check(good, hist, as_of="2015-10-18 22:00:00").collect()
    assert all(r.prev_status == "HEALTHY" and str(r.checked_at) == "2015-10-18 22:00:00" for r in before)


def test_status_check_raises_on_unreadable_history(make_entries, scratch):
    import os

    from logpulse.operators import status_check
    from tests.test_reference_fixtures import report_rows

    os.makedirs(scratch + "/broken")
    with open(scratch + "/broken/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        status_check(make_entries(report_rows()), scratch + "/broken", as_of="2015-10-18 22:00:00").collect()


def test_percent_is_rounded():
    from logpulse.operators.status import _pct

    assert _pct(0.29) == 29 and _pct(0.05) == 5


def test_html_to_text_trims_like_strip(spark):
    from logpulse.functions import html_to_text

    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    rows = [(f"<p>{a} hi{b}x{a}</p>{b}",) for a, b in zip(spaces, reversed(spaces))]
    got = [r[0] for r in spark.createDataFrame(rows, "html string").select(html_to_text("html")).collect()]
    assert len(got) == len(spaces) and all(t == t.strip() and t.startswith("hi") and t.endswith("x") for t in got)


def test_keyed_health_has_healthy_keys(spark):
    spikes = spark.createDataFrame([("a", "warning"), ("a", "critical"), ("c", "warning")], "svc string, severity string")
    keys = spark.createDataFrame([("a",), ("b",), ("c",), ("b",), (None,)], "svc string")
    got = {r.svc: (r.status, r.spike_count) for r in health_status(spikes, keys=["svc"], known_keys=keys).collect()}
    assert got == {"a": ("CRITICAL", 2), "b": ("HEALTHY", 0), "c": ("WARNING", 1), None: ("HEALTHY", 0)}


def test_alert_title_and_long_prefix(make_entries):
    from logpulse.operators import window_alerts

    long = "E" * 90
    e = make_entries([(datetime(2024, 1, 1, 0, 0, i), "ERROR", "T", long) for i in range(12)])
    a = window_alerts(e, HealthParams(prefix_length=80, alert_title="night shift")).collect()[0]
    assert a.top_error == long[:80] and f"`{long[:80]}`" in a.payload and "— night shift" in a.payload


def test_report_reads_its_input_once_and_lists_are_bounded(spark, scratch):
    """All report tables hang on the written base aggregate, not on the entries."""
    from logpulse.sources import entries_from_events, read_table

    base = report_aggregate(entries_from_events(read_table(spark, "/root/testdata/sf0.001", "events")),
                            path=f"{scratch}/base")
    header = report_header(base, as_of="2024-01-01 00:00:00")
    plan = header._jdf.queryExecution().toString()
    assert "events.parquet" not in plan and "collect_list" in plan
    assert header.collect()[0].spike_count == report_spikes(base).count()
    # a list is only collected from a limited frame
    for line in (ln for ln in plan.split("== Optimized")[0].splitlines() if "collect_list(" in ln):
        assert "message_prefix" in line or "recommendation" in line
