"""Operators vs. a brute-force Python model on random small inputs."""

from collections import Counter, defaultdict
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from logpulse.constants import LEVELS, HealthParams
from logpulse.operators import (
    alert_events,
    detect_spikes,
    health_report,
    hourly_breakdown,
    incidents,
    severity_counts,
    status_transitions,
    top_error_by_window,
    top_errors,
    window_alerts,
    window_error_rate,
    window_status_frame,
)

BASE = datetime(2024, 5, 1, 10, 0, 0)
P = HealthParams(window="5 minutes", error_rate_threshold=0.2, critical_rate=0.5, min_window_entries=3,
                 top_errors_n=3, prefix_length=4)
MESSAGES = [None, "disk full", "disk fail", "dis", "Ошибка сети", "Ошибка диска", "timeout a", "timeout b", ""]

entry = st.tuples(
    st.one_of(st.none(), st.integers(0, 3 * 3600).map(lambda s: BASE + timedelta(seconds=s))),
    st.sampled_from(list(LEVELS) + ["NOTICE", None, "ERROR", "ERROR", "CRITICAL"]),
    st.sampled_from(MESSAGES),
)
entries_st = st.lists(entry, min_size=0, max_size=120)
SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))


def floor5(t):
    return t - timedelta(minutes=t.minute % 5, seconds=t.second, microseconds=t.microsecond)


def model_windows(rows):
    w = defaultdict(lambda: [0, 0])
    for t, lv, _ in rows:
        if t is not None:
            w[floor5(t)][0] += 1
            w[floor5(t)][1] += lv in ("ERROR", "CRITICAL")
    return {k: (n, e, e / n) for k, (n, e) in w.items()}


def model_status(n, rate):
    if n < P.min_window_entries or rate <= P.error_rate_threshold:
        return "HEALTHY"
    return "WARNING" if rate < P.critical_rate else "CRITICAL"


def df(make_entries, rows):
    return make_entries([(t, lv, "T", m) for t, lv, m in rows])


@SETTINGS
@given(rows=entries_st)
def test_counts_windows_spikes(make_entries, rows):
    e = df(make_entries, rows)
    s = severity_counts(e).collect()[0]
    c = Counter(lv for _, lv, _ in rows)
    assert [s[lv] for lv in LEVELS] == [c[lv] for lv in LEVELS] and s.total == len(rows)
    want = model_windows(rows)
    got = {r.window_start: (r.total_entries, r.error_count, r.error_rate)
           for r in window_error_rate(e, P.window).collect()}
    assert got == want
    assert sum(n for n, _, _ in got.values()) == sum(1 for t, _, _ in rows if t is not None)
    spikes = {r.window_start: r.severity for r in detect_spikes(e, P).collect()}
    assert spikes == {k: ("warning" if r < P.critical_rate else "critical")
                      for k, (n, _, r) in want.items() if r > P.error_rate_threshold and n >= P.min_window_entries}
    hourly = {r.hour: r.total for r in hourly_breakdown(e).collect()}
    want_h = Counter(t.hour for t, lv, _ in rows if t is not None and lv is not None)
    assert hourly == {h: sum(1 for t, lv, _ in rows if t is not None and lv in LEVELS and t.hour == h)
                      for h in want_h}


@SETTINGS
@given(rows=entries_st)
def test_top_errors_model(make_entries, rows):
    e = df(make_entries, rows)
    errs = [m for _, lv, m in rows if lv in ("ERROR", "CRITICAL")]
    c = Counter(m[:P.prefix_length] for m in errs if m is not None)
    want = sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[:P.top_errors_n]
    got = top_errors(e, P.top_errors_n, P.prefix_length).orderBy("rank").collect()
    assert [(r.message_prefix, r["count"]) for r in got] == want
    assert all(abs(r.pct_of_errors - r["count"] / len(errs)) < 1e-12 for r in got)
    rep = health_report(e, P).collect()[0]
    assert [(t.message_prefix, t["count"]) for t in rep.top_errors] == want
    assert rep.total_entries == len(rows)
    assert rep.spike_count == len(detect_spikes(e, P).collect())


@SETTINGS
@given(rows=entries_st)
def test_transitions_incidents_alerts(make_entries, rows):
    e = df(make_entries, rows)
    win = sorted(model_windows(rows).items())
    statuses = [(k, model_status(n, r)) for k, (n, _, r) in win]
    want_tr, prev = [], "HEALTHY"
    for k, s in statuses:
        if s != prev:
            want_tr.append((k, prev, s))
        prev = s
    st_df = window_status_frame(e, P)
    got_tr = sorted((r.window_start, r.prev_status, r.status) for r in status_transitions(st_df).collect())
    assert got_tr == want_tr
    # 10-minute scan buckets: the previous status is carried across buckets
    got_b = sorted((r.window_start, r.prev_status, r.status)
                   for r in status_transitions(st_df, bucket="10 minutes").collect())
    assert got_b == want_tr
    runs, cur = [], None
    for k, s in statuses:
        if s != "HEALTHY":
            cur = cur or []
            cur.append(k)
        elif cur:
            runs.append(cur)
            cur = None
    if cur:
        runs.append(cur)
    got_inc = sorted((r.first_window, r.last_window, r.n_windows) for r in incidents(st_df).collect())
    assert got_inc == [(r[0], r[-1], len(r)) for r in runs]
    got_inc_b = sorted((r.incident_no, r.first_window, r.last_window, r.n_windows)
                       for r in incidents(st_df, bucket="10 minutes").collect())
    assert got_inc_b == [(i + 1, r[0], r[-1], len(r)) for i, r in enumerate(runs)]
    # the single-scan alert path equals the composed one
    composed = alert_events(status_transitions(st_df), P, (), top_error_by_window(e, P.window, (), P.prefix_length))
    cols = ["window_start", "prev_status", "status", "transition", "top_error", "payload"]
    assert sorted(window_alerts(e, P).select(cols).collect()) == sorted(composed.select(cols).collect())


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 2), entry), min_size=0, max_size=150))
def test_keyed_transitions_across_buckets(spark, rows):
    from conftest import ENTRY_SCHEMA
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("svc", T.IntegerType())] + ENTRY_SCHEMA.fields)
    e = spark.createDataFrame([(k, t, lv, "T", m) for k, (t, lv, m) in rows], schema)
    st_df = window_status_frame(e, P, ["svc"])
    want = []
    for k in range(3):
        prev = "HEALTHY"
        for w, (n, _, r) in sorted(model_windows([x for kk, x in rows if kk == k]).items()):
            s = model_status(n, r)
            if s != prev:
                want.append((k, w, prev, s))
            prev = s
    for b in ("7 days", "10 minutes"):
        got = sorted((r.svc, r.window_start, r.prev_status, r.status)
                     for r in status_transitions(st_df, ["svc"], bucket=b).collect())
        assert got == sorted(want)


@SETTINGS
@given(rows=entries_st)
def test_cube_and_report_equal_direct_operators(make_entries, rows):
    from logpulse.operators import report_aggregate, report_header, report_spikes
    from logpulse.operators.windows import rates_from_cube, window_cube

    e = df(make_entries, rows)
    direct = sorted(window_error_rate(e, P.window).collect())
    via_cube = sorted(rates_from_cube(window_cube(e, P.window), P.window).collect())
    assert via_cube == direct
    base = report_aggregate(e, P)
    rep = report_header(base, P).collect()[0]
    sev = severity_counts(e).collect()[0].asDict()
    assert rep.severity_counts.asDict() == sev
    spikes = sorted((r.window_start.strftime("%Y-%m-%d %H:%M:%S"), r.total_entries, r.error_count,
                     r.error_rate, r.severity) for r in detect_spikes(e, P).collect())
    assert sorted(tuple(s) for s in report_spikes(base, P).collect()) == spikes
    assert rep.spike_count == len(spikes)
