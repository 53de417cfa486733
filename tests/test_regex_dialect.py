"""Regex dialect: Spark's parse of generated lines equals Python ``re`` +
``strptime`` on the same fixed patterns (NEL, Unicode spaces and digits,
brackets, colons, tabs, non-ASCII)."""

import re
from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from logpulse.constants import APP_LINE_PATTERN, HADOOP_LEVEL_MAP, HADOOP_LINE_PATTERN
from logpulse.sources import parse_app_lines, parse_hadoop_lines

PY_HADOOP = re.compile(HADOOP_LINE_PATTERN)
PY_APP = re.compile(APP_LINE_PATTERN)
ALPHABET = list("ab.Z:09[] -,\t") + ["\u0085", " ", " ", "٣", "é", "Ж", "—", ":"]

frag = st.text(alphabet=ALPHABET, max_size=12)
# Non-ASCII digits inside the timestamp are a documented difference (see
# test_unicode_digit_timestamp_is_rejected); elsewhere they are generated.
stamp = st.sampled_from(["2015-10-18 21:40:23", "2015-02-30 10:00:00", "2015-10-18 25:00:00",
                         "2015-1-18 21:40:23", "2015-10-18 21:40:2x"])
level = st.sampled_from(["INFO", "WARN", "ERROR", "FATAL", "DEBUG", "WARNING", "info"])
hadoop_line = st.one_of(
    st.builds(lambda t, ms, lv, th, comp, msg: f"{t},{ms} {lv} [{th}] {comp}: {msg}",
              stamp, st.sampled_from(["154", "1", "", "x"]), level, frag, frag, frag),
    frag,
)
app_line = st.one_of(
    st.builds(lambda t, lv, lg, msg: f"{t.replace(' ', 'T')} — {lv} — {lg} — {msg}",
              stamp, st.sampled_from(["DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL", "WARN"]), frag, frag),
    frag,
)
SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))


def _ts(text, fmt):
    try:
        return datetime.strptime(text, fmt)
    except ValueError:
        return None


def model_hadoop(line):
    m = PY_HADOOP.match(line)
    if not m or _ts(m.group(1), "%Y-%m-%d %H:%M:%S") is None:
        return None
    return (_ts(m.group(1), "%Y-%m-%d %H:%M:%S"), HADOOP_LEVEL_MAP[m.group(2)],
            m.group(4).split(".")[-1], m.group(5))


def model_app(line):
    m = PY_APP.match(line)
    if not m or _ts(m.group(1), "%Y-%m-%dT%H:%M:%S") is None:
        return None
    return (_ts(m.group(1), "%Y-%m-%dT%H:%M:%S"), m.group(2), m.group(3), m.group(4))


@SETTINGS
@given(lines=st.lists(hadoop_line, min_size=1, max_size=60))
def test_hadoop_dialect(spark, lines):
    df = spark.createDataFrame([(i, ln) for i, ln in enumerate(lines)], "i int, value string")
    got = {r.i: (r.timestamp, r.level, r.logger, r.message) for r in parse_hadoop_lines(df).collect()}
    want = {i: model_hadoop(ln) for i, ln in enumerate(lines) if model_hadoop(ln) is not None}
    assert got == want


@SETTINGS
@given(lines=st.lists(app_line, min_size=1, max_size=60))
def test_app_dialect(spark, lines):
    df = spark.createDataFrame([(i, ln) for i, ln in enumerate(lines)], "i int, value string")
    got = {r.i: (r.timestamp, r.level, r.logger, r.message) for r in parse_app_lines(df).collect()}
    want = {i: model_app(ln) for i, ln in enumerate(lines) if model_app(ln) is not None}
    assert got == want


def test_unicode_digit_timestamp_is_rejected(spark):
    from logpulse.sources import parse_rejects

    line = "2015-10-18 21:40:2\u0663,000 INFO [main] a.B: m"   # ARABIC-INDIC DIGIT THREE
    df = spark.createDataFrame([(line,)], "value string")
    assert parse_hadoop_lines(df).count() == 0
    assert [r.reject_reason for r in parse_rejects(df).collect()] == ["bad_timestamp"]


multi = st.lists(st.one_of(hadoop_line, app_line, st.sampled_from(["", "\tat x.Y(Z.java:1)", "ERROR"])),
                 min_size=1, max_size=4).map("\n".join)
FORGED = "2015-10-18 21:40:23\nERROR\nforged.Logger\nnot a log line"


@SETTINGS
@given(values=st.lists(multi, min_size=1, max_size=30))
def test_values_over_several_lines(spark, values):
    """A frame may hold values with newlines, which the text source never yields."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate([FORGED, *values])], "i int, value string")
    for parse, model in ((parse_hadoop_lines, model_hadoop), (parse_app_lines, model_app)):
        got = {r.i: (r.timestamp, r.level, r.logger, r.message) for r in parse(df).collect()}
        want = {i: model(v) for i, v in enumerate([FORGED, *values]) if model(v) is not None}
        assert got == want and 0 not in got


def test_lines_after_a_log_line_are_no_bad_timestamp(spark):
    from logpulse.sources import parse_rejects

    line = "2015-10-18 21:40:23,154 ERROR [main] a.B: m\n\tat x.Y"
    df = spark.createDataFrame([(line,), (FORGED,)], "value string")
    assert [r.reject_reason for r in parse_rejects(df).collect()] == ["no_match", "no_match"]
