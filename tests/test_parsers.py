"""Line parsers over real files: accepted rows, rejects, regex dialect."""

import os
from datetime import datetime

from logpulse.functions.columns import message_prefix
from logpulse.sources import (
    load_app_logs,
    load_hadoop_logs,
    parse_rejects,
    read_log_lines,
    reject_summary,
    union_sources,
)

GOOD = ("2015-10-18 21:40:23,154 ERROR [IPC Server handler 5] org.apache.hadoop.ipc.Server: "
        "IPC Server handler 5 on 8020 caught an exception")
RU = "Ошибка соединения с базой данных: превышено время ожидания ответа от сервера, повтор"

HADOOP_LINES = [
    GOOD,
    "2015-10-18 21:40:24,001 WARN [main] a.b.Warner: slow",
    "2015-10-18 21:40:25,002 FATAL [main] a.b.Fatal: dead",
    "2015-10-18 21:40:26,003 INFO [main] NoDots: plain",
    "\tat org.apache.hadoop.ipc.Server.run(Server.java:100)",            # continuation
    "2015-10-18 21:40:27,004 DEBUG [main] a.b.C: debug",                  # DEBUG not accepted
    "2015-10-18 21:40:27,005 TRACE [main] a.b.C: trace",
    "2015-10-18 21:40:28,006 INFO [main]x] a.b.C: thread with bracket",  # ']' in thread
    "2015-10-18 21:40:29,007 INFO [main] a.b.C no colon",                 # component without ':'
    "2015-02-30 10:00:00,000 INFO [main] a.b.C: impossible date",         # bad date
    f"2015-10-18 21:40:30,008 ERROR [main] a.b.Ru: {RU}",                 # non-ASCII > 60 chars
    "2015-10-18 21:40:31,009 INFO [main] a.b.Nel: before\u0085after",     # NEL stays in message
    "2015-10-18 21:40:32,010 INFO [main] a.b.C\u2003x: unicode space",    # U+2003 is not \\S
    "2015-10-18 21:40:33,011 INFO [main] a.b.Empty: ",                     # empty message
    "",
]


def write(path, lines, newline="\n", bom=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = newline.join(lines) + newline
    with open(path, "wb") as f:
        f.write((b"\xef\xbb\xbf" if bom else b"") + data.encode("utf-8"))


def test_hadoop_parse_and_rejects(spark, scratch):
    write(f"{scratch}/a/app.log", HADOOP_LINES)
    entries = load_hadoop_logs(spark, scratch)
    got = {r.message: r for r in entries.collect()}
    assert len(got) == 6
    r = got["IPC Server handler 5 on 8020 caught an exception"]
    assert (r.timestamp, r.level, r.logger) == (datetime(2015, 10, 18, 21, 40, 23), "ERROR", "Server")
    assert got["slow"].level == "WARNING" and got["dead"].level == "CRITICAL"
    assert got["plain"].logger == "NoDots"
    assert got[RU].logger == "Ru"
    assert "before\u0085after" in got
    rej = {(r.reject_reason, r.value) for r in parse_rejects(read_log_lines(spark, scratch)).collect()}
    assert ("bad_timestamp", HADOOP_LINES[9]) in rej
    assert sum(1 for x in rej if x[0] == "no_match") == 8
    summary = reject_summary(read_log_lines(spark, scratch)).collect()
    assert sorted((s.reject_reason, s.n_rejected) for s in summary) == [("bad_timestamp", 1), ("no_match", 8)]


def test_prefix_is_code_points(spark, scratch):
    write(f"{scratch}/x.log", [f"2015-10-18 21:40:30,008 ERROR [main] a.b.Ru: {RU}"])
    p = load_hadoop_logs(spark, scratch).select(message_prefix("message", 60).alias("p")).collect()[0].p
    assert p == RU[:60] and len(p) == 60


def test_crlf_bom_empty_and_file_selection(spark, scratch):
    write(f"{scratch}/crlf.log", [GOOD, GOOD], newline="\r\n")
    write(f"{scratch}/bom.log", [GOOD], bom=True)
    write(f"{scratch}/deep/er/nested.log", [GOOD])
    write(f"{scratch}/empty.log", [])
    write(f"{scratch}/notes.txt", [GOOD])        # not *.log
    write(f"{scratch}/.hidden.log", [GOOD])      # hidden: skipped by Spark file sources
    entries = load_hadoop_logs(spark, scratch, keep_raw=True).collect()
    assert len(entries) == 4
    assert all(e.raw == GOOD for e in entries)   # no trailing \r, BOM stripped


def test_app_format_and_lookback(spark, scratch):
    lines = [
        "2026-06-16T08:00:00 — ERROR — app.service — Database connection failed: timeout",
        "2026-06-15T08:00:00 — INFO — app.service — old line",
        "2026-06-16T09:00:00 — NOTICE — app.service — unknown level",
        "2026-06-16 10:00:00 — INFO — app.service — wrong separator",
    ]
    write(f"{scratch}/app.log", lines)
    all_rows = load_app_logs(spark, scratch).collect()
    assert len(all_rows) == 2
    recent = load_app_logs(spark, scratch, hours=24, as_of="2026-06-17 08:00:00").collect()
    assert [(r.level, r.logger, r.message) for r in recent] == [
        ("ERROR", "app.service", "Database connection failed: timeout")]
    # equality with the cutoff is kept
    assert len(load_app_logs(spark, scratch, hours=24, as_of="2026-06-16 08:00:00").collect()) == 2


def test_union_sources(spark, scratch):
    write(f"{scratch}/h/x.log", [GOOD])
    write(f"{scratch}/a/y.log", ["2026-06-16T08:00:00 — INFO — app — hello"])
    u = union_sources(("hadoop", load_hadoop_logs(spark, f"{scratch}/h")),
                      ("app", load_app_logs(spark, f"{scratch}/a")))
    assert sorted((r.source, r.level) for r in u.collect()) == [("app", "INFO"), ("hadoop", "ERROR")]


def test_sort_entries_keeps_file_order_on_ties(spark, scratch):
    from logpulse.operators import sort_entries
    from logpulse.sources import parse_hadoop_lines

    same = "2015-10-18 21:40:23,154 INFO [main] a.B: "
    write(f"{scratch}/b.log", [same + f"b{i}" for i in range(50)])
    write(f"{scratch}/a.log", ["2015-10-18 21:40:24,000 INFO [main] a.B: later"] + [same + f"a{i}" for i in range(50)])
    lines = read_log_lines(spark, scratch, with_position=True)
    got = [r.message for r in sort_entries(parse_hadoop_lines(lines)).collect()]
    assert got == [f"a{i}" for i in range(50)] + [f"b{i}" for i in range(50)] + ["later"]
