"""Log files that grow, rotate and are truncated; alert state by batch; published tables."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logpulse.constants import HealthParams
from logpulse.functions import repaired
from logpulse.jobs import log_watcher, poll_alerts, watch_alerts
from logpulse.operators import window_alerts, window_error_rate
from logpulse.sources import load_hadoop_logs, parse_hadoop_lines, published, read_log_lines
from logpulse.sources import growing
from logpulse.sources.growing import LineLedger, list_files, log_lines, placed_lines
from logpulse.streaming import AlertState, finished


def line(t, level="INFO", msg="m"):
    return f"{t:%Y-%m-%d %H:%M:%S},000 {level} [main] app.Test: {msg}\n"


def put(path, data, mode="wb"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as f:
        f.write(data.encode() if isinstance(data, str) else data)


def batch_lines(spark, folder):
    return sorted(r.value for r in read_log_lines(spark, folder).collect())


class Polls:
    """Every line that polls of one ledger took, each poll with a ledger object of its own (a restart)."""

    def __init__(self, spark, scratch):
        self.spark, self.logs, self.path, self.taken = spark, f"{scratch}/logs", f"{scratch}/ledger", []

    def __call__(self):
        ledger = LineLedger(self.spark, self.path)
        _, lines = ledger.poll(self.logs)
        new = sorted(r.value for r in log_lines(lines).collect())
        ledger.commit()
        self.taken += new
        return new


@pytest.fixture
def polls(spark, scratch):
    os.makedirs(f"{scratch}/logs")
    return Polls(spark, scratch)


def test_appended_lines_are_taken_once(spark, polls):
    a, b = f"{polls.logs}/x/a.log", f"{polls.logs}/b.log"
    assert polls() == []
    put(a, "one\ntwo\n")
    assert sorted(polls()) == ["one", "two"]
    put(a, "three\nfo", "ab")
    put(b, "b1\r\nb2\rb3\n\n")
    assert sorted(polls()) == ["", "b1", "b2", "b3", "three"]  # an open line waits
    put(a, "ur\n", "ab")
    assert polls() == ["four"] and polls() == []
    assert sorted(polls.taken) == batch_lines(spark, polls.logs)


def test_a_line_left_open_is_taken_after_two_polls(spark, polls):
    a = f"{polls.logs}/a.log"
    put(a, "one\nopen")
    assert polls() == ["one"] and polls() == ["open"] and polls() == []
    put(a, " ended\ntwo\n", "ab")
    assert polls() == [" ended", "two"] and polls() == []
    put(a, "last", "ab")
    assert polls() == [] and polls() == ["last"]
    put(a, "\n", "ab")
    assert polls() == [] and polls() == []
    put(a, "after\n", "ab")
    assert polls() == ["after"]


def test_rotated_files_go_on_under_their_new_name(spark, polls):
    a, old = f"{polls.logs}/app.log", f"{polls.logs}/app-1.log"
    put(a, "h\n1\n2\n")
    polls()
    put(a, "3\n", "ab")       # not taken before the file is renamed
    os.rename(a, old)
    put(a, "h\nnew\n")        # the new file has the same first line
    assert sorted(polls()) == ["3", "h", "new"]
    assert sorted(polls.taken) == batch_lines(spark, polls.logs)
    put(old, "4\n", "ab")
    put(a, "newer\n", "ab")
    assert sorted(polls()) == ["4", "newer"] and polls() == []


def test_copied_and_truncated_files(spark, polls):
    a, old = f"{polls.logs}/app.log", f"{polls.logs}/app-1.log"
    put(a, "h\n1\n2\n")
    polls()
    put(old, "h\n1\n2\n3\n")  # copied with a line that was not taken, then truncated
    put(a, "")
    assert polls() == ["3"] and polls() == []
    put(a, "n1\nn2\nn3\nn4\n")
    assert sorted(polls()) == ["n1", "n2", "n3", "n4"]
    assert sorted(polls.taken) == batch_lines(spark, polls.logs)
    put(a, "k\nl\n")          # truncated and shorter, then longer with other lines
    assert sorted(polls()) == ["k", "l"]
    put(a, "kk\nll\nmm\nnn\noo\n")
    assert sorted(polls()) == ["kk", "ll", "mm", "nn", "oo"]
    os.remove(a)
    os.remove(old)
    assert polls() == [] and LineLedger(spark, polls.path).entries().count() == 0


def test_a_failed_poll_is_run_again(spark, polls):
    a = f"{polls.logs}/a.log"
    put(a, "1\n2\n")
    ledger = LineLedger(spark, polls.path)
    version, lines = ledger.poll(polls.logs)
    assert lines.count() == 2
    put(a, "3\n", "ab")       # no commit: the next poll takes all of it
    assert sorted(polls()) == ["1", "2", "3"] and version == 1 and LineLedger(spark, polls.path).version() == 1


@pytest.mark.parametrize("named", [5_000, 1])
def test_random_histories_equal_the_batch_read(spark, polls, monkeypatch, named):
    monkeypatch.setattr(growing, "NAMED_FILES", named)
    rnd = random.Random(41)
    n = 0
    for _ in range(6):
        for name in "abc":
            path = f"{polls.logs}/{name}.log"
            what = rnd.random()
            if what < 0.2 and os.path.exists(path):
                os.rename(path, f"{polls.logs}/{name}-{n}.log")
            if what < 0.8:
                put(path, "".join(f"{rnd.randrange(10**9)}-é\n" for _ in range(rnd.randrange(1, 30))), "ab")
            n += 1
        polls()
    assert len(polls.taken) > 100 and sorted(polls.taken) == batch_lines(spark, polls.logs)


def test_places_add_up_over_splits(spark, scratch):
    """Small splits, so that lines and files cross their borders."""
    rnd = random.Random(43)
    want = {}
    for f in "ab":
        raw = b"".join(bytes(rnd.choices(b"xy\r\xff\xc3 ", k=rnd.randrange(0, 90))) + b"\n" for _ in range(300))
        put(f"{scratch}/logs/{f}.log", raw)
        want[f] = raw
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "3000")
    try:
        rows = placed_lines(spark, f"{scratch}/logs", "*.log", list_files(spark, f"{scratch}/logs")).collect()
    finally:
        spark.conf.set(key, before)
    assert len(rows) == 600
    for r in rows:
        raw = want[r.file_path[-5]]
        assert raw[r.start:r.start + r.line_bytes] == bytes(r.line) + b"\n"


def test_damaged_bytes_are_replaced_as_python_does(spark, scratch):
    rnd = random.Random(47)
    parts = [b"\xff", b"\xc3", b"\xe2\x82", b"\xf0\x9f\x98", b"\x80", b"\xed\xa0\x80", b"\xc0\xaf", b"\xf4\x90\x80\x80", b"a", "é€😀".encode()]
    raw = [b"".join(rnd.choices(parts, k=rnd.randrange(0, 12))) + bytes(rnd.randrange(256) for _ in range(4)) for _ in range(1500)]
    frame = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(raw)], "i int, b binary")
    for r in frame.select("i", repaired(F.col("b")).alias("t")).collect():
        assert r.t == raw[r.i].decode("utf-8", errors="replace"), raw[r.i]
    data = b"\n".join(b.replace(b"\n", b"").replace(b"\r", b"") for b in raw) + b"\n"
    put(f"{scratch}/logs/d.log", data)
    assert batch_lines(spark, f"{scratch}/logs") == sorted(data.decode("utf-8", errors="replace").split("\n")[:-1])


# ---- the alert state ---------------------------------------------------------

def view(state):
    names = [c for c in state.alerts().columns]
    return sorted((tuple(r) for r in state.alerts().select(*sorted(names)).collect()), key=str)


def batch_view(entries, params, keys=()):
    alerts = window_alerts(entries, params, keys)
    return sorted((tuple(r) for r in alerts.select(*sorted(alerts.columns)).collect()), key=str)


PARAMS = HealthParams(window="1 hour", min_window_entries=2)


def entries_of(make_entries, rows):
    return make_entries([(t, level, "T", msg) for t, level, msg in rows])


def random_rows(rnd, n, days=6):
    t0 = datetime(2024, 3, 1)
    return [(t0 + timedelta(minutes=rnd.randrange(days * 1440)), rnd.choice(["ERROR", "INFO", "INFO"]), f"m{rnd.randrange(3)}") for _ in range(n)]


@pytest.mark.parametrize("keys", [[], ["logger"]])
def test_batches_in_any_order_equal_the_batch_operator(spark, make_entries, scratch, keys):
    rnd = random.Random(53)
    rows = [(*r[:2], rnd.choice("PQ"), r[2]) for r in random_rows(rnd, 260)]
    frame = make_entries([r for r in rows])
    state = AlertState(spark, f"{scratch}/state", f"{scratch}/log", frame.schema, PARAMS, keys)
    for version, a in enumerate(range(0, 260, 65)):
        state.apply(make_entries(rows[a:a + 65]), version)
        assert view(state) == batch_view(make_entries(rows[:a + 65]), PARAMS, keys)
    assert sorted(map(str, state.window_rates().select("window_start", "total_entries").collect())) == sorted(map(str, (
        window_error_rate(frame, PARAMS.window, keys).select("window_start", "total_entries").collect())))


def test_a_late_row_withdraws_alerts_and_replay_changes_nothing(spark, make_entries, scratch):
    day = lambda d, h, m=0: datetime(2024, 3, d, h, m)
    first = [(day(1, 10, i), "ERROR", "x") for i in range(3)] + [(day(2, 9, i), "INFO", "x") for i in range(3)]
    late = [(day(1, 10, 10 + i), "INFO", "late") for i in range(40)] + [(day(1, 10, 55), "INFO", "late")] * 30
    state = AlertState(spark, f"{scratch}/state", f"{scratch}/log", entries_of(make_entries, first).schema, PARAMS)
    state.apply(entries_of(make_entries, first), 1)
    before = state.alerts().select("window_start", "prev_status", "status").collect()
    assert sorted(map(tuple, before)) == [(day(1, 10), "HEALTHY", "CRITICAL"), (day(2, 9), "CRITICAL", "HEALTHY")]
    for _ in range(2):  # run twice, as after a failure
        state.apply(entries_of(make_entries, late), 2)
        assert view(state) == batch_view(entries_of(make_entries, first + late), PARAMS) == []
    log = spark.read.parquet(f"{scratch}/log").select("version", "op", "date").collect()
    assert sorted((r.version, r.op, str(r.date)) for r in log) == [
        (1, "insert", "2024-03-01"), (1, "insert", "2024-03-02"), (2, "withdraw", "2024-03-01"), (2, "withdraw", "2024-03-02")]
    state.apply(entries_of(make_entries, []), 3)
    assert spark.read.parquet(f"{scratch}/log").where("version = 3").count() == 0


def test_work_of_a_batch_does_not_follow_the_history(spark, make_entries, scratch):
    """Many batches on two dates after many others: files and rows that a batch meets stay as few."""
    state = AlertState(spark, f"{scratch}/state", f"{scratch}/log", entries_of(make_entries, []).schema, PARAMS)
    state.apply(entries_of(make_entries, random_rows(random.Random(59), 400, days=20)
                           + [(datetime(2024, 3, 25), "INFO", "calm")] * 3), 0)
    count = lambda: sum(f.startswith("part-") for _, _, files in os.walk(f"{scratch}/state/windows") for f in files)
    sizes = []
    for v in range(1, 15):
        state.apply(entries_of(make_entries, [(datetime(2024, 4, 1 + v % 2, 3, v), "INFO", "m")]), v)
        sizes.append(count())
    assert max(sizes) <= sizes[3] + 2 * 8  # two turns a date, whatever the number of batches
    assert state.windows.read(dates=[datetime(2024, 4, 1).date()]).count() == 1
    logged = [d for d in os.listdir(f"{scratch}/log") if d.startswith("version=")]
    assert len(logged) == 1  # batches without a change write no file


def test_late_rows_are_an_output_of_their_own(spark, make_entries, scratch):
    t0 = datetime(2024, 3, 1, 12)
    batches = [[(t0, "INFO", "a")], [(t0 + timedelta(hours=5), "ERROR", "b"), (t0 - timedelta(hours=3), "INFO", "late1")],
               [(t0 + timedelta(hours=4), "INFO", "in time"), (t0 + timedelta(hours=2), "ERROR", "late2")]]
    state = AlertState(spark, f"{scratch}/state", f"{scratch}/log", entries_of(make_entries, []).schema, PARAMS, lateness="2 hours")
    for v, rows in enumerate(batches, 1):
        for _ in range(2):
            state.apply(entries_of(make_entries, rows), v)
    assert sorted((r.version, r.message) for r in state.late_rows().collect()) == [(2, "late1"), (3, "late2")]
    whole = entries_of(make_entries, [r for b in batches for r in b])
    assert state.window_rates().agg(F.sum("total_entries")).first()[0] == 5 == whole.count()
    assert view(state) == batch_view(whole, PARAMS)


def test_watcher_over_growing_files_equals_the_batch_run(spark, scratch):
    logs, base = f"{scratch}/logs", datetime(2024, 3, 1, 10)
    put(f"{logs}/a.log", "".join(line(base + timedelta(seconds=i)) for i in range(100)))

    def run():
        q, out, ck = watch_alerts(spark, logs, interval=None, output=f"{scratch}/alerts", checkpoint=f"{scratch}/ck")
        finished(q)
        _, state, _ = log_watcher(spark, output=out, checkpoint=ck)
        return view(state)

    assert run() == []
    put(f"{logs}/a.log", "".join(line(base + timedelta(seconds=i), "ERROR", "down") for i in range(100)), "ab")
    whole = load_hadoop_logs(spark, logs)
    assert whole.count() == 200 and run() == batch_view(load_hadoop_logs(spark, logs), HealthParams()) != []
    os.rename(f"{logs}/a.log", f"{logs}/a-1.log")
    put(f"{logs}/a.log", line(base + timedelta(minutes=10)))
    assert run() == batch_view(load_hadoop_logs(spark, logs), HealthParams())
    ledger, state, _ = log_watcher(spark, output=f"{scratch}/alerts", checkpoint=f"{scratch}/ck")
    assert poll_alerts(ledger, state, logs) == 4 and run() == batch_view(load_hadoop_logs(spark, logs), HealthParams())
    assert state.window_rates().agg(F.sum("total_entries")).first()[0] == 201


def test_watcher_polls_at_an_interval(spark, scratch):
    """The clock goes on by itself: lines appended while it runs are taken."""
    import time

    logs, base = f"{scratch}/logs", datetime(2024, 3, 1, 10)
    put(f"{logs}/a.log", "".join(line(base + timedelta(seconds=i)) for i in range(20)))
    q, out, ck = watch_alerts(spark, logs, interval="1 seconds", output=f"{scratch}/alerts", checkpoint=f"{scratch}/ck")
    try:
        _, state, _ = log_watcher(spark, output=out, checkpoint=ck)
        total = lambda: state.window_rates().agg(F.sum("total_entries")).first()[0] or 0
        for n in (20, 30):
            for _ in range(60):
                if (got := total()) >= n or q.exception() is not None:
                    break
                time.sleep(1)
            assert q.exception() is None and got == n
            put(f"{logs}/a.log", "".join(line(base + timedelta(minutes=1, seconds=i)) for i in range(10)), "ab")
    finally:
        q.stop()


# ---- published tables --------------------------------------------------------

def test_a_failure_between_tables_leaves_the_earlier_version(spark, scratch):
    path, schema = f"{scratch}/pub", spark.range(1).schema
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, path, "a", schema)
    published.publish(spark, path, {"a": spark.range(3), "b": spark.range(3)})

    def broken(where):
        raise OSError("disk full")

    with pytest.raises(OSError):
        published.publish(spark, path, {"a": spark.range(7), "b": broken})
    read = lambda name: published.read_published(spark, path, name, schema).count()
    assert (read("a"), read("b")) == (3, 3)
    for n in range(4, 30):
        assert published.publish(spark, path, {"a": spark.range(n), "b": spark.range(n)}) == n - 2
        assert (read("a"), read("b")) == (n, n)
    assert sum(len(f) for _, _, f in os.walk(path)) < 200


def test_parse_keeps_entries_of_damaged_lines(spark, scratch):
    put(f"{scratch}/logs/a.log", line(datetime(2024, 1, 1), "ERROR", "bad").encode().replace(b"bad", b"b\xffd"))
    assert [r.message for r in load_hadoop_logs(spark, f"{scratch}/logs").collect()] == ["b�d"]
    assert parse_hadoop_lines(spark.createDataFrame([], "value string")).count() == 0
