"""Reports, checks and streams read the given table once, counted in Spark's event log."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ONCE = ["health_report", "report_fields", "report_spikes", "status_check", "alert_events", "stream_status_alerts",
        "stream_window_rates", "severity_share", "spike_lift", "numbered_entries", "incidents_by_svc"]


def test_one_scan_each():
    out = subprocess.run([sys.executable, f"{ROOT}/scripts/plan_summary.py", "--json", "/root/testdata/sf0.001", *ONCE, "status_check_history"],
                         capture_output=True, text=True, timeout=600, env={**os.environ, "PYTHONPATH": ROOT})
    assert out.returncode == 0, out.stderr[-2000:]
    seen = json.loads(out.stdout)
    assert {k: seen[k]["scans"].get("events") for k in ONCE} == dict.fromkeys(ONCE, 1)
    assert seen["status_check_history"]["scans"]["events"] == 4  # one a check
    assert not any(r["python"] for r in seen.values())
    assert not any(j in r["joins"] for r in seen.values() for j in ("CartesianProduct", "BroadcastNestedLoopJoin"))
