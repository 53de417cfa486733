"""What every registered query of the catalog did, from Spark's event log.

usage: python scripts/plan_summary.py [sf_dir [key ...]] > docs/plans.md
       python scripts/plan_summary.py --json sf_dir key ...
A query may run several jobs (writes in between, micro-batches): all of them count. Per query: scans of
the given tables (a scan that is reused counts once), rows that tasks read from files, exchanges that ran and
MB they wrote, joins, windows, Python nodes.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

JOINS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct")


def nodes(plan: dict) -> list[tuple[str, dict]]:
    """(name, metadata) of the nodes of a plan as the event log has it."""
    name = plan["nodeName"]
    if name.startswith("Reused"):
        return [(name, plan.get("metadata", {}))]
    return [(name, plan.get("metadata", {})), *[x for c in plan["children"] for x in nodes(c)]]


def summary(events: list[dict], sf_dir: str) -> dict:
    plans: dict[int, dict] = {}
    out = Counter(rows=0, shuffled=0)
    for e in events:
        if "sparkPlanInfo" in e:
            plans[e["executionId"]] = e["sparkPlanInfo"]  # the last of an execution is the one that ran
        elif e["Event"] == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            out["rows"] += m.get("Input Metrics", {}).get("Records Read", 0)
            out["shuffled"] += m.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
    found = [x for p in plans.values() for x in nodes(p)]
    names = Counter(re.sub(r" \(\d+\)$", "", n) for n, _ in found)
    tables = Counter()
    for n, meta in found:
        if n.startswith("Scan") and (m := re.search(rf"{re.escape(sf_dir.rstrip('/'))}/(\w+)\.parquet", meta.get("Location", "") + n)):
            tables[m[1]] += 1
        elif n.startswith("MicroBatchScan") or "FileStream" in n:
            tables["stream"] += 1
    return {"scans": dict(tables), "rows": out["rows"], "shuffles": names["Exchange"], "mb": round(out["shuffled"] / 1e6, 2),
            "joins": {j: names[j] for j in JOINS if names[j]}, "windows": names["Window"],
            "python": {n: c for n, c in names.items() if re.search("Python|Arrow|Pandas", n)}}


def main(args: list[str]) -> None:
    as_json = "--json" in args
    args = [a for a in args if a != "--json"]
    sf = args[0] if args else "/root/testdata/sf0.01"

    from logpulse.plans.catalog import QUERIES
    from logpulse.session import local_session

    log = Path(tempfile.mkdtemp(prefix="plan-events-"))
    spark = local_session(8, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log}",
                                    "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
                                    "spark.sql.maxMetadataStringLength": "2000"})
    spans = {}
    for key in args[1:] or QUERIES:
        t = time.time()
        QUERIES[key](spark, sf).write.format("noop").mode("overwrite").save()
        spans[key] = (t, time.time())
    spark.stop()
    events = [json.loads(line) for p in log.iterdir() for line in p.open()]
    begun = {}
    for e in events:
        if "executionId" in e and "time" in e:
            begun.setdefault(e["executionId"], e["time"] / 1000)
    when = lambda e: (begun.get(e["executionId"]) if "executionId" in e
                      else e["Task Info"]["Launch Time"] / 1000 if "Task Info" in e else None)
    result = {key: summary([e for e in events if (t := when(e)) and a <= t <= b], sf) for key, (a, b) in spans.items()}
    if as_json:
        print(json.dumps(result))
        return
    print(f"# Executed plans ({sf}, local[8], AQE on)\n\nGenerated by `scripts/plan_summary.py` from Spark's event log: all jobs of a query.\n")
    print("| key | scans of the tables | rows read from files | exchanges | MB shuffled | joins | windows | Python |\n|---|---|---|---|---|---|---|---|")
    text = lambda d: ", ".join(f"{n} {k}" for k, n in d.items()) or "-"
    for key, r in result.items():
        print(f"| {key} | {text(r['scans'])} | {r['rows']} | {r['shuffles']} | {r['mb']} | {text(r['joins'])} | {r['windows']} | {text(r['python'])} |")


if __name__ == "__main__":
    main(sys.argv[1:])
