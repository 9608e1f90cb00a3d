"""Shuffle bytes written and read per query, from Spark's event log (written to a scratch folder).

Usage: python tools/shuffle_bytes.py [sf_dir] [name ...]  -> one JSON line {query: {written, read, tasks}}.
Each query runs once in its own job group; the event log is parsed after the session stops.
"""

from __future__ import annotations

import glob
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import tempfile  # noqa: E402

from bench import HEADLINE  # noqa: E402
from tillstar.queries import QUERIES  # noqa: E402
from tillstar.session import build_session  # noqa: E402


def parse(log_dir: str) -> dict:
    stage_group, out = {}, {}
    for path in [p for p in glob.glob(f"{log_dir}/**/*", recursive=True) if os.path.isfile(p)]:
        with open(path) as f:
            for line in f:
                e = json.loads(line)
                ev = e.get("Event")
                if ev == "SparkListenerJobStart":
                    group = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in e.get("Stage IDs", []):
                        stage_group[sid] = group
                elif ev == "SparkListenerTaskEnd":
                    group = stage_group.get(e.get("Stage ID"))
                    if not group:
                        continue
                    m = e.get("Task Metrics") or {}
                    w = (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    r = m.get("Shuffle Read Metrics") or {}
                    rb = r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0)
                    o = out.setdefault(group, {"shuffle_written": 0, "shuffle_read": 0, "tasks": 0})
                    o["shuffle_written"] += w
                    o["shuffle_read"] += rb
                    o["tasks"] += 1
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or HEADLINE
    log_dir = tempfile.mkdtemp(prefix="tillstar-eventlog-", dir="/tmp")
    spark = build_session("local[8]", 8, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                                  "spark.eventLog.compress": "false"})
    sc = spark.sparkContext
    for name in names:
        sc.setJobGroup(name, name)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()
    print(json.dumps(parse(log_dir)))


if __name__ == "__main__":
    main()
