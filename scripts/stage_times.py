"""Summarise job and stage durations from a Spark event log directory.

Usage: python scripts/stage_times.py EVENT_LOG_DIR [top_n]

Reads plain or zstd-compressed event logs (the Spark 4 default) written with
``spark.eventLog.enabled=true`` and ``spark.eventLog.dir=<scratch folder>``.
"""

from __future__ import annotations

import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd") or path.endswith(".zst"):
        import zstandard

        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    d = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 25
    stages, jobs = {}, {}
    for root, _, files in os.walk(d):
        for name in sorted(files):
            if not name.startswith("events") and not name.startswith("local-"):
                continue
            for line in _lines(os.path.join(root, name)):
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    dur = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000
                    stages[info["Stage ID"]] = (dur, info["Number of Tasks"], info["Stage Name"][:70])
                elif kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description", "")
                    jobs[ev["Job ID"]] = [ev["Submission Time"], None, len(ev.get("Stage IDs", [])), desc[:40]]
                elif kind == "SparkListenerJobEnd" and ev["Job ID"] in jobs:
                    jobs[ev["Job ID"]][1] = ev["Completion Time"]
    total = sum(s[0] for s in stages.values())
    print(f"jobs={len(jobs)} stages={len(stages)} total stage time={total:.2f}s")
    for sid, (dur, n, name) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"stage {sid:4d} {dur:7.2f}s tasks={n:4d} {name}")
    for jid, (a, b, ns, desc) in sorted(jobs.items()):
        if b:
            print(f"job {jid:3d} {(b - a) / 1000:6.2f}s stages={ns:3d} {desc}")


if __name__ == "__main__":
    main()
