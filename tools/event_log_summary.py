"""Summarise a Spark event log folder: job and stage wall times.

    python tools/event_log_summary.py <eventlog folder or file>
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path):
    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as fh:
            text = zstandard.ZstdDecompressor().stream_reader(fh).read().decode()
        return io.StringIO(text)
    return open(path, encoding="utf-8")


def main(target: str) -> None:
    files = sorted(glob.glob(os.path.join(target, "**", "events_*"), recursive=True)) if os.path.isdir(target) else [target]
    jobs, stages = {}, {}
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            ev = e["Event"]
            if ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = {"start": e["Submission Time"], "stages": e["Stage IDs"]}
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]]["end"] = e["Completion Time"]
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                took = si.get("Completion Time", 0) - si.get("Submission Time", 0)
                stages[si["Stage ID"]] = (si["Stage Name"][:60], si["Number of Tasks"], took)
    if not jobs:
        return
    t0 = min(v["start"] for v in jobs.values())
    for j, v in sorted(jobs.items()):
        print(f"job {j}: +{v['start'] - t0} ms, {v.get('end', 0) - v['start']} ms")
        for s in v["stages"]:
            if s in stages:
                name, tasks, took = stages[s]
                print(f"    stage {s}: {took} ms, {tasks} tasks, {name}")


if __name__ == "__main__":
    main(sys.argv[1])
