"""Per-job / per-stage durations from a Spark event log folder (plain or zstd).

Usage: python scripts/stage_times.py <eventlog_dir> [job_group]
"""

from __future__ import annotations

import collections
import io
import json
import os
import sys


def _lines(path):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            data = zstandard.ZstdDecompressor().stream_reader(fh).read()
        yield from io.StringIO(data.decode("utf-8"))
    else:
        with open(path) as fh:
            yield from fh


def main():
    root = sys.argv[1]
    group = sys.argv[2] if len(sys.argv) > 2 else None
    files = sorted(os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs
                   if f.startswith("events_") or f.startswith("local-") or f.startswith("app-"))
    jobs, stages, tasks = {}, {}, collections.defaultdict(list)
    for fn in files:
        for line in _lines(fn):
            line = line.strip()
            if not line:
                continue
            e = json.loads(line)
            ev = e["Event"]
            if ev == "SparkListenerJobStart":
                props = e.get("Properties", {}) or {}
                jobs[e["Job ID"]] = {"start": e["Submission Time"], "group": props.get("spark.jobGroup.id"),
                                     "stages": e["Stage IDs"]}
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]]["end"] = e["Completion Time"]
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si.get("Submission Time"), si.get("Completion Time"),
                                          si["Number of Tasks"], si["Stage Name"][:60])
            elif ev == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                tasks[e["Stage ID"]].append(ti["Finish Time"] - ti["Launch Time"])
    sel = [j for j in jobs.values() if group is None or j["group"] == group]
    if not sel:
        print("no jobs")
        return
    t0 = min(j["start"] for j in sel)
    for jid, j in sorted(jobs.items()):
        if group is not None and j["group"] != group:
            continue
        print(f"job {jid:3d} +{j['start'] - t0:6d}ms  {j.get('end', 0) - j['start']:6d}ms")
        for s in j["stages"]:
            if s in stages and stages[s][0]:
                a, b, n, name = stages[s]
                ts = sorted(tasks[s]) or [0]
                print(f"     stage {s:3d} +{a - t0:6d}  {b - a:6d}ms  tasks {n:3d}  task ms min/med/max "
                      f"{ts[0]}/{ts[len(ts) // 2]}/{ts[-1]}  {name}")


if __name__ == "__main__":
    main()
