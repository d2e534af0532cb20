"""Summarise a Spark event log: wall time per job and the slowest stages.

Usage: python scripts/stage_times.py <event-log-file>
"""

from __future__ import annotations

import io
import json
import os
import re
import sys


def lines(path: str):
    """Events of a plain log file or of a rolling log directory (zstd or plain)."""
    files = [path]
    if os.path.isdir(path):
        files = sorted(os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_"))
    for p in files:
        with open(p, "rb") as f:
            data = f.read()
        if p.endswith(".zstd"):
            import zstandard

            data = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data)).read()
        yield from data.decode("utf-8").splitlines()


def main() -> None:
    jobs, stages, names = {}, {}, {}
    if True:
        for line in lines(sys.argv[1]):
            try:
                e = json.loads(line)
            except ValueError:
                # a job start whose description holds a cut escape: take the fields we need
                m = re.search(r'"Event":"(SparkListenerJobStart)","Job ID":(\d+),"Submission Time":(\d+)', line)
                if not m:
                    continue
                ids = re.search(r'"Stage IDs":\[([0-9,]*)\]', line)
                e = {"Event": m.group(1), "Job ID": int(m.group(2)), "Submission Time": int(m.group(3)),
                     "Stage IDs": [int(x) for x in ids.group(1).split(",") if x] if ids else []}
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [e["Submission Time"], None, e.get("Stage IDs", [])]
            elif ev == "SparkListenerJobEnd":
                if e["Job ID"] in jobs:
                    jobs[e["Job ID"]][1] = e["Completion Time"]
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si.get("Completion Time", 0) - si.get("Submission Time", 0), si["Number of Tasks"])
                names[si["Stage ID"]] = si["Stage Name"]
    total = 0
    for j, (a, b, st) in sorted(jobs.items()):
        d = (b or a) - a
        total += d
        print(f"job {j}: {d} ms, stages {st}")
    print(f"sum of job times: {total} ms")
    for s, (d, n) in sorted(stages.items(), key=lambda x: -x[1][0])[:10]:
        print(f"stage {s}: {d} ms, {n} tasks, {names[s][:60]}")


if __name__ == "__main__":
    main()
