"""Summarise stage and job times from a Spark event log (no UI needed).

Usage: python tools/stage_times.py EVENT_LOG [top]
(EVENT_LOG: a log file, or a rolling ``eventlog_v2_*`` folder)
Prints the slowest stages (name, tasks, seconds) and the job count.
"""

from __future__ import annotations

import json
import os
import sys


def _lines(path):
    files = ([os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("events")]
             if os.path.isdir(path) else [path])
    for fp in files:
        if fp.endswith(".zstd"):
            import io

            import zstandard
            with open(fp, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(fp) as f:
                yield from f


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, jobs = [], 0
    for line in _lines(path):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            jobs += 1
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            t0, t1 = info.get("Submission Time"), info.get("Completion Time")
            if t0 and t1:
                stages.append(((t1 - t0) / 1000.0, info["Number of Tasks"],
                               info["Stage Name"][:90]))
    stages.sort(reverse=True)
    print(f"jobs={jobs} stages={len(stages)} stage_seconds={sum(s[0] for s in stages):.2f}")
    for sec, tasks, name in stages[:top]:
        print(f"{sec:8.2f}s {tasks:5d} tasks  {name}")


if __name__ == "__main__":
    main()
