"""tools/stage_times.py reads plain and zstd event logs."""

import json
import os
import subprocess
import sys
import tempfile

import zstandard

TOOL = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                    "tools", "stage_times.py")
EVENTS = [
    {"Event": "SparkListenerJobStart", "Job ID": 0},
    {"Event": "SparkListenerStageCompleted",
     "Stage Info": {"Stage Name": "scan", "Number of Tasks": 8,
                    "Submission Time": 1000, "Completion Time": 3500}},
]


def _run(path):
    out = subprocess.run([sys.executable, TOOL, path], capture_output=True, text=True, timeout=60)
    assert out.returncode == 0, out.stderr
    return out.stdout


def test_stage_times_plain_and_zstd():
    d = tempfile.mkdtemp(prefix="evlog-")
    text = "\n".join(json.dumps(e) for e in EVENTS) + "\n"
    with open(f"{d}/plain.log", "w") as f:
        f.write(text)
    assert "jobs=1 stages=1 stage_seconds=2.50" in _run(f"{d}/plain.log")
    os.makedirs(f"{d}/eventlog_v2_x")
    with open(f"{d}/eventlog_v2_x/events_1_x.zstd", "wb") as f:
        f.write(zstandard.ZstdCompressor().compress(text.encode()))
    out = _run(f"{d}/eventlog_v2_x")
    assert "2.50s     8 tasks  scan" in out
