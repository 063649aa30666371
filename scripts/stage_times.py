"""Summarise a Spark event log: per job, its duration and its stages' task counts/times.

Usage: python scripts/stage_times.py <event log file or folder> [top_n]
"""

from __future__ import annotations

import json
import os
import sys


def load(path: str) -> list[dict]:
    """A log file, a rolled log folder (``eventlog_v2_*``) or a folder of logs (newest)."""
    if os.path.isdir(path) and not os.path.basename(path).startswith("eventlog_v2"):
        entries = [os.path.join(path, f) for f in os.listdir(path)]
        path = max(entries, key=os.path.getmtime)
    files = ([os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("events_")]
             if os.path.isdir(path) else [path])
    events = []
    for f in files:
        if f.endswith(".zstd"):
            import io

            import zstandard
            with open(f, "rb") as raw:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), "utf-8")
                events += [json.loads(line) for line in text if line.strip()]
        else:
            with open(f) as fh:
                events += [json.loads(line) for line in fh if line.strip()]
    return events


def main() -> None:
    events = load(sys.argv[1])
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    jobs, stages = {}, {}
    for e in events:
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            jobs[e["Job ID"]] = {"start": e["Submission Time"], "stages": e["Stage IDs"]}
        elif kind == "SparkListenerJobEnd":
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            stages[info["Stage ID"]] = (info["Stage Name"][:60], info["Number of Tasks"],
                                        info.get("Completion Time", 0) - info.get("Submission Time", 0))
    ranked = sorted(jobs.items(), key=lambda kv: -(kv[1].get("end", 0) - kv[1]["start"]))[:top]
    for jid, j in ranked:
        print(f"job {jid}: {j.get('end', 0) - j['start']} ms")
        for sid in j["stages"]:
            if sid in stages:
                name, n, ms = stages[sid]
                print(f"   stage {sid}: {n} tasks {ms} ms  {name}")


if __name__ == "__main__":
    main()
