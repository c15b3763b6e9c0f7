"""Summarise a Spark event log: wall time per job group (query) and its slowest stages.

Usage: python tests/stage_times.py <event-log folder or file>
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _open(path: str):
    """Event logs are zstd-compressed by default in Spark 4."""
    if path.endswith((".zstd", ".zst")):
        import io

        import zstandard
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(path, "rb")), encoding="utf-8")
    return open(path)


def main(path: str) -> None:
    files = ([os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.startswith("events_")]
             if os.path.isdir(path) else [path])
    job_group, stage_job, stage_info = {}, {}, {}
    for f in files:
        with _open(f) as fh:
            for line in fh:
                e = json.loads(line)
                kind = e.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (e.get("Properties") or {}).get("spark.jobGroup.id", "-")
                    job_group[e["Job ID"]] = group
                    for sid in e.get("Stage IDs", []):
                        stage_job[sid] = e["Job ID"]
                elif kind == "SparkListenerStageCompleted":
                    info = e["Stage Info"]
                    dur = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000.0
                    stage_info[info["Stage ID"]] = (info["Stage Name"], info["Number of Tasks"], dur)
    per_group = defaultdict(list)
    for sid, (name, tasks, dur) in stage_info.items():
        per_group[job_group.get(stage_job.get(sid), "-")].append((dur, sid, tasks, name))
    for group, stages in sorted(per_group.items(), key=lambda kv: -sum(s[0] for s in kv[1])):
        print(f"{group:36s} stages={len(stages):3d} stage-seconds={sum(s[0] for s in stages):7.2f}")
        for dur, sid, tasks, name in sorted(stages, reverse=True)[:3]:
            print(f"    stage {sid:5d} {dur:6.2f}s tasks={tasks:4d} {name[:60]}")


if __name__ == "__main__":
    main(sys.argv[1])
