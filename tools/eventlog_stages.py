"""Summarise a Spark event log: total stage time and the slowest stages.

    spark.eventLog.enabled=true, spark.eventLog.dir=<scratch folder>
    python tools/eventlog_stages.py <event log file or folder> [n]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True)) \
        if os.path.isdir(path) else [path]
    for f in files:
        if f.endswith(".zstd"):
            import zstandard
            stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(f, "rb")),
                                      encoding="utf-8")
        else:
            stream = open(f, encoding="utf-8")
        yield from stream


def main() -> None:
    path = sys.argv[1]
    n = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    stages, jobs, desc = [], {}, {}
    for line in lines(path):
        e = json.loads(line)
        kind = e["Event"]
        if kind == "SparkListenerJobStart":
            jobs[e["Job ID"]] = e["Submission Time"]
            props = e.get("Properties") or {}
            for sid in e.get("Stage IDs", []):
                desc[sid] = props.get("spark.job.description", "")
        elif kind == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages.append((si["Completion Time"] - si["Submission Time"], si["Stage ID"],
                           si["Number of Tasks"], desc.get(si["Stage ID"], ""), si["Stage Name"][:50]))
    stages.sort(reverse=True)
    print(f"{len(jobs)} jobs, {len(stages)} stages, {sum(s[0] for s in stages)} ms of stage time")
    for ms, sid, tasks, d, name in stages[:n]:
        print(f"{ms:7d} ms  stage {sid:4d}  tasks {tasks:4d}  {d:40s} {name}")


if __name__ == "__main__":
    main()
