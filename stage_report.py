"""Slowest stages from a Spark event log (written with spark.eventLog.enabled).

    python stage_report.py <event log file or folder> [top_n]
"""

from __future__ import annotations

import io
import json
import os
import sys


def _event_files(path: str):
    if not os.path.isdir(path):
        yield path
        return
    for root, _, names in os.walk(path):
        for n in sorted(names):
            if n.startswith("events") or n.startswith("local-") or n.startswith("app-"):
                yield os.path.join(root, n)


def _lines(f: str):
    if f.endswith(".zstd"):
        import zstandard
        with open(f, "rb") as raw:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
    else:
        with open(f) as fh:
            yield from fh


def stages(path: str):
    jobs = {}
    for f in _event_files(path):
        if True:
            for line in _lines(f):
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = ev.get("Properties", {}).get("spark.job.description") or ""
                    for sid in ev.get("Stage IDs", []):
                        jobs[sid] = desc
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    if "Completion Time" in info and "Submission Time" in info:
                        yield (info["Completion Time"] - info["Submission Time"], info["Stage ID"],
                               info["Number of Tasks"], info["Stage Name"].split("\n")[0][:90],
                               jobs.get(info["Stage ID"], "")[:60])


def main(argv):
    top = int(argv[2]) if len(argv) > 2 else 25
    rows = sorted(stages(argv[1]), reverse=True)
    total = sum(r[0] for r in rows)
    print(f"{len(rows)} stages, {total / 1000:.1f} s of stage time")
    for ms, sid, tasks, name, desc in rows[:top]:
        print(f"{ms / 1000:7.2f}s  stage {sid:5d}  tasks {tasks:4d}  {name}  {desc}")
    per_desc: dict[str, list[int]] = {}
    for ms, _, tasks, _, desc in rows:
        acc = per_desc.setdefault(desc or "(no description)", [0, 0, 0])
        acc[0] += ms
        acc[1] += 1
        acc[2] += tasks
    print("\nstage time per job description (query / published table):")
    for desc, (ms, n, tasks) in sorted(per_desc.items(), key=lambda kv: -kv[1][0]):
        print(f"{ms / 1000:7.2f}s  {n:4d} stages  {tasks:6d} tasks  {desc}")


if __name__ == "__main__":
    main(sys.argv)
