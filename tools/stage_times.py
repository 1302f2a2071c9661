"""Summarise a Spark event log: wall time of jobs and stages per job group (bench key).

Usage: python tools/stage_times.py <event log dir> [key ...]
Reads plain, rolled (eventlog_v2_*) and zstd-compressed logs.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys


def _lines(path):
    if path.endswith(".zstd"):
        import zstandard
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(path, "rb")), encoding="utf-8")
    return open(path, encoding="utf-8")


def events(folder):
    files = sorted(p for p in glob.glob(os.path.join(folder, "**", "*"), recursive=True)
                   if os.path.isfile(p) and "appstatus" not in os.path.basename(p))
    for f in files:
        for line in _lines(f):
            if line.strip():
                yield json.loads(line)


def main():
    folder, keys = sys.argv[1], set(sys.argv[2:])
    job_group, job_start, stage_job = {}, {}, {}
    jobs = collections.defaultdict(list)
    stages = collections.defaultdict(list)
    for e in events(folder):
        kind = e["Event"]
        if kind == "SparkListenerJobStart":
            group = (e.get("Properties") or {}).get("spark.jobGroup.id", "")
            job_group[e["Job ID"]] = group
            job_start[e["Job ID"]] = e["Submission Time"]
            for sid in e.get("Stage IDs", []):
                stage_job[sid] = e["Job ID"]
        elif kind == "SparkListenerJobEnd":
            jid = e["Job ID"]
            jobs[job_group.get(jid, "")].append(e["Completion Time"] - job_start.get(jid, e["Completion Time"]))
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            group = job_group.get(stage_job.get(info["Stage ID"]), "")
            if "Submission Time" in info and "Completion Time" in info:
                stages[group].append((info["Number of Tasks"], info["Completion Time"] - info["Submission Time"]))
    print("| key | jobs | job ms (sum) | stages | slowest stage ms (tasks) |")
    print("| --- | --- | --- | --- | --- |")
    for group in sorted(jobs, key=lambda g: -sum(jobs[g])):
        if keys and group not in keys:
            continue
        slow = max(stages[group], key=lambda t: t[1], default=(0, 0))
        print(f"| `{group}` | {len(jobs[group])} | {sum(jobs[group])} | {len(stages[group])} | {slow[1]} ({slow[0]}) |")


if __name__ == "__main__":
    main()
