"""Summarise a Spark event log: per job description (bench query), the
wall time of its stages, task count and the slowest stages.

    BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python tools/stages.py $BENCH_EVENT_LOG_DIR/<app-id>
"""

from __future__ import annotations

import json
import sys
from collections import defaultdict


def _lines(path: str):
    import os
    files = [path] if os.path.isfile(path) else sorted(
        os.path.join(path, n) for n in os.listdir(path) if n.startswith("events"))
    for fp in files:
        if fp.endswith(".zstd"):  # Spark's default event log codec
            import io

            import zstandard
            with open(fp, "rb") as raw:
                yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True),
                                            encoding="utf-8")
        else:
            with open(fp) as f:
                yield from f


def main(path: str) -> None:
    job_desc, stage_job, stages = {}, {}, []
    if True:
        for line in _lines(path):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                desc = (e.get("Properties") or {}).get("spark.job.description", "?")
                job_desc[e["Job ID"]] = desc
                for sid in e.get("Stage IDs", []):
                    stage_job[sid] = e["Job ID"]
            elif ev == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                dur = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000
                stages.append((info["Stage ID"], info["Stage Name"], info["Number of Tasks"], dur))
    per = defaultdict(lambda: [0.0, 0, 0])
    for sid, name, tasks, dur in stages:
        q = job_desc.get(stage_job.get(sid), "?")
        per[q][0] += dur
        per[q][1] += 1
        per[q][2] += tasks
    print(f"{'query':28s} {'stage s':>8s} {'stages':>7s} {'tasks':>7s}")
    for q, (d, n, t) in sorted(per.items(), key=lambda kv: -kv[1][0]):
        print(f"{q[:28]:28s} {d:8.2f} {n:7d} {t:7d}")
    print("\nslowest stages:")
    for sid, name, tasks, dur in sorted(stages, key=lambda s: -s[3])[:10]:
        print(f"  {dur:6.2f}s  stage {sid:5d} tasks {tasks:4d}  {job_desc.get(stage_job.get(sid), '?')}: {name[:60]}")


if __name__ == "__main__":
    main(sys.argv[1])
