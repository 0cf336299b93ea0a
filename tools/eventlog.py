"""Summarise a Spark event log: wall time per job and per stage.

    python tools/eventlog.py <event-log-file-or-dir> [top_n]
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _open(path):
    if path.endswith(".zstd"):
        import io
        import zstandard
        raw = open(path, "rb")
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True),
                                encoding="utf-8")
    return open(path)


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    while os.path.isdir(path):
        cands = glob.glob(os.path.join(path, "events_*")) or glob.glob(os.path.join(path, "*"))
        path = sorted(cands, key=os.path.getmtime)[-1]
    files = [path]
    if "events_" in os.path.basename(path):
        files = sorted(glob.glob(os.path.join(os.path.dirname(path), "events_*")))
    jobs, stages, tasks = {}, {}, {}
    for f in files:
      with _open(f) as fh:
        for line in fh:
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = {"start": e["Submission Time"], "stages": len(e["Stage Infos"]),
                                     "desc": e.get("Properties", {}).get("callSite.short", "")}
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]]["end"] = e["Completion Time"]
            elif ev == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                tasks.setdefault(e["Stage ID"], []).append(ti["Finish Time"] - ti["Launch Time"])
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = {"ms": si.get("Completion Time", 0) - si.get("Submission Time", 0),
                                          "tasks": si["Number of Tasks"], "name": si["Stage Name"][:60]}
    dur = sorted(((j.get("end", j["start"]) - j["start"], jid, j) for jid, j in jobs.items()), reverse=True)
    print(f"jobs={len(jobs)} total_job_ms={sum(d for d, _, _ in dur)} stages={len(stages)}")
    for d, jid, j in dur[:top]:
        print(f"  job {jid:4d} {d:6d} ms stages={j['stages']:3d} {j['desc']}")
    sd = sorted(stages.items(), key=lambda kv: -kv[1]["ms"])[:top]
    for sid, s in sd:
        t = sorted(tasks.get(sid, [0]))
        print(f"  stage {sid:4d} {s['ms']:6d} ms tasks={s['tasks']:4d} "
              f"task max/median={t[-1]}/{t[len(t) // 2]} ms {s['name']}")


if __name__ == "__main__":
    main()
