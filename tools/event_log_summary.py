"""Per-query job and stage times from a Spark event log (e.g. bench.py with BENCH_EVENT_LOG_DIR).

usage: python tools/event_log_summary.py <event log dir>
Jobs are grouped by job group (bench.py sets one per query).
"""

from __future__ import annotations

import collections
import glob
import io
import json
import sys


def events(path: str):
    for f in sorted(glob.glob(path + "/**/events_*", recursive=True) + glob.glob(path + "/*local-*")):
        if f.endswith(".crc") or "appstatus" in f or not f.split("/")[-1].startswith(("events_", "local-")):
            continue
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode("utf-8", "ignore").splitlines():
            try:
                e = json.loads(line)
            except ValueError:
                continue
            if isinstance(e, dict):
                yield e


def main():
    jobs, stages = {}, {}
    for e in events(sys.argv[1]):
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            props = e.get("Properties", {})
            jobs[e["Job ID"]] = {"start": e["Submission Time"], "group": props.get("spark.jobGroup.id"),
                                 "stages": e["Stage IDs"]}
        elif ev == "SparkListenerJobEnd" and e["Job ID"] in jobs:
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            if "Submission Time" in si:
                stages[si["Stage ID"]] = (si["Stage Name"][:40], si["Completion Time"] - si["Submission Time"],
                                          si["Number of Tasks"])
    by_group = collections.defaultdict(list)
    for j, d in sorted(jobs.items()):
        by_group[d["group"]].append((j, d.get("end", d["start"]) - d["start"], d["stages"]))
    for g, js in by_group.items():
        print(f"== {g}: {len(js)} jobs, {sum(x[1] for x in js)} ms")
        for j, ms, st in sorted(js, key=lambda x: -x[1])[:5]:
            detail = " | ".join(f"s{s} {stages[s][1]}ms/{stages[s][2]}t {stages[s][0]}" for s in st if s in stages)
            print(f"   job {j}: {ms} ms  {detail}")


if __name__ == "__main__":
    main()
