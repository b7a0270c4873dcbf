"""Summarise stage times from a Spark event log (no UI, no server).

usage: python tools/stage_times.py EVENT_LOG_FILE [top_n]

Per completed stage: duration, tasks, median and max task time (a max far
above the median flags skew), shuffle read/write bytes."""
import json
import statistics
import sys
from collections import defaultdict


def _files(path):
    """An event log file, or a rolling event-log folder (eventlog_v2_*)."""
    import os
    if os.path.isdir(path):
        inner = [os.path.join(path, n) for n in sorted(os.listdir(path)) if n.startswith("events_")]
        if not inner:          # the parent folder given: take its first log
            sub = [os.path.join(path, n) for n in sorted(os.listdir(path))]
            return _files(sub[0]) if sub else []
        return inner
    return [path]


def _lines(path):
    import io
    for p in _files(path):
        if p.endswith(".zstd"):
            import zstandard
            with open(p, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(p) as f:
                yield from f


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    tasks = defaultdict(list)
    shuffle = defaultdict(lambda: [0, 0])
    stages = []
    if True:
        for line in _lines(path):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerTaskEnd":
                sid = e["Stage ID"]
                info = e["Task Info"]
                tasks[sid].append(info["Finish Time"] - info["Launch Time"])
                m = e.get("Task Metrics") or {}
                shuffle[sid][0] += (m.get("Shuffle Read Metrics") or {}).get("Remote Bytes Read", 0) \
                    + (m.get("Shuffle Read Metrics") or {}).get("Local Bytes Read", 0)
                shuffle[sid][1] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                if "Completion Time" in si and "Submission Time" in si:
                    stages.append((si["Completion Time"] - si["Submission Time"], si["Stage ID"],
                                   si["Stage Name"][:60]))
    stages.sort(reverse=True)
    print(f"{'ms':>7} {'stage':>5} {'tasks':>5} {'med':>6} {'max':>6} {'shufR':>10} {'shufW':>10}  name")
    for dur, sid, name in stages[:top]:
        t = tasks.get(sid, [0])
        print(f"{dur:7d} {sid:5d} {len(t):5d} {statistics.median(t):6.0f} {max(t):6d} "
              f"{shuffle[sid][0]:10d} {shuffle[sid][1]:10d}  {name}")
    total = sum(d for d, _, _ in stages)
    print(f"stages: {len(stages)}, summed stage time {total} ms")


if __name__ == "__main__":
    main()
