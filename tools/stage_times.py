"""Summarise a Spark event log: the slowest stages with task counts and task time.

    python tools/stage_times.py EVENT_LOG_FILE_OR_FOLDER [top_n]

Reads SparkListenerStageCompleted and SparkListenerTaskEnd events (one JSON
object per line) and prints one line per stage: wall ms, summed task ms,
tasks, records read/written, and the stage name.
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _open(name: str):
    if name.endswith(".zstd"):  # Spark's default event log codec
        import io

        import zstandard

        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(name, "rb")), encoding="utf-8")
    return open(name, encoding="utf-8")


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 25
    task_ms: dict[tuple[int, int], int] = defaultdict(int)
    stages = []
    files = [path]
    if os.path.isdir(path):  # rolling event log: a folder of events_<n>_... files
        files = sorted((os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_")),
                       key=lambda f: int(os.path.basename(f).split("_")[1]))
    for name in files:
        with _open(name) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerTaskEnd":
                    info = ev.get("Task Info", {})
                    key = (ev.get("Stage ID"), ev.get("Stage Attempt ID", 0))
                    task_ms[key] += int(info.get("Finish Time", 0)) - int(info.get("Launch Time", 0))
                elif kind == "SparkListenerStageCompleted":
                    si = ev["Stage Info"]
                    acc = {a.get("Name"): a.get("Value") for a in si.get("Accumulables", [])}
                    stages.append({
                        "id": si["Stage ID"], "attempt": si.get("Stage Attempt ID", 0),
                        "wall_ms": int(si.get("Completion Time", 0)) - int(si.get("Submission Time", 0)),
                        "tasks": si.get("Number of Tasks"),
                        "read": acc.get("internal.metrics.input.recordsRead")
                        or acc.get("internal.metrics.shuffle.read.recordsRead"),
                        "written": acc.get("internal.metrics.output.recordsWritten")
                        or acc.get("internal.metrics.shuffle.write.recordsWritten"),
                        "name": si.get("Stage Name", "")[:60],
                    })
    for st in stages:
        st["task_ms"] = task_ms.get((st["id"], st["attempt"]), 0)
    print(f"{'stage':>6} {'wall_ms':>8} {'task_ms':>8} {'tasks':>6} {'read':>10} {'written':>10}  name")
    for st in sorted(stages, key=lambda s: -s["wall_ms"])[:top]:
        print(f"{st['id']:>6} {st['wall_ms']:>8} {st['task_ms']:>8} {st['tasks']:>6} {str(st['read']):>10} "
              f"{str(st['written']):>10}  {st['name']}")
    print(f"{len(stages)} stages, {sum(s['wall_ms'] for s in stages)} ms stage wall in total")


if __name__ == "__main__":
    main()
