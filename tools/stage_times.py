"""Summarise stage times from a Spark event log folder (no web UI needed).

Usage: BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py
       python tools/stage_times.py "$BENCH_EVENT_LOG_DIR" [top_n]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    with open(path, "rb") as fh:
        raw = fh.read()
    if path.endswith(".zstd"):
        import zstandard

        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    return io.StringIO(raw.decode("utf-8"))


def stages(folder: str):
    out = []
    for path in glob.glob(os.path.join(folder, "**", "*"), recursive=True):
        if not os.path.isfile(path) or "appstatus" in os.path.basename(path):
            continue
        for line in _lines(path):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                out.append({
                    "stage": si["Stage ID"], "tasks": si["Number of Tasks"],
                    "ms": si.get("Completion Time", 0) - si.get("Submission Time", 0),
                    "name": si["Stage Name"],
                })
    return out


def main() -> None:
    folder = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    rows = sorted(stages(folder), key=lambda r: -r["ms"])
    print(f"{len(rows)} stages, {sum(r['ms'] for r in rows) / 1000:.1f} s in total")
    for r in rows[:top]:
        print(f"{r['ms']:>8} ms  stage {r['stage']:>5}  tasks {r['tasks']:>5}  {r['name'][:70]}")


if __name__ == "__main__":
    main()
