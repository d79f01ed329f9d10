"""Summarise jobs and stages from Spark event logs in a folder.

    python tools/stage_times.py /tmp/run-XXXX [top_n]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    raw = open(path, "rb").read()
    if path.endswith(".zstd"):
        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    return raw.decode().splitlines()


def main():
    folder = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    stages = []
    for path in glob.glob(os.path.join(folder, "**", "events*"), recursive=True) + \
            glob.glob(os.path.join(folder, "local-*")):
        for line in _lines(path):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages.append((si["Completion Time"] - si["Submission Time"], si["Stage ID"],
                               si["Number of Tasks"], si["Stage Name"][:70]))
    stages.sort(reverse=True)
    print(f"{len(stages)} stages, {sum(s[0] for s in stages) / 1000:.1f} s in total")
    for ms, sid, tasks, name in stages[:top]:
        print(f"{ms:7d} ms  stage {sid:5d}  {tasks:5d} tasks  {name}")


if __name__ == "__main__":
    main()
