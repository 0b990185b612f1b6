"""Stage durations from a Spark event log folder (zstd or plain JSON lines).

usage: python tools/stage_times.py /tmp/run-XXXX   (written by BENCH_EVENT_LOG=1)
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _lines(path: str):
    raw = open(path, "rb").read()
    if raw[:4] == b"\x28\xb5\x2f\xfd":                     # zstd frames
        import io

        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    return raw.decode("utf-8", "ignore").splitlines()


def main() -> None:
    for f in sorted(glob.glob(os.path.join(sys.argv[1], "**", "*"), recursive=True)):
        if os.path.isdir(f):
            continue
        for line in _lines(f):
            try:
                e = json.loads(line)
            except ValueError:
                continue
            if isinstance(e, dict) and e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                ms = si.get("Completion Time", 0) - si.get("Submission Time", 0)
                print(f"stage {si['Stage ID']:4d} tasks={si['Number of Tasks']:5d} {ms:7d} ms  {si['Stage Name'][:70]}")


if __name__ == "__main__":
    main()
