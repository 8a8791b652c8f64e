"""Per-stage task balance from Spark's event log.

usage: python tools/task_balance.py <query-key> [sf_dir] [shuffle_partitions] [min_records]

Runs one registered query (noop sink) with the event log written to a fresh
scratch folder, then prints, per stage that reads shuffle data, the number of
tasks, total records read and the hottest task's share. The Spark UI stays
off; only the event log is read.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _events(path: str):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main(argv) -> None:
    key = argv[1]
    sf = argv[2] if len(argv) > 2 else "/root/testdata/sf0.1"
    parts = argv[3] if len(argv) > 3 else "16"
    min_records = int(argv[4]) if len(argv) > 4 else 1000  # skip the tiny per-partition tables
    logdir = tempfile.mkdtemp(prefix="evlog-")
    from shortbook.plans import registry
    from shortbook.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=int(parts), extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file:{logdir}",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    registry.QUERIES[key](spark, sf).write.format("noop").mode("overwrite").save()
    app = spark.sparkContext.applicationId
    spark.stop()
    stages: dict[int, list[int]] = {}
    for path in sorted(glob.glob(f"{logdir}/*{app}*/events_*") + glob.glob(f"{logdir}/{app}*")):
        for line in _events(path):
            e = json.loads(line)
            if e["Event"] == "SparkListenerTaskEnd":
                m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                stages.setdefault(e["Stage ID"], []).append(m.get("Total Records Read", 0))
    for sid, recs in sorted(stages.items()):
        tot = sum(recs)
        if tot >= min_records:
            print(f"stage {sid}: tasks {len(recs)}, records {tot}, hottest task {100 * max(recs) / tot:.1f}%")


if __name__ == "__main__":
    main(sys.argv)
