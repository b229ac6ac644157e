"""Shuffle volume of every registered query, from Spark's event log.

Usage: python tools/shuffle.py [sf_dir] >> PLANS.md
Each key runs once (noop sink) in its own job group; the shuffle records and
bytes written by its tasks are summed and shown against the ``events`` row
count, the size of the fact input.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="stationflow-shuffle-", dir="/tmp")
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.dir", log_dir)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from stationflow.plans.registry import queries

    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    keys = list(queries())
    for key in keys:
        spark.sparkContext.setJobGroup(key, key)
        queries()[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_key: dict[int, str] = {}
    totals: dict[str, list[int]] = {k: [0, 0] for k in keys}
    for path in glob.glob(f"{log_dir}/**/events*", recursive=True) + glob.glob(f"{log_dir}/*"):
        if os.path.isdir(path):
            continue
        for line in open(path):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                group = e.get("Properties", {}).get("spark.jobGroup.id")
                for s in e["Stage Infos"]:
                    stage_key[s["Stage ID"]] = group
            elif e["Event"] == "SparkListenerTaskEnd" and stage_key.get(e["Stage ID"]) in totals:
                w = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics", {})
                t = totals[stage_key[e["Stage ID"]]]
                t[0] += w.get("Shuffle Records Written", 0)
                t[1] += w.get("Shuffle Bytes Written", 0)
    print(f"\n## Shuffle volume ({sf_dir}: {rows:,} events)\n")
    print("Generated by `python tools/shuffle.py`. Streaming jobs run on their own thread and are")
    print("not attributed; stream keys show the feed writing and the sink read-back only.\n")
    print("| key | records | per input row | MB |")
    print("|---|---|---|---|")
    for key in keys:
        records, size = totals[key]
        print(f"| `{key}` | {records:,} | {records / rows:.3f} | {size / 1e6:.3f} |")


if __name__ == "__main__":
    main(sys.argv)
