"""Per-query shuffle report from Spark's event log (no UI needed).

Runs queries with auto-broadcast disabled (what large inputs see; explicit broadcasts of
bounded tables still apply), logs events to a scratch folder and prints, per query, the
bytes shuffled and the number of stages that wrote shuffle output.

    python tools/shuffle_report.py /root/testdata/sf0.1 extract_aspects predict_flat ...
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aspectra.plans.queries import QUERIES  # noqa: E402
from aspectra.session import build_session  # noqa: E402


def _events(log_dir):
    import zstandard
    for f in glob.glob(f"{log_dir}/**/events_*", recursive=True) + glob.glob(f"{log_dir}/*local-*"):
        if os.path.isdir(f):
            continue
        raw = open(f, "rb")
        stream = zstandard.ZstdDecompressor().stream_reader(raw) if f.endswith(".zstd") else raw
        for line in io.TextIOWrapper(stream, encoding="utf-8"):
            yield json.loads(line)


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    log_dir = tempfile.mkdtemp(prefix="run-events-", dir="/tmp")
    spark = build_session("local[8]", shuffle_partitions=8, app_name="aspectra-shuffle-report",
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.sql.autoBroadcastJoinThreshold": "-1"})
    for name in names:
        spark.sparkContext.setJobDescription(name)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spark.catalog.clearCache()
    spark.stop()
    stage_query, stats = {}, defaultdict(lambda: {"shuffle": 0, "stages": set()})
    for e in _events(log_dir):
        if e.get("Event") == "SparkListenerJobStart":
            q = (e.get("Properties") or {}).get("spark.job.description")
            for sid in e.get("Stage IDs", []):
                stage_query[sid] = q
        elif e.get("Event") == "SparkListenerTaskEnd":
            q = stage_query.get(e["Stage ID"])
            m = e.get("Task Metrics") or {}
            s = stats[q]
            w = m.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
            s["shuffle"] += w
            if w:
                s["stages"].add(e["Stage ID"])
    print(f"{'query':28s} {'shuffled MB':>12s} {'shuffle stages':>15s}")
    for name in names:
        s = stats[name]
        print(f"{name:28s} {s['shuffle'] / 1e6:12.1f} {len(s['stages']):15d}")


if __name__ == "__main__":
    main()
